import re

from pyspark.sql import functions as F

from loomsift.functions import text as fx
from loomsift.operators import rules


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]


def test_cleaning(spark):
    assert one(spark, "a\nb  c=😀", fx.clean_crawl) == "ab c"
    assert one(spark, " a\n\tb\x07", fx.clean_tool) == "a b"
    assert one(spark, "a\x1cb", fx.clean_tool) == "a b"
    assert one(spark, None, fx.clean_tool) is None
    assert one(spark, "中文，正文。", fx.clean_crawl) == "中文，正文。"


def test_names(spark):
    assert one(spark, "https://a.com/x?y=1", fx.url_to_filename) == "a_com_x_y_1.html"
    assert one(spark, "http://" + "b" * 200, fx.url_to_filename) == "b" * 100 + ".html"
    assert one(spark, "/x/CC-1.warc.gz", fx.warc_output_name) == "CC-1-chinese.warc.gz"


def test_perplexity_text_deletes_ideographs(spark):
    assert one(spark, "中文 abc!!!  http://x.y/z ....", fx.perplexity_text) == " abc! [URL] ..."
    assert one(spark, "中文😀", lambda c: fx.perplexity_text(c, False)) == "中文"


def test_segments(spark):
    three = "x" * 300 + "." + "y" * 200 + "." + "z" * 98 + "."
    assert one(spark, three, fx.segments) == three[:500]
    assert one(spark, "a.b.c.d.e", fx.segments) == "a。b。c。d。e"
    assert one(spark, "a.b.c.d", fx.segments) == "a。b。c。d"
    assert one(spark, ".".join("abcdefghi"), fx.segments) == "a。b。d。e。g。h"


def test_chunks(spark):
    assert one(spark, "a\n\n b \n" + "c" * 1001, fx.chunks) == ["a", "b", "c" * 1000, "c"]
    assert one(spark, "", fx.chunks) == []
    assert one(spark, "😀" * 1500, fx.fixed_segments) == ["😀" * 1000, "😀" * 500]


def test_decode(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),), (None,), (bytearray("中".encode()),)], "b binary")
    assert [r[0] for r in df.select(fx.decode_utf8("b")).collect()] == ["ab", None, "中"]


def test_white_space_class(spark):
    chars = [chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    got = {r[0] for r in df.filter(F.col("c").rlike(f"[{fx.WS}]")).collect()}
    assert got == {c for c in chars if re.match(r"\s", c)}


def test_patterns_for_speed_say_the_same(spark):
    import random

    rng = random.Random(3)
    parts = ["ab", "-", ".", "com", "a" * 63, "b" * 70, "www.", "http://", "https://x", " ", "\n", "\t", "　", "\x85", "é", "中", "😀", "。", "—", "=", "`", "&", "^", "\\", "[", "]", "!", "?", "9"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    pairs = {
        "url": (rules.url_count(t), F.regexp_count(t, F.lit(fx.ANY_URL))),
        "crawl": (fx.clean_crawl(t), F.trim(F.regexp_replace(F.regexp_replace(t, rf"[^{fx.CRAWL_KEEPS}]", ""), " {2,}", " "))),
        "space": (fx.one_space(t), F.regexp_replace(t, rf"[{fx.WS}]+", " ")),
        "emoji": (F.regexp_replace(fx.perplexity_text(t), "x", "x"), F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, rf"[{fx.WS}]+", " "), fx.URL, "[URL]"), r"[!?]{2,}", "!"), r"\.{3,}", "..."), f"[{fx.EMOJI}]+", "")),
    }
    for name, (fast, plain) in pairs.items():
        assert df.filter(~fast.eqNullSafe(plain)).collect() == [], name
    long = df.select(F.concat_ws("", F.array_repeat(t, 40)).alias("t"))
    for src in (df, long):
        for compat in (True, False):
            for row in src.select("t", fx.perplexity_text(t, compat).alias("p"), fx.scored_text(t, 500, compat).alias("s")).filter("t is not null").collect():
                assert (fx.plain_perplexity_text(row["t"], compat), fx.plain_scored_text(row["t"], 500, compat)) == (row["p"], row["s"])
    for row in df.select("t", fx.clean_crawl(t).alias("c")).filter("t is not null").collect():
        assert fx.plain_clean_crawl(row["t"]) == row["c"]
