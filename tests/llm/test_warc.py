import hashlib
import random

from loomsift.llm import warc
from loomsift.llm.common import fresh_path

BIG = "<p>" + "x y z " * 300 + "</p>"


def pages(spark):
    rng = random.Random(1)
    noise = "".join(chr(rng.randrange(32, 0x2FF)) for _ in range(40_000))
    rows = [(1, "u1", BIG), (5, "u5", BIG), (3, None, BIG), (None, "un", BIG), (5, "u5", BIG), (5, "u0", BIG), (5, None, BIG), (7, "u7", "small"), (8, "u8", "small"), (9, None, None), (10, "", ""), (None, None, None), (11, "a\r\nb", noise), (12, "u", "\x1f\x8b\x08" * 500 + "é"), (None, None, noise[:3000]), (None, None, noise[:3000])]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def round_trip(spark, df, size):
    files = warc.write_archives(warc.mark_revisits(df), fresh_path(spark, "t"))
    return files, warc.read_files(files, size)


def page(urn):
    return urn.split(":")[2]


def test_round_trip_at_any_split(spark):
    df = pages(spark)
    html = lambda r: (r["html"] or "").encode()
    want = sorted((str(r["page_id"]).replace("None", "null"), hashlib.sha1(html(r)).hexdigest(), len(html(r))) for r in df.collect())
    for size in (1 << 20, 1000, 37):
        files, got = round_trip(spark, df.coalesce(1), size)
        rows = got.collect()
        assert not any(r["error"] for r in rows)
        assert sorted((page(r["record_id"]), r["digest"], r["length"]) for r in rows) == want
        big = [r for r in rows if r["length"] == len(BIG)]
        (kept,) = [r for r in big if r["rec_type"] == "response"]
        assert page(kept["record_id"]) == "5" and kept["target_uri"] == "u5" and kept["payload"].decode() == BIG
        assert len(big) == 7 and all(r["refers_to"] == kept["record_id"] and r["payload"] is None for r in big if r is not kept)
        assert len({r["record_id"] for r in big}) == 7
        assert all(r["rec_type"] == "response" for r in rows if r["length"] < 1000 or r["record_id"].startswith("urn:page:null") and r["length"] != len(BIG))


def test_one_response_for_equal_payloads(spark):
    df = spark.createDataFrame([(5, "a", BIG), (5, "a", BIG), (1, "a", BIG)], "page_id long, url string, html string")
    rows = round_trip(spark, df, 1 << 20)[1].collect()
    assert sorted((page(r["record_id"]), r["rec_type"]) for r in rows) == [("1", "revisit"), ("5", "response"), ("5", "revisit")]


def test_no_pages(spark):
    _, got = round_trip(spark, pages(spark).limit(0), 1000)
    assert got.count() == 0
