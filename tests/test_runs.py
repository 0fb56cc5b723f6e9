import gzip
import json

from pyspark.sql import functions as F

from loomsift.cli import main, parser
from loomsift.functions import text as fx
from loomsift.operators import dedup, html, lang, perplexity
from loomsift.plans import pipelines
from loomsift.sources import files
from loomsift.sources.warc import archive, format_record, read_warc
from loomsift.sources.warc_sink import write_warc
from loomsift.streaming.incremental import score_new_files

GOOD = "".join(chr(0x4E00 + 37 * i % 3000) for i in range(150))


def folder(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "good.txt").write_text(GOOD, encoding="utf-8")
    (d / "spam.txt").write_text("99区99|免费|" * 40, encoding="utf-8")
    (d / "empty.txt").write_text("")
    (d / "bad.txt").write_bytes(b"\xffabc")
    (d / "other.md").write_text("no")
    return str(d)


def test_filter(spark, tmp_path):
    out = str(tmp_path / "out")
    r = pipelines.filter_texts(spark, folder(tmp_path), out).first()
    assert r["total"] == 4 and r["high_quality"] + r["low_quality"] == 4
    kept = {x["name"] for x in spark.read.parquet(f"{out}/kept").collect()}
    assert "good.txt" in kept and not kept & {"spam.txt", "empty.txt"}
    assert spark.read.json(f"{out}/results").count() == 4


def test_mask(spark, tmp_path):
    out = str(tmp_path / "out")
    r = pipelines.mask_texts(spark, folder(tmp_path), out, ["免费"]).first()
    assert (r["total"], r["processed"], r["error"]) == (4, 4, 0)
    assert all("免费" not in x["text"] for x in spark.read.parquet(f"{out}/masked").collect())


def test_cluster_and_process(spark, tmp_path):
    d = folder(tmp_path)
    assert sum(r["n"] for r in pipelines.cluster_texts(spark, d, str(tmp_path / "c")).collect()) == 3
    out = pipelines.process(spark, d, str(tmp_path / "p"), ["免费"])
    assert {"name", "text", "embedding"} <= set(out.columns)


def test_incremental(spark, tmp_path):
    d, out, cp = folder(tmp_path), str(tmp_path / "out"), str(tmp_path / "cp")
    for n in (3, 4):  # the file without bytes is passed over
        q = score_new_files(spark, d, out, cp)
        q.awaitTermination(60)
        assert spark.read.parquet(out).count() == n
        (tmp_path / "in" / "new.txt").write_text(GOOD)


def test_warc(spark, tmp_path):
    recs = [
        ({"WARC-Type": "warcinfo"}, b"x"),
        ({"WARC-Type": "response", "WARC-Target-URI": "http://a/1", "Content-Type": "application/http"}, b"HTTP/1.1 200 OK\r\n\r\n<p>" + GOOD.encode() + b"</p>"),
        ({"WARC-Type": "response", "WARC-Target-URI": "https://a/1"}, b"<p>" + GOOD[::-1].encode() + b"</p>"),
        ({"WARC-Type": "response", "WARC-Target-URI": "http://b"}, b""),
        ({"WARC-Type": "response", "WARC-Target-URI": "http://c"}, b"plain english only"),
    ]
    data = archive(recs)
    (tmp_path / "w.warc.gz").write_bytes(data)
    got = read_warc(spark, str(tmp_path / "w.warc.gz")).collect()
    assert [r["url"] for r in got] == ["http://a/1", "https://a/1", "http://b", "http://c"]
    plain = b"".join(format_record(*r) for r in recs)
    want = [tuple(r)[1:] for r in read_warc(spark, str(tmp_path / "w.warc.gz"), None).select("path", "rec_type", "url", "payload").collect()]
    for name, bytes_ in (("plain.warc", plain), ("one.warc.gz", gzip.compress(plain))):
        (tmp_path / name).write_bytes(bytes_)
        assert [tuple(r)[1:] for r in read_warc(spark, str(tmp_path / name), None).select("path", "rec_type", "url", "payload").collect()] == want
    (tmp_path / "cut.warc.gz").write_bytes(data[:-7])
    cut = read_warc(spark, str(tmp_path / "cut.warc.gz")).collect()
    assert [r["error"] for r in cut] == [None] * 3 + ["the gzip member is cut off"] and cut[-1]["offset"] > cut[-2]["offset"]
    out = pipelines.ingest_warc(spark, str(tmp_path / "w.warc.gz")).collect()
    assert [r["filename"] for r in out] == ["a_1.html"] and out[0]["payload"].startswith(b"<p>" + GOOD[::-1][:1].encode())
    n = write_warc(read_warc(spark, str(tmp_path / "w.warc.gz")), str(tmp_path / "o")).collect()
    assert sum(r["records"] for r in n) == 4 and read_warc(spark, str(tmp_path / "o")).count() == 4


def test_html(spark):
    page = "<html><head><style>x{}</style></head><body><nav>menu</nav><p>a &amp; b</p><script>1<2</script><!-- c -->z</body></html>"
    df = spark.createDataFrame([(page,), (None,), ("",)], "h string")
    rows = df.select(html.html_text(F.col("h")).alias("crawl"), html.tool_text(F.col("h")).alias("tool")).collect()
    assert [tuple(r) for r in rows] == [("menua & bz", "a & b z"), (None, ""), ("", "")]


def test_lang(spark):
    df = spark.createDataFrame([("中文中文中文中文中文",), ("短",), ("english text only",), ("12345678901",), (None,)], "t string")
    rows = df.select(lang.is_chinese(F.col("t")).alias("a"), lang.is_chinese(F.col("t"), guarded=True).alias("b")).collect()
    assert [tuple(r) for r in rows] == [(True, True), (True, False), (False, False), (False, False), (False, False)]


def test_perplexity(spark):
    df = spark.createDataFrame([(100.0,), (200.0,), (5050.0,), (10000.0,)], "p double")
    got = [r[0] for r in df.select(perplexity.perplexity_score(F.col("p"), F.lit("good text"))).collect()]
    assert got[0] == 1 and abs(got[1] - 0.98989899) < 1e-6 and got[2:] == [0.5, 0.0]
    docs = spark.createDataFrame([(1, "the cat sat on the mat " * 5), (2, "xq zvk jw"), (3, "")], "id long, t string")
    rows = {r["id"]: r for r in perplexity.score_texts(docs, "id", "t").collect()}
    assert rows[1]["perplexity"] < rows[2]["perplexity"] and rows[3]["perplexity_score"] == 0.5


def test_sinks(spark, tmp_path):
    files.write_lexicon(spark.createDataFrame([("b",), ("a",)], "word string"), str(tmp_path / "l"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "l")).collect()] == ["a", "b"]
    (tmp_path / "urls").write_text("u1\nu2\nu3\n")
    assert [r[0] for r in files.url_list(spark, str(tmp_path / "urls"), 2).collect()] == ["u1", "u2"]
    files.write_stats(spark.createDataFrame([(1,)], "n int"), str(tmp_path / "s"))
    assert json.loads(next((tmp_path / "s").glob("part*")).read_text()) == {"n": 1}


def test_merge_words(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.txt").write_text("b\na\n")
    (tmp_path / "w" / "c.md").write_text("no")
    for flags in ([], ["--no-sort"]):
        main(["merge-words", "-i", str(tmp_path / "w"), "-o", str(tmp_path / "w" / "out.txt"), *flags])
        got = [r[0] for r in spark.read.text(str(tmp_path / "w" / "out.txt")).collect()]
        assert sorted(got) == ["a", "b"] and (flags or got == ["a", "b"])


def test_command_line():
    a = parser().parse_args(["process", "--input-dir", "x", "--vectorize"])
    assert a.vectorize and not a.filter_quality and a.file_pattern == "*.txt"


def test_crawl_text_in_one_worker(spark, monkeypatch):
    """The same rows as the three steps by columns, but one Python step, where those are run again for the filter."""
    monkeypatch.setattr(html, "PORTION", 50)
    body = "<p>A first passage of more than 21 signs.</p>"
    pages = [f"<html><style>s</style>{body}{body}<b>{i}</b>  é中</html>" for i in range(40)] + [None, "", "<p></p>", "<script>x</script>", "plain"]
    df = spark.createDataFrame([(i, h, str(i)) for i, h in enumerate(pages)], "id long, h string, more string")
    got = html.with_crawl_text(df, "h")
    want = df.select("id", "more", dedup.dedup_passages(fx.clean_crawl(html.html_text(F.col("h")))).alias("text")).filter(F.length("text") > 0)
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect()) and got.count() == 41
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("MapInArrow"), plan.count("ArrowEvalPython")) == (1, 0)
