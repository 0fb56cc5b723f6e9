"""WARC archives: a writer of deduplicated records, read back by the splittable reader of ``sources.warc``."""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.llm.common import fresh_path, frugal, stage, table
from loomsift.sources.warc import format_record, gzip_member, new_file, read_files

__all__ = ["mark_revisits", "op2_warc_round_trip", "read_files", "write_archives"]

#: Payloads of at least so many bytes are stored once.
LEAST = 1000
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "path string, bytes long, records long"
PAGES = ("page_id", "url", "html", "copy", "keeper", "keeper_url")


def urn(page_id: int | None, url: str | None, sha1: bytes, copy: int) -> str:
    """A record's id, from the page's id, a hash of its URL and payload, and its number among rows that are equal in all that."""
    return f"<urn:page:{'null' if page_id is None else page_id}:{hashlib.sha1(repr(url).encode() + sha1).hexdigest()[:16]}:{copy}>"


def page_record(row: dict, html: bytes) -> bytes:
    """The bytes of a response, or of a revisit of ``keeper``."""
    sha1 = hashlib.sha1(html).digest()
    own = row["keeper"] is None
    head = {
        "WARC-Type": "response" if own else "revisit",
        "WARC-Record-ID": urn(row["page_id"], row["url"], sha1, row["copy"]),
        "WARC-Date": DATE,
        "WARC-Target-URI": row["url"] or "",
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(sha1).decode(),
        "X-Payload-Length": str(len(html)),
        "Content-Type": "application/http; msgtype=response",
    }
    if not own:
        head |= {"WARC-Refers-To": urn(row["keeper"], row["keeper_url"], sha1, 0), "WARC-Profile": PROFILE}
    return format_record(head, HTTP_HEAD.format(len(html)).encode() + (html if own else b""))


def mark_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html, copy, keeper, keeper_url: the page (and its URL) that a row's payload is stored under, null for its own.

    Of the rows with an equal payload of ``least`` bytes or more the one of the largest page_id keeps
    it, of several such the one of the largest URL, and of rows that are equal in all this the first;
    ``copy`` numbers those. A null html is an empty payload; a null page_id never keeps a payload for
    rows that have one, and rows of null ids all keep theirs where there is no other.
    Digests alone are grouped; where a payload repeats, its rows meet what is said about it in a join
    that can split a very common one. Shorter payloads and such as do not repeat go past it.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    url = F.struct(F.col("url").isNotNull().alias("some"), "url")
    x = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("__digest"), F.octet_length(html).alias("__n"))
    short, long = x.filter(F.col("__n") < least), x.filter(F.col("__n") >= least)
    rows = long.filter(F.col("page_id").isNotNull()).groupBy("__digest", "page_id", url.alias("u")).agg(F.count(F.lit(1)).alias("n"))
    kept = rows.groupBy(F.col("__digest").alias("__same")).agg(F.max(F.struct("page_id", "u", "n")).alias("k"))
    kept = stage(kept.select("__same", F.col("k.page_id").alias("__keeper"), F.col("k.u.url").alias("__keeper_url"), F.col("k.n").alias("__n_same")), "warc-keepers")
    x = long.join(kept, F.col("__digest") == F.col("__same"), "left")
    is_keeper = F.coalesce(F.col("page_id") == F.col("__keeper"), F.lit(False)) & F.col("url").eqNullSafe(F.col("__keeper_url"))
    own = is_keeper | F.col("__keeper").isNull()
    plain = x.filter(~is_keeper | (F.col("__n_same") == 1)).select("page_id", "url", "html", F.lit(0).alias("copy"), F.when(~own, F.col("__keeper")).alias("keeper"), F.when(~own, F.col("__keeper_url")).alias("keeper_url"))
    # rows that equal the keeper in all columns, which are few or none: one payload for them, and their numbers
    many = stage(kept.filter("__n_same > 1"), "warc-same")
    same = long.join(many, (F.col("__digest") == F.col("__same")) & (F.col("page_id") == F.col("__keeper")) & F.col("url").eqNullSafe(F.col("__keeper_url")))
    same = same.groupBy("page_id", "url", "__digest").agg(F.first("html").alias("html"), F.count(F.lit(1)).cast("int").alias("n"))
    same = same.select("page_id", "url", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"), "html")
    again = F.col("copy") > 0
    same = same.select("page_id", "url", "html", "copy", F.when(again, F.col("page_id")).alias("keeper"), F.when(again, F.col("url")).alias("keeper_url"))
    return short.select("page_id", "url", "html", F.lit(0).alias("copy"), F.lit(None).cast("long").alias("keeper"), F.lit(None).cast("string").alias("keeper_url")).unionByName(plain).unionByName(same)


def write_archives(pages: DataFrame, folder: str, level: int = 6, target: int = 64 << 20) -> DataFrame:
    """Write the rows of ``mark_revisits`` as archives of one gzip member a record; returns path, bytes, records of each.

    Each task writes files of its own, of about ``target`` bytes at most. A task that is run again
    writes under new names, and only names in the result count. An empty table gives no file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for k in range(0, b.num_rows, 64) for r in b.slice(k, 64).to_pylist())
        row = next(rows, None)
        while row is not None:
            path, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
            with new_file(path) as out:
                while row is not None and size < target:
                    member = gzip_member(page_record(row, row["html"].encode("utf-8", "surrogatepass")), level)
                    out.write(member)
                    n, size = n + 1, size + len(member)
                    row = next(rows, None)
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [n]}, pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    return stage(pages.select(*PAGES).mapInArrow(frugal(run), MANIFEST), "warc-manifest")


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record, equal payloads once, and read back by byte ranges; damage would be a row with an error."""
    files = write_archives(mark_revisits(table(spark, sf_dir, "pages")), fresh_path(spark, "warc"))
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+):", 1).try_cast("long")
    return read_files(files).select(
        page("record_id").alias("page_id"), F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("rec_type").alias("record_type"),
        page("refers_to").alias("refers_to"), "error",
    )
