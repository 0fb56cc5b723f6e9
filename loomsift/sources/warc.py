"""WARC records: parse and format, and a source and sink for whole archives."""

from __future__ import annotations

import base64
import hashlib
import io
import os
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an archive that one task of the reader owns, and tasks that byte ranges are dealt to, at most.
SPLIT = 8 << 20
TASKS = 20_000
#: Bytes of a candidate that are inflated to look for a record, and of payload that a batch holds; a larger record is a batch of its own.
PROBE = 4096
BATCH = 4 << 20
#: Bytes in which a record's head ends.
HEAD = 1 << 20
# Fixed values of the formats; STORED is the longest stored block of a deflate stream.
STORED = 65_535
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.0"
BREAK = b"\r\n"


class WarcError(ValueError):
    """The bytes are not a WARC record."""


@dataclass
class Record:
    """One record: headers in order, the block after them, and where its bytes begin in the archive."""

    headers: dict[str, str]
    block: bytes
    offset: int = 0
    size: int = 0
    lower: dict[str, str] = field(init=False)

    def __post_init__(self) -> None:
        self.lower = {k.lower(): v for k, v in self.headers.items()}

    @property
    def kind(self) -> str:
        return self.lower.get("warc-type", "")

    def get(self, name: str) -> str | None:
        return self.lower.get(name.lower())

    @property
    def payload(self) -> bytes:
        """The block without an HTTP head where it carries one."""
        if "application/http" in (self.get("Content-Type") or ""):
            return self.block.partition(BREAK * 2)[2]
        return self.block


def format_record(headers: dict[str, str], block: bytes) -> bytes:
    """The record's bytes; header values lose line breaks."""
    lines = [VERSION]
    for k, v in (headers | {"Content-Length": str(len(block))}).items():
        lines.append(f"{k}: {' '.join(v.split(chr(10))).replace(chr(13), ' ')}".encode())
    return BREAK.join(lines) + BREAK * 2 + block + BREAK * 2


def parse_head(data: bytes) -> tuple[dict[str, str], int]:
    """Headers of the record that data begins with, and the length of the head."""
    if not data.startswith(b"WARC/"):
        raise WarcError("no version line")
    end = data.find(BREAK * 2)
    if end < 0:
        raise WarcError("the head does not end")
    headers: dict[str, str] = {}
    last = None
    for line in data[:end].split(BREAK)[1:]:
        if line[:1] in (b" ", b"\t") and last:
            headers[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError("a header line has no colon")
        last = name.decode("utf-8", "replace").strip()
        headers[last] = value.strip().decode("utf-8", "replace")
    return headers, end + 4


def parse_record(data: bytes, offset: int = 0, size: int = 0) -> Record:
    """The one record that data holds."""
    headers, at = parse_head(data)
    rec = Record(headers, b"", offset, size)
    length = rec.get("Content-Length")
    if length is None or not length.isdigit() or at + int(length) > len(data):
        raise WarcError("the block is cut off")
    rec.block = data[at : at + int(length)]
    return rec


def records_of(data: bytes) -> Iterator[tuple[int, int]]:
    """Begin and end of each record that a member's bytes hold, one after another with breaks between them."""
    at = 0
    while at < len(data):
        if data[at : at + 1] in (b"\r", b"\n"):
            at += 1
            continue
        headers, head = parse_head(data[at : at + HEAD] if len(data) - at > HEAD else data[at:])
        length = {k.lower(): v for k, v in headers.items()}.get("content-length", "")
        end = at + head + int(length) if length.isdigit() else -1
        if not at < end <= len(data):
            raise WarcError("the block is cut off")
        yield at, end
        at = end


class Blocks:
    """A file by aligned blocks, of which the last few read are kept."""

    def __init__(self, file, size: int, block: int = 1 << 20, keep: int = 4):
        self.file, self.size, self.block, self.keep = file, size, block, keep
        self.held: dict[int, bytes] = {}

    def read(self, at: int, n: int) -> bytes:
        """Up to n bytes from ``at`` on, as far as its block goes; none at the file's end."""
        k, off = divmod(at, self.block)
        if at >= self.size:
            return b""
        if k not in self.held:
            if len(self.held) >= self.keep:
                del self.held[next(iter(self.held))]
            self.file.seek(k * self.block)
            self.held[k] = self.file.read(min(self.block, self.size - k * self.block))
        return self.held[k][off : off + n]

    def find(self, what: bytes, at: int, stop: int) -> int:
        """The first place from ``at`` on, before ``stop``, where ``what`` begins; -1 if there is none."""
        stop = min(stop, self.size)
        while at < stop:
            part = self.read(at, self.block)
            more = self.read(at + len(part), len(what) - 1)
            hit = (part + more).find(what, 0, stop - at + len(what) - 1)
            if hit >= 0:
                return at + hit
            at += len(part)
        return -1


def inflate(blocks: Blocks, at: int) -> tuple[bytes, int]:
    """What the gzip member at ``at`` holds, and its end; raises if there is none, or if it is no record or damaged."""
    d, pos, step = zlib.decompressobj(31), at, PROBE
    parts: list[bytes] = []
    begun = b""
    try:
        while not d.eof:
            piece = blocks.read(pos, step)
            if not piece:
                raise WarcError("the gzip member is cut off")
            parts.append(d.decompress(piece))
            pos += len(piece)
            step = min(2 * step, blocks.block)
            if len(begun) < 5:
                begun += parts[-1][:5]
                if not begun.startswith(b"WARC/"[: len(begun)]):
                    raise WarcError("the gzip member holds no record")
    except zlib.error as e:
        raise WarcError(f"the gzip member is damaged: {e}") from None
    if len(begun) < 5:
        raise WarcError("the gzip member holds no record")
    return b"".join(parts), pos - len(d.unused_data)


def proven(blocks: Blocks, at: int) -> bool | None:
    """Whether a member of the archive begins at ``at``; None if that cannot be told from what follows.

    An archive that is stored in a record can look like members of the outer one only within one
    stored block of its compression, which has STORED bytes at most. So whole members in a row that
    reach farther, or exactly to the file's end, are the archive's own.
    """
    pos, first = at, True
    while pos < blocks.size and pos - at <= STORED:
        try:
            pos = inflate(blocks, pos)[1]
        except WarcError:
            return False if first else None
        first = False
    return True


def walk(blocks: Blocks, at: int, stop: int) -> Iterator[tuple[int, int, bytes, str | None]]:
    """offset, size, content and error of the members from ``at`` on, where one begins, that begin before ``stop``.

    After a damaged member comes the next place where a whole one begins; what lies between is one
    row with the error. Zeros at the file's end are padding.
    """
    while at < min(stop, blocks.size):
        try:
            data, end = inflate(blocks, at)
            yield at, end - at, data, None
            at = end
        except WarcError as e:
            if all(not blocks.read(k, blocks.block).strip(b"\0") for k in range(at, blocks.size, blocks.block)):
                return
            end = at + 1
            while (end := blocks.find(GZIP_MAGIC, end, blocks.size)) >= 0 and proven(blocks, end) is False:
                end += 1
            end = end if end >= 0 else blocks.size
            yield at, end - at, b"", str(e)
            at = end


def first_member(blocks: Blocks, start: int) -> int:
    """Where the first member from ``start`` on begins.

    The places of the gzip magic are candidates; where one is neither proven nor refuted, the file is
    gone through from its beginning.
    """
    at = start
    while start and (at := blocks.find(GZIP_MAGIC, at, blocks.size)) >= 0:
        sure = proven(blocks, at)
        if sure:
            return at
        if sure is None:
            at = 0
            for begin, size, _, _ in walk(blocks, 0, start):
                at = begin + size
            return max(at, start)
        at += 1
    return at if at >= 0 else blocks.size


def plain_records(blocks: Blocks) -> Iterator[tuple[int, int, bytes, str | None]]:
    """offset, size, content and error of the records of an archive that is not compressed."""
    at = 0
    while at < blocks.size:
        piece = blocks.read(at, 1)
        if piece in b"\r\n\0":
            at += 1
            continue
        try:
            head = read_span(blocks, at, min(at + HEAD, blocks.size))
            headers, n = parse_head(head)
            length = {k.lower(): v for k, v in headers.items()}.get("content-length", "")
            if not length.isdigit() or at + n + int(length) > blocks.size:
                raise WarcError("the block is cut off")
            end = at + n + int(length)
            yield at, end - at, read_span(blocks, at, end), None
        except WarcError as e:
            hit = blocks.find(BREAK * 2 + b"WARC/", at + 1, blocks.size)
            end = blocks.size if hit < 0 else hit + 4
            yield at, end - at, b"", str(e)
        at = end


def read_span(blocks: Blocks, at: int, end: int) -> bytes:
    parts = []
    while at < end:
        parts.append(blocks.read(at, end - at))
        at += len(parts[-1])
    return b"".join(parts)


def members(blocks: Blocks, start: int, stop: int) -> Iterator[tuple[int, int, bytes, str | None]]:
    """offset, size, content and error of the members that begin in a byte range; of an archive that is not compressed, all records in the first range."""
    if blocks.read(0, 3) == GZIP_MAGIC:
        yield from walk(blocks, first_member(blocks, start), stop)
    elif start == 0:
        yield from plain_records(blocks)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    parts = urlsplit(path)
    if parts.scheme == "file":
        return pafs.LocalFileSystem(), unquote(parts.path)
    return pafs.FileSystem.from_uri(path)


@contextmanager
def new_file(path: str):
    """A file that appears under its name only when it is whole."""
    fs, at = filesystem(path)
    fs.create_dir(os.path.dirname(at), recursive=True)
    with fs.open_output_stream(f"{at}.part", compression=None) as out:
        yield out
    fs.move(f"{at}.part", at)


def row_of(rec: Record) -> tuple:
    """rec_type, record_id, target_uri, refers_to, digest, length, payload and error of a record.

    The digest is bare lower-case hex SHA-1, of the payload where there is one, and must be what the
    header says; a revisit's is the header's, and its length too. Identifiers lose their brackets.
    """
    told = (rec.get("WARC-Payload-Digest") or "").partition(":")[2]
    payload, error = rec.payload, None
    bare = [(rec.get(k) or "").strip("<>") or None for k in ("WARC-Record-ID", "WARC-Refers-To")]
    if rec.kind == "revisit":
        try:
            digest, length, payload = base64.b32decode(told).hex() or None, int(rec.get("X-Payload-Length") or 0), None
        except ValueError:
            digest, length, payload, error = None, None, None, "the revisit's digest or length cannot be read"
    else:
        sha1 = hashlib.sha1(payload)
        digest, length = sha1.hexdigest(), len(payload)
        if told and base64.b32encode(sha1.digest()).decode() != told.upper() and digest != told.lower():
            error = "the payload does not have its digest"
    return rec.kind, bare[0], rec.get("WARC-Target-URI"), bare[1], digest, length, payload, error


RECORDS = "path string, offset long, member_bytes long, rec_type string, record_id string, target_uri string, refers_to string, digest string, length long, payload binary, error string"
_NAMES = [x.split()[0] for x in RECORDS.split(", ")]
_KINDS = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary(), pa.string()]


def range_rows(path: str, start: int, stop: int) -> Iterator[tuple]:
    """The rows of RECORDS of what begins in a byte range of an archive."""
    fs, at = filesystem(path)
    with fs.open_input_file(at) as file:
        for offset, size, data, error in members(Blocks(file, file.size()), start, stop):
            if error is None:
                try:
                    for s, e in records_of(data):
                        yield path, offset, size, *row_of(parse_record(data[s:e]))
                except WarcError as e:
                    error = str(e)
            if error is not None:
                yield path, offset, size, *[None] * 7, error


def read_ranges(ranges: DataFrame) -> DataFrame:
    """RECORDS of all that begins in the byte ranges path, start, stop; what is damaged is a row with ``error`` and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                rows: list[tuple] = []
                held = 0
                for row in range_rows(r["path"], r["start"], r["stop"]):
                    rows.append(row)
                    held += len(row[9] or b"") + 500
                    if held > BATCH:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return ranges.select("path", "start", "stop").mapInArrow(run, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=_NAMES)


def splits(files: DataFrame, size: int = SPLIT) -> DataFrame:
    """path, start, stop of byte ranges of the files in path, bytes."""
    return files.select("path", F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(size))).alias("start")).select("path", "start", (F.col("start") + size).alias("stop"))


def read_files(files: DataFrame, size: int = SPLIT) -> DataFrame:
    """RECORDS of the archives in path, bytes; a task for each byte range, dealt out by a hash of it."""
    tasks = files.agg(F.sum(F.ceil(F.greatest(F.col("bytes"), F.lit(1)) / size)).alias("n")).first()["n"] or 1
    return read_ranges(splits(files, size).repartition(min(int(tasks), TASKS), "path", "start"))


def read_warc(spark: SparkSession, path: str, kinds: tuple[str, ...] | None = ("response",), size: int = SPLIT) -> DataFrame:
    """path, offset, rec_type, url, payload and error of the records of the archives at path.

    Archives are read by byte ranges of ``size``: a task owns the gzip members that begin in its range.
    Archives that are not compressed are read by one task each. ``kinds`` keeps records of these
    types; None keeps all. What is damaged is a row of no type with ``error``, whatever the kinds, and
    reading goes on at the next member. No archive gives no rows.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))
    rows = read_files(files, size).select("path", "offset", "rec_type", F.col("target_uri").alias("url"), "payload", "error")
    return rows if kinds is None else rows.filter(F.col("rec_type").isin(*kinds) | F.col("error").isNotNull())


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """One gzip member, the same bytes for the same data."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def archive(records: list[tuple[dict[str, str], bytes]], level: int = 6) -> bytes:
    """An archive of one gzip member for each record."""
    out = io.BytesIO()
    for headers, block in records:
        out.write(gzip_member(format_record(headers, block), level))
    return out.getvalue()
