"""A sink for WARC archives of one gzip member a record."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from loomsift.sources.warc import format_record, gzip_member, new_file

#: Bytes after which a task begins another archive.
TARGET = 1 << 30


def write_warc(df: DataFrame, folder: str, suffix: str = "-chinese", target: int = TARGET) -> DataFrame:
    """Write rec_type, url, payload as archives in a folder or URI that all executors see; returns path and records of each.

    Where df has a column ``name``, an archive is named by it and rows of other names go to other
    archives (they come together and sorted if df is so); else names are new ones with the suffix. A
    file gets its name when it is whole, so a task that is run again leaves no half file under one;
    only names in the result count. Null payloads are empty. An empty table gives no file.
    """
    named = "name" in df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for k in range(0, b.num_rows, 64) for r in b.slice(k, 64).to_pylist())
        row = next(rows, None)
        while row is not None:
            name, n, size = row.get("name"), 0, 0
            path = f"{folder}/{name}" if named else f"{folder}/{uuid.uuid4().hex}{suffix}.warc.gz"
            with new_file(path) as out:
                while row is not None and row.get("name") == name and (named or size < target):
                    member = gzip_member(format_record({"WARC-Type": row["rec_type"] or "", "WARC-Target-URI": row["url"] or "", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>"}, row["payload"] or b""))
                    out.write(member)
                    n, size = n + 1, size + len(member)
                    row = next(rows, None)
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]}, pa.schema([("path", pa.string()), ("records", pa.int64())]))

    return df.select("rec_type", "url", "payload", *(["name"] if named else [])).mapInArrow(run, "path string, records long")
