"""Deletion of runs of lines that an earlier document, or an earlier place of the same one, has too.

A line's content is its words joined by single spaces; lines without words count for nothing. A run
is a stretch of lines with content. The result has a plain definition, which tests check by brute
force: a line goes if it lies in a run of at least ``least`` words that also occurs with an earlier
start (in order of doc_id, hash of the text, line number).

Only whole lines count: a repeated passage that begins or ends inside a line stays, unless its whole
lines alone have ``least`` words.

1. Winnowing: for each line, the window is the shortest run from there with ``least`` words or
   more; the line of the least hash in it is its fingerprint. Any run of ``least`` words has a whole
   window in it, so both places of a repeated run select the same fingerprint in it.
2. Fingerprints are joined on their hash: only those at two positions or more go on.
3. Their windows match where the digests of all their lines are equal; the first place stays. A
   match is extended both ways by the windows to the right of each line of the run and by those to
   the left, which end at it: together they cover a run of ``least`` words or more whole, whichever
   earlier document has which part of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsift.llm.common import frugal, stage, table

#: Words of the shortest run that counts as repeated.
LEAST = 50
FINGERPRINTS = "doc_id long, key long, fp long, pos int, windows array<struct<h: binary, s: int, e: int>>"


def content(text: str) -> list[tuple[int, bytes, int]]:
    """Number, digest and words of each line with content."""
    out = []
    for i, line in enumerate(text.split("\n")):
        if words := line.split():
            out.append((i, xxhash.xxh3_128_digest(" ".join(words)), len(words)))
    return out


def windows(words: list[int], least: int) -> set[tuple[int, int]]:
    """The shortest runs of ``least`` words or more from each line on, and up to each line."""
    out = set()
    total = end = 0
    for i, w in enumerate(words):
        while total < least and end < len(words):
            total += words[end]
            end += 1
        if total < least:
            break
        out.add((i, end - 1))
        total -= w
    total, start = 0, len(words) - 1
    for i in range(len(words) - 1, -1, -1):
        while total < least and start >= 0:
            total += words[start]
            start -= 1
        if total < least:
            break
        out.add((start + 1, i))
        total -= words[i]
    return out


def winnow(text: str, least: int) -> dict[int, list[tuple[bytes, int, int]]]:
    """Fingerprint lines (numbers among those with content): digest, first and last line number of each window that selects them.

    Of equal hashes in a window the rightmost is selected.
    """
    lines = content(text)
    digests = [d for _, d, _ in lines]
    joined = b"".join(digests)
    out: dict[int, list[tuple[bytes, int, int]]] = {}
    for s, e in windows([w for _, _, w in lines], least):
        at = min(range(s, e + 1), key=lambda i: (digests[i], -i)) if e > s else s
        out.setdefault(at, []).append((xxhash.xxh3_128_digest(joined[16 * s : 16 * e + 16]), lines[s][0], lines[e][0]))
    return out


def fingerprints(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """FINGERPRINTS of doc_id, key, text: hash and place of each fingerprint, with its windows."""
    window = pa.list_(pa.struct([("h", pa.binary()), ("s", pa.int32()), ("e", pa.int32())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), window]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                rows = []
                for doc, key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                    text = text.as_py() or ""
                    if len(text) < 2 * least - 1:  # too short for so many words
                        continue
                    lines = None
                    for at, found in winnow(text, least).items():
                        lines = lines or content(text)
                        fp = int.from_bytes(lines[at][1][:8], "little", signed=True)
                        rows.append((doc, key, fp, lines[at][0], [{"h": h, "s": s, "e": e} for h, s, e in found]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "key", "fp", "pos", "windows"])

    return docs.select("doc_id", "key", "text").mapInArrow(frugal(run), FINGERPRINTS)


def repeated_spans(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, key, spans: of each document with repeated runs, first and last line numbers to delete, in no order."""
    prints = stage(fingerprints(docs, least), "line-prints")
    # a document given twice has each position twice; the count must not see that as repetition
    places = prints.groupBy("fp").agg(F.min(F.struct("doc_id", "key", "pos")).alias("lo"), F.max(F.struct("doc_id", "key", "pos")).alias("hi"))
    # what is counted by a key is a table of its own, so that a join on it can split a very frequent one
    twice = stage(places.filter(~F.col("lo").eqNullSafe(F.col("hi"))).select(F.col("fp").alias("__fp")), "line-twice")
    found = prints.join(twice, prints["fp"] == twice["__fp"], "left_semi").select("doc_id", "key", F.explode("windows").alias("w"))
    found = stage(found.select("doc_id", "key", F.col("w.h").alias("h"), F.col("w.s").alias("s"), F.col("w.e").alias("e")), "line-windows")
    place = F.struct("doc_id", "key", "s")
    first = found.groupBy("h").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).filter(~F.col("lo").eqNullSafe(F.col("hi"))).select(F.col("h").alias("__h"), "lo")
    first = stage(first, "line-first")
    later = found.join(first, found["h"] == first["__h"]).filter(~place.eqNullSafe(F.col("lo")))
    return stage(later.groupBy("doc_id", "key").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "line-spans")


def delete_lines(text: str, spans: list[dict]) -> tuple[str, int]:
    """The text without the lines of the spans, and how many lines with content went."""
    lines = text.split("\n")
    change = [0] * (len(lines) + 1)
    for s in spans:
        change[s["s"]] += 1
        change[s["e"] + 1] -= 1
    kept, gone, depth = [], 0, 0
    for line, c in zip(lines, change, strict=False):
        depth += c
        if not depth:
            kept.append(line)
        elif line.strip():
            gone += 1
    return "\n".join(kept), gone


@F.arrow_udf(T.StructType().add("text", "string").add("gone", "long"))
def _rewrite(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = [delete_lines(t.as_py(), s.as_py()) if s.is_valid else None for t, s in zip(texts, spans, strict=True)]
    return pa.array([None if x is None else {"text": x[0], "gone": x[1]} for x in out], pa.struct([("text", pa.string()), ("gone", pa.int64())]))


def dedup_lines(docs: DataFrame, least: int = LEAST, removed: str = "n_removed") -> DataFrame:
    """The rows with repeated runs taken out of ``text``, and the number of lines with content that went.

    Nulls: a null text stays null and has no lines; null doc_ids come first in order. Rows of equal
    doc_id and text are one document given twice: they lose the same lines and do not count as
    repetitions of each other. Texts under ``least`` words are left alone. An empty table gives an
    empty result. Other columns pass through; a column named as the output is replaced.
    """
    keep = [c for c in docs.columns if c != removed]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.xxhash64("text").alias("__key"))
    spans = repeated_spans(src.select(F.col("doc_id").cast("long"), F.col("__key").alias("key"), "text"), least).select(F.col("doc_id").alias("__d"), F.col("key").alias("__k"), F.col("spans").alias("__spans")).hint("merge")
    x = src.join(spans, (src["__key"] == spans["__k"]) & src["doc_id"].eqNullSafe(spans["__d"]), "left").select(*[F.col(f"`{c}`") for c in keep], "__spans")
    x = x.withColumn("__new", _rewrite(F.when(F.col("__spans").isNotNull(), F.col("text")), F.col("__spans")))
    cols = [F.when(F.col("__new").isNotNull(), F.col("__new.text")).otherwise(F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in keep]
    return x.select(*cols, F.coalesce(F.col("__new.gone"), F.lit(0)).alias(removed))


def op8_winnowed_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with later repeats of runs of 50 words or more deleted."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
