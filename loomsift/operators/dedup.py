"""Repeated passages within a text, repeated names, repeated lines of a corpus."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of the shortest passage that counts as repeated.
LONG = 21


def drop_repeats(text: str, k: int = LONG) -> str:
    """The text without the characters that lie in a run of k that began earlier too; runs may overlap themselves."""
    n = len(text)
    if n <= k:
        return text
    seen: set[str] = set()
    out: list[str] = []
    kept_from, gone = 0, 0  # what lies before ``gone`` is dealt with
    for i in range(n - k + 1):
        gram = text[i : i + k]
        if gram in seen:
            if i > gone:
                out.append(text[kept_from:i])
            gone = kept_from = i + k
        else:
            seen.add(gram)
            if i == gone:
                kept_from = i
    out.append(text[kept_from:])
    return "".join(out)


def dedup_passages(c: Column, k: int = LONG) -> Column:
    """drop_repeats of each text; null for null."""

    @F.arrow_udf(T.StringType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if not t.is_valid else drop_repeats(t.as_py(), k) for t in texts], pa.string())

    return run(c)


def keep_last(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """The last row of each name in the order given, as a later file overwrites an earlier one."""
    row = F.struct(*[F.col(f"`{c}`") for c in [*order, *[c for c in df.columns if c not in order]]])
    last = df.groupBy(F.col(f"`{name}`").alias("__name")).agg(F.max(row).alias("__row"))
    return last.select(*[F.col(f"__row.`{c}`").alias(c) for c in df.columns])


def corpus_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no, line: each different line of a corpus at its first place, in the order of key and line number (our own definition)."""
    lines = df.select(F.col(f"`{key}`").alias(key), F.posexplode(F.split(F.col(f"`{text}`"), "\n", -1)).alias("line_no", "line"))
    return lines.groupBy("line").agg(F.min(F.struct(key, "line_no")).alias("p")).select(F.col(f"p.{key}").alias(key), "p.line_no", "line")


def spans(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """key, s, e: the union of closed intervals; those that overlap or touch become one."""
    w = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = df.withColumn("__new", F.when(F.col(start) <= before + 1, 0).otherwise(1)).withColumn("__g", F.sum("__new").over(w))
    return x.groupBy(key, "__g").agg(F.min(start).alias("s"), F.max(end).alias("e")).select(key, "s", "e")
