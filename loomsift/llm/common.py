"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomsift.storage import fresh_path, stage, table

__all__ = ["fresh_path", "frugal", "portions", "positional", "ranked", "stage", "table"]

#: Sub-buckets that the rows of one group are spread over to be ranked.
SPREAD = 256


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of batches; at its task's end the worker gives its free memory back.

    Spark uses workers again, so what one stage has freed but not returned would stand beside what the next one needs.
    """

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return through


def release() -> None:
    """Free memory goes back to the system, as far as the allocators can tell it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library, which has no such call
        pass


def portions(sizes: Iterable[int], most: int, each: int = 64) -> Iterator[int]:
    """How many of these rows come next, again and again, so that with ``each`` for every row they have about ``most``, or are one row."""
    n = total = 0
    for size in sizes:
        if n and total + size + each > most:
            yield n
            n = total = 0
        n, total = n + 1, total + size + each
    if n:
        yield n


def positional(df: DataFrame) -> DataFrame:
    """The same columns under plain names, which mapInArrow needs; its function takes them by position."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def ranked(df: DataFrame, keys: list[str], order: list[str], out: str, spread: int = SPREAD) -> DataFrame:
    """Number the rows of each group of ``keys`` from 0 without gaps, in a column ``out``.

    No task holds a whole group: rows go to ``spread`` sub-buckets by a hash of ``order``, are
    numbered there, and get the rows of all earlier sub-buckets added. Rows that are equal in
    ``order`` share a sub-bucket; their numbers are interchangeable.
    """
    sub, off = f"{out}__sub", f"{out}__off"
    x = df.withColumn(sub, F.pmod(F.xxhash64(*[F.col(c) for c in order], F.lit(17)), F.lit(spread)))
    counts = x.groupBy(*keys, sub).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(sub).rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(
        *[F.col(k).alias(f"{out}__k{i}") for i, k in enumerate(keys)],
        F.col(sub).alias(f"{out}__s"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(off),
    )
    inside = Window.partitionBy(*keys, sub).orderBy(*order)
    x = x.withColumn(out, F.row_number().over(inside) - 1)
    cond = F.col(sub) == F.col(f"{out}__s")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"{out}__k{i}"))
    return x.join(offs, cond).select(*df.columns, (F.col(out) + F.col(off)).cast("long").alias(out))
