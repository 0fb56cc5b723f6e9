"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised separately, so a cell is a pair of centroids. A query goes
through the pairs by rising sum of its two distances, with a heap, until the cells it has seen hold
``coverage`` of all vectors, and those vectors are scored exactly. (Vectors of no clear structure in
many dimensions need a large coverage for a high recall; tests measure recall against brute force.)

Cells are put together into blocks of about ``block`` rows, and cells with more rows are split over
several; queries are cut into chunks. A task scores one chunk against one block, whatever the size
of the table; only their number grows.

Every row is a vector of its own: rows of equal ids are all queries and all candidates.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomsift.llm.common import frugal, stage, table

#: Neighbours of a query, and which ids are queries.
NEAREST = 20
EVERY = 20
#: Centroids of each half, and vectors they are fitted on at most (those of the least hash of vector and id).
CENTROIDS = 64
SAMPLE = 10_000
ROUNDS = 12
#: Share of all vectors that the visited cells hold at least.
COVERAGE = 0.5
#: Rows that they hold at least for each neighbour asked for, if there are so many; so a few candidates are all found.
FLOOR = 10
#: Rows of a block, and queries of a chunk.
BLOCK = 4096
CHUNK = 4096
#: Queries whose scores are held at once.
AT_ONCE = 256


def usable(vectors: DataFrame) -> DataFrame:
    """row (a number that tells rows apart), vec_id and embedding (doubles) of the vectors that take part.

    Out go vectors that are null, empty, zero, or have a component that is null or not finite.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    x = x.filter(F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda v: v != 0))
    return stage(x.select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding"), "mi-vectors")


def centroids(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 0) -> np.ndarray:
    """k-means from distinct rows."""
    rng = np.random.default_rng(seed)
    x = np.asarray(x)
    distinct = np.unique(x, axis=0) if x.shape[1] else x[:1]
    c = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        near = nearest(x, c)
        for j in range(len(c)):
            if (mine := near == j).any():
                c[j] = x[mine].mean(axis=0)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(axis=1) - 2 * x @ c.T, axis=1)


def traverse(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells by rising d1 + d2 until they hold ``enough`` rows; counts by cell."""
    o1, o2 = np.argsort(d1, kind="stable").tolist(), np.argsort(d2, kind="stable").tolist()
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    n2 = len(o2)
    next_in = [0] * len(o1)  # of each place in o1, how far its row has come
    heap = [(s1[0] + s2[0], 0, 0)]
    out, held = [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = o1[i] * n2 + o2[j]
        if n := int(counts[cell]):
            out.append(cell)
            held += n
        next_in[i] = j + 1
        if j + 1 < n2 and (i == 0 or next_in[i - 1] > j + 1):
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
        if i + 1 < len(o1) and next_in[i + 1] == j:
            heapq.heappush(heap, (s1[i + 1] + s2[j], i + 1, j))
    return out


def blocks(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First block and number of blocks of each cell, and the number of all blocks."""
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    at = held = 0
    for cell in np.flatnonzero(counts).tolist():
        n = int(counts[cell])
        if held and held + n > size:
            at, held = at + 1, 0
        first[cell] = at
        if n > size:
            parts[cell] = -(-n // size)
            at, held = at + int(parts[cell]), 0
        else:
            held += n
    return first, parts, at + 1


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the same order wherever it stands, so equal vectors tie."""
    return np.einsum("ij,kj->ik", queries, rows, optimize=False)


OUT = "query_id long, rank int, vec_id long, score double"
#: What stands for a null vec_id where ids are ordered: ties go to it last.
LAST = np.iinfo(np.int64).max


def search(vectors: DataFrame, k: int = NEAREST, every: int = EVERY, coverage: float = COVERAGE, centres: int = CENTROIDS, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose vec_id ``every`` divides, by largest inner product.

    See ``usable`` for which vectors take part. Vectors of unlike lengths have no inner product:
    each length is searched on its own, one after another. Every row is a candidate for every query
    but itself, those of equal ids and vectors too; rows of a null id are candidates only. Ties go to
    the smaller vec_id, to null last. With fewer than k others all found are returned. No usable
    vectors give no rows.
    """
    x = usable(vectors)
    found = None
    for r in x.select(F.size("embedding").alias("d")).distinct().orderBy("d").collect():
        part = search_alike(x.filter(F.size("embedding") == r["d"]), r["d"], k, every, coverage, centres, sample, block)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else vectors.sparkSession.createDataFrame([], OUT)


def salted(rows: np.ndarray) -> np.ndarray:
    """A hash of row numbers, not negative."""
    with np.errstate(over="ignore"):
        return (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)


def search_alike(x: DataFrame, size: int, k: int, every: int, coverage: float, centres: int, sample: int, block: int) -> DataFrame:
    """``search`` over row, vec_id, embedding of one length, which is not empty."""
    picked = x.select("embedding").orderBy(F.xxhash64("embedding", "vec_id"), "vec_id").limit(sample).collect()
    fit = np.array([r["embedding"] for r in picked])
    half = size // 2
    c1, c2 = centroids(fit[:, :half], centres), centroids(fit[:, half:], centres)

    def as_matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy().reshape(len(column), size)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = as_matrix(b.column(2))
            cell = nearest(v[:, :half], c1) * len(c2) + nearest(v[:, half:], c2)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32())], names=["row", "vec_id", "embedding", "cell"])

    index = stage(x.select("row", "vec_id", "embedding").mapInArrow(frugal(assign), "row long, vec_id long, embedding array<double>, cell int"), "mi-index")
    counts = np.zeros(len(c1) * len(c2), np.int64)
    for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["cell"]] = r["n"]
    first, parts, _ = blocks(counts, block)
    chosen = F.pmod(F.col("vec_id"), F.lit(every)) == 0
    chunks = max(1, -(-index.filter(chosen).count() // CHUNK))
    enough = max(FLOOR * k, int(np.ceil(coverage * counts.sum())))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, cell = b.column(0).to_numpy(), b.column(3).to_numpy()
            where = first[cell] + salted(rows) % parts[cell]
            for c in range(chunks):
                yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(np.full(len(rows), c)), *b.columns], names=["block", "chunk", "row", "vec_id", "embedding", "cell"])

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                v = as_matrix(part.column(2))
                chunk = salted(part.column(0).to_numpy()) % chunks
                to_block, who, cells_of = [], [], []
                # squared distances to the centroids, less what is the same for all cells
                d1, d2 = (c1 * c1).sum(axis=1) - 2 * v[:, :half] @ c1.T, (c2 * c2).sum(axis=1) - 2 * v[:, half:] @ c2.T
                for i in range(len(v)):
                    cells = np.sort(np.array(traverse(d1[i], d2[i], counts, enough), np.int64))
                    to: dict[int, list[int]] = {}
                    for cell, f, p in zip(cells.tolist(), first[cells].tolist(), parts[cells].tolist(), strict=True):
                        for n in range(f, f + p):
                            to.setdefault(n, []).append(cell)
                    to_block += to
                    cells_of += to.values()
                    who += [i] * len(to)
                who = np.array(who, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to_block, pa.int64()), pa.array(chunk[who]), *[part.column(j).take(pa.array(who)) for j in range(3)], pa.array(cells_of, pa.list_(pa.int32()))],
                    names=["block", "chunk", "row", "query_id", "query", "cells"],
                )

    def score(base: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        ids = pa.array([], pa.int64())
        if base.num_rows and asked.num_rows:
            base, asked = base.combine_chunks(), asked.combine_chunks()
            cell = base.column("cell").to_numpy()
            order = np.argsort(cell, kind="stable")
            cell, own = cell[order], base.column("row").to_numpy()[order]
            ids = base.column("vec_id").combine_chunks().take(pa.array(order))
            tie = ids.fill_null(LAST).to_numpy()
            rows = np.ascontiguousarray(as_matrix(base.column("embedding").combine_chunks())[order])
            starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            ends = np.append(starts[1:], len(cell))
            asking, qids = asked.column("row").to_numpy(), asked.column("query_id").to_numpy()
            queries = np.ascontiguousarray(as_matrix(asked.column("query").combine_chunks()))
            cells = asked.column("cells").combine_chunks()
            for at in range(0, len(qids), AT_ONCE):
                q, qr, qi = queries[at : at + AT_ONCE], asking[at : at + AT_ONCE], qids[at : at + AT_ONCE]
                wanted = np.zeros((len(qi), len(starts)), bool)
                for i, c in enumerate(cells.slice(at, AT_ONCE)):
                    wanted[i] = np.isin(cell[starts], c.values.to_numpy(), assume_unique=True)
                s = np.full((len(qi), len(own)), -np.inf)
                for j, (a, e) in enumerate(zip(starts, ends, strict=True)):
                    if len(who := np.flatnonzero(wanted[:, j])):
                        s[who, a:e] = scores(q[who], rows[a:e])
                s[qr[:, None] == own[None, :]] = -np.inf
                kth = np.partition(s, -k, axis=1)[:, -k] if len(own) > k else np.full(len(qi), -np.inf)
                i, j = np.nonzero((s >= kth[:, None]) & (s > -np.inf))
                o = np.lexsort((tie[j], -s[i, j], i))
                i, j = i[o], j[o]
                keep = np.arange(len(i)) - np.searchsorted(i, i) < k
                i, j = i[keep], j[keep]
                found.append((qr[i], qi[i], j, s[i, j]))
        row, query, at, value = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 3 + [np.empty(0)]
        return pa.table({"row": pa.array(row, pa.int64()), "query_id": pa.array(query, pa.int64()), "vec_id": ids.take(pa.array(at, pa.int64())), "score": pa.array(value, pa.float64())})

    base = index.mapInArrow(frugal(place), "block long, chunk long, row long, vec_id long, embedding array<double>, cell int")
    asked = index.filter(chosen).select("row", "vec_id", "embedding").mapInArrow(frugal(plan), "block long, chunk long, row long, query_id long, query array<double>, cells array<int>")
    part = base.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(score, "row long, query_id long, vec_id long, score double")
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return part.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id 20 divides."""
    return search(table(spark, sf_dir, "embeddings"))
