"""Cosine similarity, duplicate ratio, density clustering and k-means over vectors.

Pairs are compared in blocks: a task holds two blocks of rows and compares them tile by tile, and gives
out only pairs above the threshold, or what is asked of a row, so memory is bounded and no pair is a row
of its own before that. A row is dealt out once for each block; there are at most BLOCKS of them, as long
as blocks have no more than BLOCK_BYTES, so what is dealt out grows with the rows and not with their square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomsift.config import ClusterConfig
from loomsift.operators.components import components
from loomsift.storage import stage

#: Rows of a tile, and of the smallest block.
BLOCK = 2048
#: Blocks that rows are dealt to, and bytes of a block's vectors from which there are more.
BLOCKS, BLOCK_BYTES = 24, 64 << 20
NO_LABEL = np.iinfo(np.int64).max


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null where one is zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def _numbered(df: DataFrame, key: str, vector: str, n: int) -> DataFrame:
    """id, v, d (its length), block; vectors that are null or hold a null or no finite number take no part. Vectors of unlike lengths have no cosine and never meet."""
    kind = df.select(F.col(f"`{vector}`")).schema[0].dataType.simpleString()
    x = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast(kind if kind == "array<float>" else "array<double>").alias("v"))
    whole = ~F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    return x.filter(F.col("v").isNotNull() & whole).withColumn("d", F.size("v")).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)))


def _matrix(t: pa.Table, column: str) -> np.ndarray:
    m = t.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(t.num_rows, -1) if t.num_rows else np.zeros((0, 0))
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def block_count(df: DataFrame, vector: str, size: int = BLOCK) -> int:
    """Blocks of ``size`` rows at least: BLOCKS of them at most, or as many as keep a block's vectors within BLOCK_BYTES."""
    rows, most = df.agg(F.count(F.lit(1)), F.max(F.size(F.col(f"`{vector}`").cast("array<double>")))).first()
    fit = max(1, BLOCK_BYTES // (8 * max(most or 0, 1)))
    return max(1, -(-rows // min(max(size, -(-rows // BLOCKS)), fit)))


def _dealt(x: DataFrame, n: int) -> DataFrame:
    """Rows with the pairs of blocks p, q that they take part in, each pair of blocks a group of its own."""
    others = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda o: F.struct(F.least(o.cast("long"), F.col("block")).alias("p"), F.greatest(o.cast("long"), F.col("block")).alias("q")))
    dealt = x.withColumn("o", F.explode(others)).select(*x.columns, "o.p", "o.q")
    return dealt.repartition(n * (n + 1) // 2, "d", "p", "q")  # by number: few bytes are much work here, so groups are not put together


def _blocks(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table, pa.Table, bool]:
    """The two blocks of a group, and whether they are one."""
    t = pa.Table.from_batches(list(batches))
    p, q = t.column("p")[0].as_py(), t.column("q")[0].as_py()
    left = t.filter(pc.equal(t.column("block"), p))
    return left, left if p == q else t.filter(pc.equal(t.column("block"), q)), p == q


def _tiles(a: np.ndarray, b: np.ndarray, same: bool, tile: int, wanted: Callable[[slice, slice], bool] = lambda x, y: True) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Rows and products of the tiles of two blocks; of a block with itself those on and above the diagonal."""
    for i in range(0, len(a), tile):
        for j in range(i if same else 0, len(b), tile):
            x, y = slice(i, min(i + tile, len(a))), slice(j, min(j + tile, len(b)))
            if wanted(x, y):
                yield x, y, a[x] @ b[y].T


def similar_pairs(df: DataFrame, key: str, vector: str, threshold: float, size: int = BLOCK) -> DataFrame:
    """a, b, cos of all pairs a < b with a cosine of at least the threshold; zero vectors have cosine 0.

    Rows of equal ids make no pair with each other. See ``_numbered`` for vectors that take no part.
    """
    n = block_count(df, vector, size)
    tile = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, same = _blocks(batches)
        a, b = left.column("id").to_numpy(), right.column("id").to_numpy()
        for x, y, s in _tiles(_matrix(left, "v"), _matrix(right, "v"), same, tile):
            i, j = np.nonzero(s >= threshold)
            if same and x == y:
                i, j = i[i < j], j[i < j]
            u, w, c = a[x][i], b[y][j], s[i, j]
            m = u != w
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, w)[m]), pa.array(np.maximum(u, w)[m]), pa.array(c[m])], names=["a", "b", "cos"])

    return _dealt(_numbered(df, key, vector, n), n).groupBy("d", "p", "q").applyInArrow(run, "a long, b long, cos double")


def _neighbours(df: DataFrame, key: str, vector: str, threshold: float, n: int) -> DataFrame:
    """id, n: how many rows of other ids have a cosine of at least the threshold with rows of this id, if any."""

    tile = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, same = _blocks(batches)
        a, b = left.column("id").to_numpy(), right.column("id").to_numpy()
        of_a, of_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        for x, y, s in _tiles(_matrix(left, "v"), _matrix(right, "v"), same, tile):
            near = s >= threshold
            if same:  # equal ids are in one block
                near &= a[x, None] != b[None, y]
            of_a[x] += near.sum(axis=1)
            if not same or x != y:
                of_b[y] += near.sum(axis=0)
        for ids, k in ((a, of_a), (b, of_b)):
            yield pa.RecordBatch.from_arrays([pa.array(ids[k > 0]), pa.array(k[k > 0])], names=["id", "n"])

    found = _dealt(_numbered(df, key, vector, n), n).groupBy("d", "p", "q").applyInArrow(run, "id long, n long")
    return found.groupBy("id").agg(F.sum("n").alias("n"))


def _links(rows: DataFrame, threshold: float, n: int) -> DataFrame:
    """a, b: links between rows of ``_numbered`` that connect all that pairs above the threshold connect, at most one a row and pair of blocks."""

    tile = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, same = _blocks(batches)
        a, b = left.column("id").to_numpy(), right.column("id").to_numpy()
        ids, off = (a, 0) if same else (np.concatenate([a, b]), len(a))
        root = np.arange(len(ids))

        def open_(x: slice, y: slice) -> bool:
            u, w = root[x], root[off + y.start : off + y.stop]
            return bool((u != u[0]).any() or (w != u[0]).any())

        for x, y, s in _tiles(_matrix(left, "v"), _matrix(right, "v"), same, tile, open_):
            i, j = np.nonzero(s >= threshold)
            i, j = x.start + i, off + y.start + j
            while True:
                u, w = root[i], root[j]
                m = u != w
                if not m.any():
                    break
                i, j, u, w = i[m], j[m], u[m], w[m]
                root[np.maximum(u, w)] = np.minimum(u, w)  # one of several wins, the others meet again
                while (up := root[root]).tobytes() != root.tobytes():
                    root[:] = up
        m = ids != ids[root]
        yield pa.RecordBatch.from_arrays([pa.array(ids[m]), pa.array(ids[root][m])], names=["a", "b"])

    return _dealt(rows, n).groupBy("d", "p", "q").applyInArrow(run, "a long, b long")


def _two_sided(q: DataFrame, c: DataFrame, nq: int, nc: int) -> tuple[DataFrame, DataFrame]:
    """Rows of both sides under the pair of blocks (block, o) that each takes part in."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    c = c.withColumnRenamed("block", "__o").withColumn("block", every(nq)).withColumnRenamed("__o", "o")
    return tuple(x.repartition(nq * nc, "d", "block", "o") for x in (q.withColumn("o", every(nc)), c))


def duplicate_ratio(queries: DataFrame, corpus: DataFrame, key: str, vector: str, exclude_self: bool = False, size: int = BLOCK) -> DataFrame:
    """id, duplicate_ratio: each query's largest cosine with the corpus, whatever the blocks; 0 where the corpus has no vector of its length.

    Queries of equal ids are one, with the largest. See ``_numbered`` for vectors that take no part.
    """
    if queries is corpus:
        part = _own_ratio(queries, key, vector, exclude_self, size)
    else:
        nq, nc, tile = block_count(queries, vector, size), block_count(corpus, vector, size), BLOCK
        q, c = _two_sided(_numbered(queries, key, vector, nq), _numbered(corpus, key, vector, nc), nq, nc)

        def run(a: pa.Table, b: pa.Table) -> pa.Table:
            best, ids, others = np.full(a.num_rows, -np.inf), a.column("id").to_numpy(), b.column("id").to_numpy()  # an empty block says nothing
            if a.num_rows and b.num_rows:
                for x, y, s in _tiles(_matrix(a, "v"), _matrix(b, "v"), False, tile):
                    if exclude_self:
                        s[ids[x, None] == others[None, y]] = -np.inf
                    best[x] = np.maximum(best[x], s.max(axis=1))
            return pa.table({"id": a.column("id").cast(pa.int64()), "r": pa.array(best)})

        part = q.groupBy("d", "block", "o").cogroup(c.groupBy("d", "block", "o")).applyInArrow(run, "id long, r double")
    return part.groupBy("id").agg(F.max("r").alias("r")).select("id", F.when(F.col("r") == float("-inf"), 0.0).otherwise(F.col("r")).alias("duplicate_ratio"))


def _own_ratio(df: DataFrame, key: str, vector: str, exclude_self: bool, size: int) -> DataFrame:
    """id, r of ``duplicate_ratio`` within one table, by pair of blocks; each product serves both of its rows."""
    n = block_count(df, vector, size)
    tile = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, same = _blocks(batches)
        a, b = left.column("id").to_numpy(), right.column("id").to_numpy()
        best, of_b = np.full(len(a), -np.inf), np.full(len(b), -np.inf)
        for x, y, s in _tiles(_matrix(left, "v"), _matrix(right, "v"), same, tile):
            if exclude_self and same:  # equal ids are in one block
                s[a[x, None] == b[None, y]] = -np.inf
            best[x] = np.maximum(best[x], s.max(axis=1))
            of_b[y] = np.maximum(of_b[y], s.max(axis=0))
        for ids, r in ((a, best), (b, of_b)):
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(r)], names=["id", "r"])

    return _dealt(_numbered(df, key, vector, n), n).groupBy("d", "p", "q").applyInArrow(run, "id long, r double")


def cluster_score(r: Column, threshold: float = 0.85) -> Column:
    """Score of a duplicate ratio: 1 far below the threshold, .8 at it from below, .2 from it on, 0 at 1."""
    over = F.greatest(F.lit(0.0), F.lit(0.2) * (1 - (r - threshold) / (1 - threshold)))
    under = F.least(F.lit(1.0), F.lit(0.8) + F.lit(0.2) * (1 - r / threshold))
    return F.when(r >= threshold, over).otherwise(under)


def dbscan(df: DataFrame, key: str, vector: str, config: ClusterConfig = ClusterConfig()) -> DataFrame:
    """id, label: density clusters by cosine; -1 is noise.

    A row with ``min_cluster_size`` rows at the threshold or above, itself one of them, is core; cores
    that are so near are in one cluster; other rows that near to a core join the cluster of the
    least label among them. Labels go by the least core id of a cluster.
    """
    n, t, tile = block_count(df, vector), config.similarity_threshold, BLOCK
    ids = df.select(F.col(key).cast("long").alias("id"))
    degree = stage(_neighbours(df, key, vector, t, n), "dbscan-degrees")
    core = degree.filter(F.col("n") + 1 >= config.min_cluster_size).select("id") if config.min_cluster_size > 1 else ids
    core = stage(core, "dbscan-core")
    inner = _links(_numbered(df, key, vector, n).join(core, "id", "left_semi"), t, n)
    comp = components(inner)
    root = core.join(comp.withColumnRenamed("v", "id"), "id", "left").select("id", F.coalesce("c", "id").alias("root"))
    # labels count clusters, of which there are far fewer than rows
    names = root.select("root").distinct().select("root", (F.row_number().over(Window.orderBy("root")) - 1).alias("label"))
    cores = stage(root.join(names, "root").select("id", "label"), "dbscan-labels")
    # what is near to something, but not core: each takes the least label near to it
    edge = df.join(degree.select(F.col("id").alias("__id")).join(core.select(F.col("id").alias("__id")), "__id", "left_anti"), F.col(f"`{key}`").cast("long") == F.col("__id"), "left_semi")
    nq = block_count(edge, vector)
    q, c = _two_sided(_numbered(edge, key, vector, nq), _numbered(df, key, vector, n).join(cores, "id"), nq, n)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        least = np.full(a.num_rows, NO_LABEL)
        if a.num_rows and b.num_rows:
            order = np.argsort(b.column("label").to_numpy(), kind="stable")
            b = b.take(pa.array(order))
            labels = b.column("label").to_numpy().astype(np.int64)
            for x, y, s in _tiles(_matrix(a, "v"), _matrix(b, "v"), False, tile):
                near = s >= t
                found = np.where(near.any(axis=1), labels[y][near.argmax(axis=1)], NO_LABEL)
                least[x] = np.minimum(least[x], found)
        m = least < NO_LABEL
        return pa.table({"id": pa.array(a.column("id").to_numpy()[m], pa.int64()), "label": pa.array(least[m], pa.int64())})

    border = q.groupBy("d", "block", "o").cogroup(c.groupBy("d", "block", "o")).applyInArrow(run, "id long, label long").groupBy("id").agg(F.min("label").alias("label"))
    return ids.join(cores.unionByName(border), "id", "left").select("id", F.coalesce("label", F.lit(-1)).alias("label"))


def cluster_sizes(labels: DataFrame) -> DataFrame:
    """label, n of each cluster and of noise."""
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def kmeans(df: DataFrame, key: str, vector: str, k: int, seed: int = 42) -> DataFrame:
    """id, cluster by k-means."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    x = df.select(F.col(key).cast("long").alias("id"), array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(x).transform(x).select("id", "cluster")


def top_similar(queries: DataFrame, index: DataFrame, key: str, vector: str, k: int = 10, size: int = BLOCK) -> DataFrame:
    """query_id, rank, id, cos: each query's k most similar rows of a vector index, by blocks."""
    nq, nc = block_count(queries, vector, size), block_count(index, vector, size)
    q, c = _two_sided(_numbered(queries, key, vector, nq), _numbered(index, key, vector, nc), nq, nc)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if a.num_rows and b.num_rows:
            ids, of, v, w = b.column("id").to_numpy(), a.column("id").to_numpy(), _matrix(a, "v"), _matrix(b, "v").T
            for x in range(0, len(v), 64):
                for i, s in enumerate(v[x : x + 64] @ w, x):
                    j = np.flatnonzero(s >= np.partition(s, -k)[-k]) if k < len(s) else np.arange(len(s))
                    rows += [(int(of[i]), int(ids[o]), float(s[o])) for o in j[np.lexsort((ids[j], -s[j]))[:k]]]
        return pa.table({"query_id": pa.array([r[0] for r in rows], pa.int64()), "id": pa.array([r[1] for r in rows], pa.int64()), "cos": pa.array([r[2] for r in rows], pa.float64())})

    part = q.groupBy("d", "block", "o").cogroup(c.groupBy("d", "block", "o")).applyInArrow(run, "query_id long, id long, cos double")
    best = Window.partitionBy("query_id").orderBy(F.desc("cos"), "id")
    return part.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def hashed_embedding(c: Column, dims: int = 64) -> Column:
    """A stand-in for a text embedding model: signed hashed counts of words, of unit length. It is no such model."""
    from pyspark.sql import types as T

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(texts: pa.Array) -> pa.Array:
        import zlib

        out = []
        for t in texts:
            v = np.zeros(dims)
            for w in (t.as_py() or "").lower().split():
                h = zlib.crc32(w.encode())
                v[h % dims] += 1.0 if h & 0x80000000 else -1.0
            n = float(np.sqrt((v * v).sum()))
            out.append((v / n if n else v).tolist())
        return pa.array(out, pa.list_(pa.float64()))

    return run(c)


def vectors_of(df: DataFrame, embed, batch: int = 100) -> DataFrame:
    """Rows with a text column and what ``embed(list of texts)`` makes of it, in batches; the model is built once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, batch):
                part = b.slice(k, batch)
                v = embed([t or "" for t in part.column(b.schema.get_field_index("text")).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([list(map(float, x)) for x in v], pa.list_(pa.float64()))], names=[*b.schema.names, "embedding"])

    from pyspark.sql import types as T

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("embedding", T.ArrayType(T.DoubleType()))]))
