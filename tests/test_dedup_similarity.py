import math
import random

import pytest
from pyspark.sql import functions as F

from loomsift.config import ClusterConfig
from loomsift.operators import dedup, similarity
from loomsift.operators.components import components

X = "a1b2c3d4e5f6g7h8i9j0k"


def brute(text, k):
    gone = [False] * len(text)
    for i in range(len(text) - k + 1):
        if text.find(text[i : i + k]) < i:
            gone[i : i + k] = [True] * k
    return "".join(c for c, g in zip(text, gone, strict=True) if not g)


def test_passages():
    assert dedup.drop_repeats("a" * 30) == "a"
    assert dedup.drop_repeats(f"{X}-{X}") == f"{X}-"
    assert dedup.drop_repeats(f"{X[:20]}-{X[:20]}") == f"{X[:20]}-{X[:20]}"
    rng = random.Random(5)
    for _ in range(3000):
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))
        for k in (2, 3, 5):
            assert dedup.drop_repeats(t, k) == brute(t, k), (t, k)


def test_passage_column(spark):
    df = spark.createDataFrame([("a" * 30,), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(dedup.dedup_passages(F.col("t"))).collect()] == ["a", None, ""]


def test_keep_last(spark):
    df = spark.createDataFrame([("f", 1, "x"), ("f", 2, "y"), ("g", 0, "z")], "filename string, offset int, p string")
    assert sorted(tuple(r) for r in dedup.keep_last(df, "filename", ["offset"]).collect()) == [("f", 2, "y"), ("g", 0, "z")]


def test_cluster_score(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.425, 0.9), (0.85, 0.2), (0.925, 0.1), (1.0, 0.0), (-0.2, 1.0)], "r double, want double")
    for r in df.select(similarity.cluster_score(F.col("r")).alias("s"), "want").collect():
        assert r["s"] == pytest.approx(r["want"])


def test_dbscan(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0])], "id long, v array<double>")
    out = similarity.dbscan(df, "id", "v", ClusterConfig(0.85, 3))
    assert sorted(tuple(r) for r in out.collect()) == [(0, 0), (1, 0), (2, 0), (3, -1)]


def test_duplicate_ratio(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "id long, v array<double>")
    empty = spark.createDataFrame([], "id long, v array<double>")
    assert sorted(tuple(r) for r in similarity.duplicate_ratio(q, q, "id", "v").collect()) == [(1, 1.0), (2, 0.0)]
    assert {r["duplicate_ratio"] for r in similarity.duplicate_ratio(q, empty, "id", "v").collect()} <= {0.0}


def test_pairs_do_not_depend_on_blocks(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    a = {(r["a"], r["b"]) for r in similarity.similar_pairs(df, "id", "v", 0.8).collect()}
    b = {(r["a"], r["b"]) for r in similarity.similar_pairs(df, "id", "v", 0.8, 7).collect()}
    assert a == b and a


def test_ratio_does_not_depend_on_blocks(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [-1.0, 1.0 + i / 10]) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    want = {r["id"]: r["duplicate_ratio"] for r in similarity.duplicate_ratio(df, df, "id", "v", True).collect()}
    assert want[0] < -0.5
    assert {r["id"]: r["duplicate_ratio"] for r in similarity.duplicate_ratio(df, df, "id", "v", True, 1).collect()} == pytest.approx(want)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [1.0]), (3, [2.0]), (4, None), (5, [None, 1.0]), (6, [float("nan"), 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    assert sorted((r["a"], r["b"]) for r in similarity.similar_pairs(df, "id", "v", 0.9).collect()) == [(0, 1), (2, 3)]
    assert sorted(r["id"] for r in similarity.duplicate_ratio(df, df, "id", "v", True).collect()) == [0, 1, 2, 3]
    assert {(r["query_id"], r["id"]) for r in similarity.top_similar(df, df, "id", "v").collect()} == {(a, b) for g in ((0, 1), (2, 3)) for a in g for b in g}


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 101), (101, 100), (7, 7), (50, 40)]
    got = {r["v"]: r["c"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 100: 100, 101: 100, 40: 40, 50: 40}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_embeddings(spark):
    df = spark.createDataFrame([("a b c",), ("a b c",), ("",)], "text string").withColumn("v", similarity.hashed_embedding(F.col("text")))
    rows = df.collect()
    assert rows[0]["v"] == rows[1]["v"] and sum(x * x for x in rows[0]["v"]) == pytest.approx(1)
    assert similarity.vectors_of(df.select("text"), lambda t: [[float(len(x))] for x in t]).collect()[0]["embedding"] == [5.0]


def old_dbscan(rows, t, least):
    """Labels by all pairs, on one machine."""
    near = {i: [j for j, w in rows if j != i and sum(x * y for x, y in zip(v, w, strict=True)) >= t * math.dist(v, [0] * len(v)) * math.dist(w, [0] * len(w))] for i, v in rows}
    core = {i for i in near if len(near[i]) + 1 >= least}
    root: dict = {}
    for i in sorted(core):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = i
                todo += [y for y in near[x] if y in core]
    names = {r: n for n, r in enumerate(sorted(set(root.values())))}
    return {i: names[root[i]] if i in core else min((names[root[j]] for j in near[i] if j in core), default=-1) for i in near}


def test_blocks_are_few_and_deal_no_row_out_often(spark, monkeypatch):
    """Rows are dealt to a fixed number of blocks at most, until blocks are too large for a worker."""
    df = spark.range(100_000).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    assert similarity.block_count(df, "v") == similarity.BLOCKS
    assert similarity.block_count(df, "v", 50_000) == 2
    monkeypatch.setattr(similarity, "BLOCK_BYTES", 16_000)
    assert similarity.block_count(df, "v") == 100


@pytest.mark.parametrize("tile", [3, 2048])
def test_whatever_blocks_and_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(similarity, "BLOCK", tile)
    monkeypatch.setattr(similarity, "BLOCK_BYTES", 11 * 8 * 4)
    rng = random.Random(2)
    rows = [(i * 3, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)] + [(500, [1.0, 0.0, 0.0, 0.0]), (501, [2.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    assert similarity.block_count(df, "v") == 6
    cos = lambda v, w: sum(x * y for x, y in zip(v, w, strict=True)) / math.dist(v, [0] * 4) / math.dist(w, [0] * 4)
    all_ = {(i, j): cos(v, w) for i, v in rows for j, w in rows if i < j}
    assert {(r["a"], r["b"]): r["cos"] for r in similarity.similar_pairs(df, "id", "v", 0.8).collect()} == pytest.approx({p: c for p, c in all_.items() if c >= 0.8})
    want = {i: max(c for p, c in all_.items() if i in p) for i, _ in rows}
    assert {r["id"]: r["duplicate_ratio"] for r in similarity.duplicate_ratio(df, df, "id", "v", True).collect()} == pytest.approx(want)
    other = df.filter("true")
    assert {r["id"]: r["duplicate_ratio"] for r in similarity.duplicate_ratio(df, other, "id", "v", True).collect()} == pytest.approx(want)
    for t, least in ((0.8, 3), (0.9, 3), (0.95, 2), (0.93, 4)):
        assert {r["id"]: r["label"] for r in similarity.dbscan(df, "id", "v", ClusterConfig(t, least)).collect()} == old_dbscan(rows, t, least)
