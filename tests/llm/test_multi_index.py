import random

import numpy as np

from loomsift.llm import multi_index as mi


def brute(ids, x, q, k):
    s = mi.scores(x[ids == q], x)[0]
    s[ids == q] = -np.inf
    o = np.lexsort((ids, -s))[:k]
    return [(int(ids[j]), float(s[j])) for j in o if s[j] > -np.inf]


def test_traversal_order():
    rng = np.random.default_rng(1)
    for _ in range(50):
        d1, d2 = rng.random(6), rng.random(5)
        counts = rng.integers(0, 3, 30)
        got = mi.traverse(d1, d2, counts, 10**9)
        total = (d1[:, None] + d2[None]).ravel()
        assert sorted(got) == np.flatnonzero(counts).tolist()
        assert (np.diff(total[got]) >= -1e-12).all()
        part = mi.traverse(d1, d2, counts, 7)
        assert part == got[: len(part)] and counts[part].sum() >= min(7, counts.sum())


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in mi.search(df).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hit = total = 0
    for q in ids[ids % 20 == 0]:
        want = brute(ids, x, q, 20)
        mine = [got[q][i + 1] for i in range(20)]
        assert mine == sorted(mine, key=lambda t: (-t[1], t[0]))
        hit += len({v for v, _ in mine} & {v for v, _ in want})
        total += 20
    print("recall at 20", hit / total)
    assert hit / total >= 0.9


def test_all_found_with_full_coverage_and_small_blocks(spark):
    rng = random.Random(3)
    same = [0.5, 0.5, 0.1, -0.2]
    rows = [(i, same if i % 3 == 0 else [rng.gauss(0, 1) for _ in range(4)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    got = {}
    for r in mi.search(df, coverage=1.0, block=50).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 400, 20):
        assert [(v, s) for _, v, s in sorted(got[q])] == brute(ids, x, q, 20)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 0.0]), (None, [1.0, 1.0]), (8, [1.0]), (9, []), (10, [3.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(mi.search(df).collect(), key=lambda r: r[:2])
    first = [(0, 1, 10, 3.0), (0, 2, None, 1.0), (0, 3, 20, 0.0), (0, 4, 20, 0.0)]
    second = [(20, 1, 10, 3.0), (20, 2, 20, 1.0), (20, 3, None, 1.0), (20, 4, 0, 0.0)]
    assert [tuple(r) for r in got] == first + [x for x in second for _ in (1, 2)]
    assert mi.search(df.limit(0)).count() == 0
    assert mi.search(df.filter("vec_id = 3")).count() == 0


def test_rows_of_equal_ids_are_vectors_of_their_own(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (-40, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in mi.search(df).collect())
    want = {
        -40: [[(20, 1.0), (1, 0.0), (1, 0.0), (20, 0.0)]],
        20: [[(1, 1.0), (1, 1.0), (20, 0.5), (-40, 0.0)], [(-40, 1.0), (1, 0.5), (1, 0.5), (20, 0.5)]],
    }
    assert got == sorted((q, i + 1, v, s) for q, lists in want.items() for found in lists for i, (v, s) in enumerate(found))


def test_lengths_are_searched_on_their_own(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (20, [1.0, 1.0]), (21, [1.0, 2.0]), (22, [3.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in mi.search(df).collect())
    assert got == [(0, 1, 22, 3.0), (0, 2, 1, 2.0), (20, 1, 21, 3.0)]
