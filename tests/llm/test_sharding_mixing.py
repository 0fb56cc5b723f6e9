import math
import random
import re
import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from loomsift.llm import mixing, sharding

from .cases import clashing, documents, empty


def test_shards(spark):
    n = 4000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text é "), F.col("id")).alias("text"))
    rows = sharding.shard_documents(docs).collect()
    slots = defaultdict(list)
    for r in rows:
        assert r["size"] == len(f"text é {r['doc_id']}".encode()) + 8 and r["text_crc32"] == zlib.crc32(f"text é {r['doc_id']}".encode())
        assert r["grown_shard"] in (r["shard"], 24)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(24)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) < 1.4 * n / 24 and 0.6 * n / 25 < sum(r["grown_shard"] == 24 for r in rows) < 1.4 * n / 25
    again = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(docs.limit(100)).collect()}
    assert all(again[r["doc_id"]] == r["shard"] for r in rows if r["doc_id"] in again)


def test_weights_move_rows_only_where_they_change(spark):
    tree = sharding.even_tree()
    heavy = [sharding.Shard(s.shard, s.rack, s.region, 2.0 if s.shard == 5 else 1.0) for s in tree]
    keys = spark.range(5000).select(F.col("id").alias("k"))
    a = {r["k"]: r["shard"] for r in sharding.assign(keys, "k", tree).collect()}
    b = {r["k"]: r["shard"] for r in sharding.assign(keys, "k", heavy).collect()}
    region, rack = {s.shard: s.region for s in tree}, {s.shard: s.rack for s in tree}
    moved = [(a[k], b[k]) for k in a if a[k] != b[k]]
    for x, y in moved:  # into the changed region, or in it into the changed rack, or in that into the changed shard
        assert region[y] == region[5] if region[x] != region[y] else rack[y] == rack[5] if rack[x] != rack[y] else y == 5
    assert 0 < len(moved) < 0.1 * len(a)
    share = Counter(b.values())[5] / 5000
    assert abs(share - 2 / 25) < 0.02


def unit_draw(key, name, weight):
    """Spark's xxhash64(key, name), and an exponential draw from it."""
    seed = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
    return -math.log(((xxhash.xxh64_intdigest(name.encode(), seed) >> 11) + 0.5) * 2.0**-53) / weight


def test_descent_against_brute_force(spark):
    rng = random.Random(4)
    tree = [sharding.Shard(i, i % 5, i % 5 % 3, rng.choice((0.5, 1.0, 3.0))) for i in range(17)]
    added = [sharding.Shard(17, 2, 2, 2.0), sharding.Shard(18, 0, 0, 1.0)]
    rows = sharding.assign(spark.range(3000).select(F.col("id").alias("k")), "k", tree, added=added).collect()
    for r in rows:
        left, wins = tree, []
        for level, name in (("region", "region-{0.region}"), ("rack", "rack-{0.region}-{0.rack}"), ("shard", "shard-{0.shard}")):
            nodes = defaultdict(list)
            for s in left:
                nodes[getattr(s, level)].append(s)
            d, at = min((unit_draw(r["k"], name.format(v[0]), sum(s.weight for s in v)), n) for n, v in nodes.items())
            left = nodes[at]
            wins.append(d)
        assert r["shard"] == left[0].shard
        best = min([(wins[0], left[0].shard), *((unit_draw(r["k"], f"shard-{s.shard}", s.weight), s.shard) for s in added)])
        assert r["grown_shard"] == best[1]
    for s in tree:
        assert abs(sum(r["shard"] == s.shard for r in rows) / 3000 - s.weight / sum(x.weight for x in tree)) < 0.03


def test_odd_rows_in_shards(spark):
    docs = documents(spark)
    rows = sharding.shard_documents(clashing(docs)).collect()
    assert len(rows) == docs.count()
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert next(r["size"] for r in rows if r["doc_id"] == 3) == 8
    assert sharding.shard_documents(empty(docs)).count() == 0


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, out = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in out]
        give = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if give[s] > 2 * sizes[s]]
        if not over:
            return out | give
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]


def test_mix(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        source = rng.choice(["a"] * 6 + ["b", "c", "d", None, "é"])
        rows.append((i, source, " ".join("w" * rng.randrange(1, 3) for _ in range(int(rng.paretovariate(1.2) * 5) % 900))))
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    from loomsift.llm.mixing import mix, word_counts

    def run():
        return sorted((tuple(r) for r in mix(word_counts(docs), ["doc_id"]).collect()))

    got = run()
    assert got == run()
    sizes, taken, told = defaultdict(int), defaultdict(int), {}
    text = {i: t for i, _, t in rows}
    for doc, source, size, source_size, target, copies in got:
        assert size == len(re.findall(r"[^\x20\x09-\x0D]+", text[doc])) and 0 <= copies <= 2
        sizes[source] += size
        taken[source] += size * copies
        told[source] = (source_size, target)
    want = targets(sizes)
    for s in sizes:
        assert told[s][0] == sizes[s] and abs(told[s][1] - want[s]) < 1e-6 * want[s] + 1e-9
        assert abs(taken[s] - want[s]) <= 0.01 * want[s] + 30, s


def test_tilt_meets_the_token_constraint(spark):
    sizes = spark.createDataFrame([("a", z, n) for z, n in ((1, 50), (10, 20), (100, 5))] + [("b", 10, 10), ("c", 7, 30)], "source string, size long, n long")
    t = mixing.source_targets(sizes)
    import math

    rows = mixing.solve(sizes, t).collect()
    hist = {"a": ((1, 50), (10, 20), (100, 5)), "b": ((10, 10),), "c": ((7, 30),)}
    for r in rows:
        if r["lam"] is not None:
            got = sum(n * z * 2 / (1 + math.exp(-r["lam"] * z / r["unit"])) for z, n in hist[r["source"]])
            assert abs(got - r["target"]) < 1e-3 * r["target"]
    assert any(r["lam"] is not None for r in rows)


def test_odd_rows_in_the_mix(spark):
    docs = documents(spark)
    out = mixing.mix(mixing.word_counts(clashing(docs)), ["doc_id"]).collect()
    assert len(out) == docs.count() and all(0 <= r["copies"] <= 2 for r in out)
    assert mixing.mix(mixing.word_counts(empty(docs)), ["doc_id"]).count() == 0
    none = docs.withColumn("text", F.lit(None).cast("string"))
    assert all(r["target"] == 0 for r in mixing.mix(mixing.word_counts(none), ["doc_id"]).collect())
