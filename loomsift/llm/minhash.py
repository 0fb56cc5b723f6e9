"""Near-duplicate documents by BagMinHash signatures of their multisets of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.llm.common import frugal, stage, table
from loomsift.operators.components import components

#: Words in a shingle, and the least weighted Jaccard similarity of near-duplicates.
SHINGLE = 5
SIMILARITY = 0.8
#: Two texts of that similarity share no band with probability (1 - 0.8 ** ROWS) ** BANDS, 5e-6.
BANDS = 40
ROWS = 6
#: Words of the documents that are signed together.
BATCH_WORDS = 200_000
#: Members that a centre's text is sent along with, about.
CHUNK = 512
#: Rounds in which the members of a bucket are held against one of them, before those still open are compared in blocks.
ROUNDS = 2
#: Members and characters of a block.
BLOCK = 512
BLOCK_CHARS = 16_000_000

GOLDEN = np.uint64(0x9E3779B97F4A7C15)  # fixed values of the SplitMix64 generator
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SIGNED = "k1 long, k2 long, doc_id long, bag binary, bands array<long>"


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def bags(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle hash and count of each different shingle, ordered by text and hash.

    Words are what white space separates. A text of fewer than ``size`` words is one shingle; one
    without words has none.
    """
    split = [t.split() if t else [] for t in texts]
    known = {w: xxhash.xxh64_intdigest(w) for w in set().union(*split)}
    lens = np.fromiter(map(len, split), np.int64, len(split))
    total = int(lens.sum())
    get = known.__getitem__
    word = np.fromiter((h for s in split for h in map(get, s)), np.uint64, total)
    ends = np.cumsum(lens)
    doc = np.repeat(np.arange(len(split)), lens)
    rest = ends[doc] - np.arange(total) if total else np.empty(0, np.int64)  # words from here to the text's end
    with np.errstate(over="ignore"):
        h = np.zeros(total, np.uint64)
        padded = np.concatenate([word, np.zeros(size, np.uint64)])
        for j in range(size):
            inside = np.where(rest > j, padded[j : j + total], np.uint64(0))
            h = h * GOLDEN + mix(inside + np.uint64(j + 1))
        h = mix(h)
    starts = ends - lens
    use = (rest >= size) | ((lens[doc] < size) & (np.arange(total) == starts[doc])) if total else np.empty(0, bool)
    doc, h = doc[use], h[use]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h)))


def bagminhash(doc: np.ndarray, element: np.ndarray, count: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures (n by m) of n bags given by text number, element hash and count; equal components have probability weighted Jaccard.

    Weights are discretised to units. An element has a hierarchy of Poisson processes of points over
    (weight, position), one for each of the dyadic weight intervals [0, 1), [1, 2), [2, 4), ...,
    which depend on the element alone; a bag sees the points below its weight, and each component
    keeps the least position among the points that fall to it. Of the one interval that lies across
    the weight, points in units beyond it are passed over (thinned), which leaves a Poisson process
    on the units below; at most half of an element's points are. Points come in rising order, and
    an element stops when its next one lies beyond all components of its bag, so work is about the
    size of the bag plus m log m. Bags without elements get infinities.
    """
    least = np.full((n, m), np.inf)
    flat = least.reshape(-1)
    ids, seeds, width, low, weight = [doc], [element], [np.ones(len(doc))], [np.zeros(len(doc), np.int64)], [count]
    lo = 1
    while (more := count > lo).any():
        ids.append(doc[more])
        seeds.append(mix(element[more] + np.uint64(lo * int(GOLDEN) % 2**64)))
        width.append(np.full(int(more.sum()), float(lo)))
        low.append(np.full(int(more.sum()), lo))
        weight.append(count[more])
        lo *= 2
    doc, seed, width, low, weight = (np.concatenate(x) for x in (ids, seeds, width, low, weight))
    x = np.zeros(len(doc))
    step = np.uint64(0)
    rounds = 0
    with np.errstate(over="ignore"):
        while len(doc):
            step += GOLDEN
            h = mix(seed + step)
            x = x - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
            h = mix(h + GOLDEN)
            part = ((h >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            unit = low + (((h & np.uint64(0xFFFFFFFF)).astype(np.float64)) * 2.0**-32 * width).astype(np.int64)
            seen = unit < weight
            np.minimum.at(flat, doc[seen] * m + part[seen], x[seen])
            rounds += 1
            if rounds < 16 or rounds % 16 == 0:
                used = np.unique(doc)
                top = np.zeros(n)
                top[used] = least[used].max(axis=1)
                going = x <= top[doc]
                doc, seed, width, low, weight, x = (v[going] for v in (doc, seed, width, low, weight, x))
    return least


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash of each band's rows (n by bands, as signed 64-bit numbers)."""
    bits = signatures.view(np.uint64).reshape(len(signatures), bands, rows)
    with np.errstate(over="ignore"):
        h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, bits.shape[:2]).copy()
        for r in range(rows):
            h = mix(h * GOLDEN + bits[:, :, r])
    return h.view(np.int64)


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two bags (sorted hashes, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / max(int(a[1].sum()) + int(b[1].sum()) - both, 1)


def row_key(*columns: str) -> list[Column]:
    """k1 and k2: two hashes that tell a row by these columns; nulls count by their place."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(7), *parts).alias("k2")]


def sign(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """SIGNED of docs with doc_id and text: row key, digest of the bag and hashes of the bands (null without words)."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]

    def batch(rows_: list[tuple]) -> pa.RecordBatch:
        doc, h, count = bags([r[3] for r in rows_], size)
        hashes = band_hashes(bagminhash(doc, h, count, len(rows_), bands * rows), bands, rows)
        ends = np.searchsorted(doc, np.arange(len(rows_) + 1))
        digests = [xxhash.xxh3_128_digest(h[s:e].tobytes() + count[s:e].tobytes()) if e > s else None for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        cols = [[r[i] for r in rows_] for i in range(3)] + [digests, [None if d is None else x for d, x in zip(digests, hashes, strict=True)]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["k1", "k2", "doc_id", "bag", "bands"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        chars = 0
        for b in batches:
            for k in range(0, b.num_rows, 256):
                for r in zip(*[c.to_pylist() for c in b.slice(k, 256).columns], strict=True):
                    held.append(r)
                    chars += len(r[3] or "") + 64
                    if chars > 6 * BATCH_WORDS:
                        yield batch(held)
                        held, chars = [], 0
        if held:
            yield batch(held)

    return docs.select(*row_key("doc_id", "text"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(frugal(run), SIGNED)


def verify(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """ca, cb of the pairs a (centre), b (member) whose bags have at least that weighted Jaccard; texts: v, text.

    The members of a centre are dealt to chunks of about CHUNK; each chunk has the centre's text
    once, before its members, and goes through a task as a stream.
    """
    pairs = stage(pairs, "nd-pairs")
    chunks = stage(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("n")).filter("n > 1").select(F.col("a").alias("__a"), "n"), "nd-chunks")
    dealt = pairs.join(chunks, F.col("a") == F.col("__a"), "left").select("a", "b", "ca", "cb", F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("b"), F.col("n"))).alias("part"))
    text = lambda key: texts.select(F.col("v").alias(key), "text")
    members = dealt.hint("merge").join(text("b"), "b").select("a", "part", F.lit(1).alias("kind"), "ca", "cb", "text")
    centres = dealt.select("a", "part", "ca").distinct().hint("merge").join(text("a"), "a").select("a", "part", F.lit(0).alias("kind"), "ca", F.col("ca").alias("cb"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre: tuple[np.ndarray, np.ndarray] | None = None
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                doc, h, n = bags(part.column(5).to_pylist(), size)
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1)).tolist()
                good = []
                for kind, i, j in zip(part.column(2).to_pylist(), ends[:-1], ends[1:], strict=True):
                    if kind == 0:
                        centre = h[i:j], n[i:j]
                    good.append(kind == 1 and jaccard(centre, (h[i:j], n[i:j])) >= similarity)
                yield part.select(["ca", "cb"]).filter(pa.array(good, pa.bool_()))

    together = members.unionByName(centres).repartition("a", "part").sortWithinPartitions("a", "part", "kind")
    return together.mapInArrow(frugal(run), "ca binary, cb binary")


def elements(text: str, size: int = SHINGLE) -> np.ndarray:
    """A bag's elements as a set: a shingle's k-th occurrence is an element of its own, so sets overlap as the bags do."""
    _, h, c = bags([text], size)
    if len(h) and c.max() > 1:
        h, nth = np.repeat(h, c), np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        with np.errstate(over="ignore"):
            h = np.where(nth > 0, mix(h + nth.astype(np.uint64) * GOLDEN), h)
    return h


def alike(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs, one of each list, whose sets have at least that Jaccard; by way of the elements that both lists have."""
    overlap = np.zeros((len(left), len(right)), np.int32)
    la, lb = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    ha, hb = np.concatenate([*left, np.empty(0, np.uint64)]), np.concatenate([*right, np.empty(0, np.uint64)])
    oa, ob = np.argsort(ha, kind="stable"), np.argsort(hb, kind="stable")
    da, db = np.repeat(np.arange(len(left)), la)[oa], np.repeat(np.arange(len(right)), lb)[ob]
    ua, sa, na = np.unique(ha[oa], return_index=True, return_counts=True)
    ub, sb, nb = np.unique(hb[ob], return_index=True, return_counts=True)
    _, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    for s, n, t, m in zip(sa[i].tolist(), na[i].tolist(), sb[j].tolist(), nb[j].tolist(), strict=True):
        overlap[da[s : s + n, None], db[None, t : t + m]] += 1
    return np.nonzero(overlap >= similarity * (la[:, None] + lb[None, :] - overlap) - 1e-9)


def compare_blocks(rest: DataFrame, texts: DataFrame, similarity: float, size: int) -> DataFrame:
    """ca, cb that connect the alike members of each bucket of rest (bucket, v, c), all pairs of which are held against each other.

    Members are dealt to blocks of about BLOCK rows and BLOCK_CHARS characters, and a task has two
    blocks of a bucket; pairs never become rows, and of the links found only those come out that
    connect something new there.
    """
    x = rest.join(texts.withColumn("n", F.length("text")), "v")
    sizes = x.groupBy("bucket").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_CHARS)).cast("int").alias("blocks"))
    x = x.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("p"), F.greatest(o, F.col("block")).alias("q")))
    x = x.select("bucket", "c", "text", "block", F.explode(others).alias("o")).select("bucket", "c", "text", "block", "o.p", "o.q")

    def run(t: pa.Table) -> pa.Table:
        p, q = t.column("p")[0].as_py(), t.column("q")[0].as_py()
        names, block = t.column("c").to_pylist(), t.column("block").to_numpy()
        sets = [elements(x, size) for x in t.column("text").to_pylist()]
        first, second = np.flatnonzero(block == p), np.flatnonzero(block == q)
        root = {n: n for n in names}

        def find(n: bytes) -> bytes:
            while root[n] != n:
                root[n] = root[root[n]]
                n = root[n]
            return n

        out = []
        for i, j in zip(*alike([sets[k] for k in first], [sets[k] for k in second], similarity), strict=True):
            a, b = find(names[first[i]]), find(names[second[j]])
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((min(a, b), max(a, b)))
        return pa.table({"ca": pa.array([x for x, _ in out], pa.binary()), "cb": pa.array([y for _, y in out], pa.binary())})

    return x.groupBy("bucket", "p", "q").applyInArrow(run, "ca binary, cb binary")


def relabel(labels: DataFrame, good: DataFrame) -> DataFrame:
    """labels (v, c) after the components that ca, cb of good connect have become one."""
    up = components(good.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(F.col("v").alias("c"), F.col("c").alias("__up"))
    return stage(labels.join(up, "c", "left").select("v", F.coalesce("__up", "c").alias("c")), "nd-labels")


def links(signed: DataFrame, docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE, rounds: int = ROUNDS) -> DataFrame:
    """v, c: the component of each bag that shares a bucket with another.

    At first each bag is held against one other: in the largest of its buckets the member that
    shares most buckets with others, the centre; what is alike becomes one component. From then on
    come only buckets whose members are not all in one component yet. In each of ``rounds`` rounds
    such a bucket has a centre, a member of the component that has most members there, and only the
    members of other components are held against it. The members of buckets that are open after that
    are compared in blocks. So every pair of a bucket is either compared or already connected.
    Joins are made the same way at every size.
    """
    bag = signed.filter(F.col("bag").isNotNull()).groupBy(F.col("bag").alias("v")).agg(F.first("bands").alias("bands"), F.min(F.struct("k1", "k2")).alias("k"))
    bag = stage(bag, "nd-bags")
    all_ = bag.select("v", F.explode("bands").alias("bucket"))
    sizes = stage(all_.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1), "nd-buckets")
    members = stage(all_.hint("merge").join(sizes, "bucket"), "nd-members")
    score = stage(members.groupBy("v").agg(F.sum("size").alias("score"), F.max(F.struct("size", "bucket")).alias("largest")), "nd-scores")
    keys = score.select("v").hint("merge").join(bag.select("v", "k.k1", "k.k2"), "v")
    src = docs.select(*row_key("doc_id", "text"), "text")
    texts = stage(src.join(keys.hint("merge"), ["k1", "k2"]).select("v", "text").dropDuplicates(["v"]), "nd-texts")

    def held_against(members: DataFrame, centre: DataFrame) -> DataFrame:
        pairs = members.select("bucket", F.col("v").alias("b"), F.col("c").alias("cb")).hint("merge").join(centre, "bucket").filter(F.col("ca") != F.col("cb"))
        return verify(pairs.select("a", "b", "ca", "cb").distinct(), texts, similarity, size)

    members = stage(members.hint("merge").join(score.select("v", "score"), "v").select("bucket", "v", "score"), "nd-ranked")
    top = members.groupBy("bucket").agg(F.max(F.struct("score", "v")).alias("r"))
    centre = stage(top.select("bucket", F.col("r.v").alias("a"), F.col("r.v").alias("ca")), "nd-centres")
    labels = relabel(score.select("v", F.col("v").alias("c")), held_against(score.select("largest.bucket", "v", F.col("v").alias("c")), centre))
    for k in range(rounds + 1):
        order = F.col("score") if k == 0 else F.xxhash64("v", F.lit(k))
        found = members.hint("merge").join(labels, "v").select("bucket", "v", "score", "c", order.alias("rank"))
        parts = found.groupBy("bucket", "c").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("rank", "v")).alias("top"))
        most = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("all"), F.max(F.struct("n", "c", "top")).alias("m")).filter("parts > 1")
        if k:
            most = most.filter("all > 2")  # two members have been held against each other
        centre = stage(most.select("bucket", F.col("m.top.v").alias("a"), F.col("m.c").alias("ca")), "nd-open")
        if not centre.limit(1).count():
            break
        found = stage(found.hint("merge").join(centre.select("bucket"), "bucket", "left_semi"), "nd-left")
        if k < rounds:
            labels = relabel(labels, held_against(found, centre))
            members = found.select("bucket", "v", "score")
        else:
            labels = relabel(labels, compare_blocks(found.select("bucket", "v", "c"), texts, similarity, size))
    return labels


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """k1, k2, doc_id, class_id, class_key of every row of docs with doc_id and text.

    A class is what links of at least ``similarity`` connect; its id is the least doc_id in it, and
    its key is no other class's (null for texts without words).
    Texts of the same bag of shingles are linked. Texts without words (null, empty, white space)
    are in no class but their own. A null doc_id is passed over for the class's id unless all are
    null. Equal rows are in the same class, except those without words. An empty table gives an
    empty result.
    """
    signed = stage(sign(docs, bands, rows, size), "nd-signed")
    labels = links(signed, docs, similarity, size)
    lone = signed.filter(F.col("bag").isNull()).select("k1", "k2", "doc_id", F.col("doc_id").alias("class_id"), F.lit(None).cast("binary").alias("class_key"))
    rest = signed.filter(F.col("bag").isNotNull()).select("k1", "k2", "doc_id", F.col("bag").alias("v"))
    rest = rest.join(labels, "v", "left").select("k1", "k2", "doc_id", F.coalesce("c", "v").alias("c"))
    rest = stage(rest, "nd-classes")
    ids = stage(rest.groupBy("c").agg(F.min("doc_id").alias("class_id")), "nd-ids")  # a table of its own, so the join can split a large class
    return rest.join(ids, "c").select("k1", "k2", "doc_id", "class_id", F.col("c").alias("class_key")).unionByName(lone)


def op3_bagminhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id")
