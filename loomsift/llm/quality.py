"""Quality classifier from weak labels: heuristic labellers, expectation-maximisation, a hashed linear scorer."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsift.llm.common import frugal, positional, stage, table

BAD, NONE, GOOD = 0, 1, 2
SAID = np.array([1.0, 0.0, 1.0])  # votes that count
#: Dimensions of the hashed features.
DIMS = 1 << 13
#: Documents with posterior labels that the scorer is trained on, at most; the least by a hash of text and id.
SAMPLE = 8000
#: Rounds of expectation-maximisation, passes of training, and its step and decay.
EM_STEPS = 200
PASSES = 30
STEP = 0.5
DECAY = 1e-6
#: A document of a lower score is rejected.
THRESHOLD = 0.5
#: Words under which the labellers that compare words abstain.
FEW = 20

NAMES = ("symbols", "capitals", "word variety", "word runs", "separators", "shouting", "odd endings", "repeated lines", "word length", "sentences", "prose share")

_CLASS = bytearray(b"s" * 256)
for _b in range(256):
    _c = chr(_b)
    if _b >= 0x80 or "a" <= _c <= "z":
        _CLASS[_b] = ord("a")
    elif "A" <= _c <= "Z":
        _CLASS[_b] = ord("A")
    elif _c.isdigit():
        _CLASS[_b] = ord("0")
    elif _c in " \t\r\x0b\x0c":
        _CLASS[_b] = ord(" ")
    elif _c in "\n.,!?;:'\"-()|":
        _CLASS[_b] = _b
CLASS = bytes(_CLASS)
_CODES = np.zeros(256, np.int64)
for _i, _x in enumerate(sorted(set(CLASS)), 1):
    _CODES[_x] = _i
ENDING = re.compile(r"[^\w\s.,;:!?'\"()\-»”’…]\Z")


@dataclass
class Facts:
    """What the labellers look at."""

    chars: int
    words: int
    symbols: float
    capitals: float
    variety: float
    run: int
    separators: float
    shouts: float
    odd: float
    lines: int
    repeated: float
    length: float
    stops: float
    short: float


def facts(text: str) -> Facts:
    """Counts over the whole text."""
    words = text.split()
    n = len(words)
    raw = text.encode("utf-8", "surrogatepass").translate(CLASS)
    count = raw.count
    lower, upper = count(b"a"), count(b"A")
    letters = max(lower + upper, 1)
    run = best = 1 if n else 0
    for x, y in zip(words, words[1:]):
        run = run + 1 if x == y else 1
        if run > best:
            best = run
    lines = [x for x in text.split("\n") if x.strip()]
    ends = [w[-1] for w in words]
    last = "".join(ends)
    stop = last.count(".") + last.count("!") + last.count("?")
    odd = sum(last.count(c) for c in "#$%&*+/<=>@\\^_`{}~|")
    total = max(n, 1)
    return Facts(
        len(text), n, (count(b"s") + count(b"|")) / max(len(raw), 1), upper / letters, len(set(words)) / total, best, words.count("|") / total,
        count(b"!") / total, odd / total, len(lines), 1 - len(set(lines)) / max(len(lines), 1), (len(text) - n) / total, stop / total, sum(len(w) <= 3 for w in words) / total,
    )


def votes(f: Facts) -> tuple[int, ...]:
    """One vote of each labeller, in the order of NAMES."""
    many = f.words >= FEW

    def say(bad: bool, good: bool, able: bool = True) -> int:
        return NONE if not able else BAD if bad else GOOD if good else NONE

    def unless(bad: bool, able: bool = True) -> int:
        return say(bad, True, able)

    return (
        unless(f.symbols > 0.05, f.chars >= FEW),
        unless(f.capitals > 0.3, many),
        unless(f.variety < 0.3 / (1 + f.words / 3000) ** 0.5, many),
        unless(f.run >= 4, many),
        unless(f.separators > 0.1, many),
        unless(f.shouts > 0.2, many),
        unless(f.odd > 0.15, many),
        unless(f.repeated > 0.4, f.lines >= 3),
        say(f.length > 12 or f.length < 2.5, 3.5 <= f.length <= 8, many),
        say(f.stops > 0.6 or f.stops == 0, 0.02 <= f.stops <= 0.3, many),
        say(f.short < 0.05 or f.short > 0.9, 0.15 <= f.short <= 0.7, many),
    )


def pattern(f: Facts) -> int:
    """The votes as one number in base 3."""
    out = 0
    for v in votes(f):
        out = 3 * out + v
    return out


def unpack(patterns: np.ndarray, n: int = len(NAMES)) -> np.ndarray:
    return np.stack([patterns // 3 ** (n - 1 - j) % 3 for j in range(n)], axis=1)


@dataclass
class LabelModel:
    """Probability of a good document, and of each labeller's votes on bad (0) and good (1) ones."""

    prior: float
    table: np.ndarray  # labeller, class, vote

    def posterior(self, seen: np.ndarray) -> np.ndarray:
        """Probability that a document with these votes is good; who abstains says nothing."""
        j = np.arange(seen.shape[1])
        log = np.log(self.table)
        said = seen != NONE
        good = np.log(self.prior) + np.where(said, log[j, 1, seen], 0.0).sum(axis=1)
        bad = np.log1p(-self.prior) + np.where(said, log[j, 0, seen], 0.0).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))

    def accuracy(self) -> np.ndarray:
        """Probability that a labeller is right, given that it votes."""
        right = (1 - self.prior) * self.table[:, 0, BAD] + self.prior * self.table[:, 1, GOOD]
        wrong = (1 - self.prior) * self.table[:, 0, GOOD] + self.prior * self.table[:, 1, BAD]
        return right / (right + wrong)


def fit_labels(seen: np.ndarray, counts: np.ndarray, steps: int = EM_STEPS) -> LabelModel:
    """Expectation-maximisation over vote patterns and how often each occurs.

    It starts from documents on which more labellers say bad than good, or at least two say bad.
    """
    bad, good = (seen == BAD).sum(axis=1), (seen == GOOD).sum(axis=1)
    post = np.where((bad >= 2) | (bad > good), 0.1, 0.95)
    model = None
    for _ in range(steps):
        w = np.stack([(1 - post) * counts, post * counts])
        t = np.stack([[np.bincount(seen[:, j], w[c], 3) * SAID + 0.1 for c in (0, 1)] for j in range(seen.shape[1])])
        model = LabelModel(float(np.clip(w[1].sum() / max(w.sum(), 1e-9), 1e-4, 1 - 1e-4)), t / t.sum(axis=2, keepdims=True))
        new = model.posterior(seen)
        if np.abs(new - post).max(initial=0) < 1e-9:
            break
        post = new
    return model


def features(text: str, f: Facts) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a whole text: shares of trigrams of character classes, and steps of the labellers' counts."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(CLASS), np.uint8)
    codes = _CODES[raw]
    half = DIMS // 2
    if len(codes) >= 3:
        tri = (codes[:-2] * 40 + codes[1:-1]) * 40 + codes[2:]
        hist = np.bincount((tri * 2654435761 >> 7) % half, minlength=half)
        at = np.flatnonzero(hist)
        value = np.sqrt(hist[at] / len(tri))
    else:
        at, value = np.empty(0, np.int64), np.empty(0)
    steps = [
        (1, min(int(20 * f.variety * (1 + f.words / 3000) ** 0.5), 40)), (2, min(f.run, 20)), (3, int(20 * f.repeated)), (4, min(int(f.length * 2), 40)),
        (5, int(20 * f.stops)), (6, int(20 * f.short)), (7, int(20 * f.capitals)), (8, min(int(50 * f.shouts), 50)), (9, int(20 * f.odd)), (10, min(int(100 * f.symbols), 50)), (11, min(f.words, FEW)),
    ]
    more = np.array(sorted({half + (k * 7919 + v * 104729) % half for k, v in steps}), np.int64)
    return np.concatenate([at, more]), np.concatenate([value, np.full(len(more), 0.5)])


def packed(at: np.ndarray, value: np.ndarray) -> tuple[bytes, bytes]:
    """Features in six bytes each, so that a sample of long texts still fits the driver: 25 kB a document at most."""
    return at.astype(np.uint16).tobytes(), value.astype(np.float32).tobytes()


def unpacked(at: bytes, value: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(at, np.uint16), np.frombuffer(value, np.float32)


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    """Weights (the last one is the constant) of logistic regression on soft labels, by stochastic gradient with falling steps."""
    w = np.zeros(DIMS + 1)
    share = min(max(float(np.mean([y for *_, y in rows])), 0.02), 0.98) if rows else 0.5
    order = np.random.default_rng(0)
    t = 0
    for _ in range(PASSES):
        for i in order.permutation(len(rows)):
            at, value, y = rows[i]
            p = 1 / (1 + np.exp(-np.clip(w[at] @ value + w[-1], -30, 30)))
            scale = 0.5 / (share if y > 0.5 else 1 - share)
            g = STEP / (1 + t * 1e-4) * (y - p) * min(scale, 5.0)
            w[at] += g * value - DECAY * w[at]
            w[-1] += 0.1 * g
            t += 1
    return w


def label_votes(docs: DataFrame) -> DataFrame:
    """The rows of docs without their text, and ``pattern``."""
    keep = [c for c in docs.columns if c not in ("text", "pattern")]
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("pattern", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([pattern(facts(t.as_py() or "")) for t in b.column(len(keep))], pa.int64())], names=schema.names)

    return positional(docs.select(*[F.col(f"`{c}`") for c in keep], "text")).mapInArrow(frugal(run), schema)


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[LabelModel, np.ndarray]:
    """The label model of all documents, and the scorer's weights.

    The label model takes the votes on every document, counted by pattern (3 to the number of
    labellers at most). The scorer is fitted on ``sample`` documents at most, those of the least
    hash of text; half of the places go to documents with a vote for bad, if there are so many.
    """
    voted = stage(label_votes(docs.select(F.xxhash64("text").alias("key"), "text")), "quality-votes")
    counted = voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = np.array([r["pattern"] for r in counted], np.int64)
    seen = unpack(patterns)
    model = fit_labels(seen, np.array([r["n"] for r in counted], float))
    posterior = dict(zip(patterns.tolist(), model.posterior(seen).tolist(), strict=True))
    bad = [k for k, p in posterior.items() if p < 0.5]
    keys = voted.select("key", "pattern").withColumn("bad", F.col("pattern").isin(bad) if bad else F.lit(False)).distinct()
    half = sample // 2
    low = keys.filter("bad").orderBy("key").limit(half)
    rest = keys.filter("not bad").orderBy("key").limit(sample - half)
    chosen = F.broadcast(low.unionByName(rest).select("key").distinct())  # of ``sample`` rows at most
    schema = "key long, pattern long, at binary, value binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                f = facts(t := t.as_py() or "")
                rows.append((k, pattern(f), *packed(*features(t, f))))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["key", "pattern", "at", "value"])

    picked = docs.select(F.xxhash64("text").alias("key"), "text").join(chosen, "key")
    one_each = picked.mapInArrow(frugal(run), schema).groupBy("key").agg(F.first(F.struct("pattern", "at", "value")).alias("r"))
    rows = sorted((r["key"], r["r"]) for r in one_each.collect())
    return model, fit_scorer([(*unpacked(r["at"], r["value"]), posterior[r["pattern"]]) for _, r in rows])


def score(docs: DataFrame, model: LabelModel, weights: np.ndarray) -> DataFrame:
    """The rows of docs with ``posterior`` (of the label model) and ``score`` (of the scorer, between 0 and 1)."""
    keep = [c for c in docs.columns if c not in ("posterior", "score")]
    text = keep.index("text")
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("posterior", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                texts = [(t or "", facts(t or "")) for t in part.column(text).to_pylist()]
                found = [features(t, f) for t, f in texts]
                z = np.array([weights[at] @ value + weights[-1] for at, value in found])
                post = model.posterior(unpack(np.array([pattern(f) for _, f in texts], np.int64))) if texts else np.empty(0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(post, pa.float64()), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())], names=schema.names)

    return positional(docs.select(*[F.col(f"`{c}`") for c in keep])).mapInArrow(frugal(run), schema)


def classify(docs: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs with posterior, score and ``keep``.

    Null and empty texts are scored like any: labellers that compare words abstain on fewer than
    FEW words. Equal texts get equal scores. An empty table gives an empty result. Other columns
    pass through; columns named as the outputs are replaced.
    """
    model, weights = train(docs, sample)
    return score(docs.drop("keep"), model, weights).withColumn("keep", F.col("score") >= threshold)


def op6_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior label, score and decision of every document."""
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
