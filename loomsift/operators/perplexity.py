"""Perplexity: a character n-gram model counted by Spark, tests and scores.

The model stands in for a neural one and does not give its numbers; any column of perplexities can
take its place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsift.config import PerplexityConfig
from loomsift.functions.text import perplexity_text, plain_perplexity_text, plain_scored_text, scored_text
from loomsift.operators.rules import spam_text
from loomsift.storage import stage

#: Pseudo-count of the model, and characters it takes to be possible.
PSEUDO, POSSIBLE = 0.1, 5000


#: Characters of the longest gram that one number holds, characters counted at once, and grams up to which a model is sent to the workers.
PACKED, PORTION, SENT_GRAMS = 3, 1_000_000, 2_000_000


def grams(df: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """key, gram, n of the k-character strings in each text."""
    found = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"(?s)(?=(.{{{k}}}))."), F.lit(1)))
    return df.select(F.col(key).alias(key), found.alias("gram")).groupBy(key, "gram").agg(F.count(F.lit(1)).alias("n"))


def packed(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k-character strings of all texts as numbers, in order, and the text that each is of."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    lengths = np.array([len(t) for t in texts], np.int64)
    m = max(len(chars) - k + 1, 0)
    code = np.zeros(m, np.int64)
    for i in range(k):
        code = code << 21 | chars[i : i + m]
    whole = np.ones(len(chars), bool)
    for i in range(1, k):  # what begins so near to the end of its text would reach into the next one
        whole[np.maximum(np.cumsum(lengths) - i, 0)[lengths > 0]] = False
    whole = whole[:m]
    return code[whole], np.repeat(np.arange(len(texts)), lengths)[:m][whole]


def unpacked(codes: np.ndarray, k: int) -> list[str]:
    chars = np.stack([codes >> 21 * (k - 1 - i) & 0x1FFFFF for i in range(k)], 1).astype(np.uint32)
    text = chars.tobytes().decode("utf-32-le", "surrogatepass")
    return [text[i : i + k] for i in range(0, len(text), k)]


def portions(texts: list[str | None], most: int = PORTION) -> Iterator[tuple[int, int]]:
    """First and last place of neighbours that have about so many characters together, or are one text."""
    first = total = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > first and total + n > most:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(texts):
        yield first, len(texts)


def train(df: DataFrame, text: str, k: int = 3, prepare: Callable[[str], str] = str) -> DataFrame:
    """gram, n, context: counts of k-character strings over all texts, and of their first k - 1 characters.

    Workers count a portion of texts at a time, so a gram is a row once a portion, not once a place; up to
    PACKED characters they make of each text what ``prepare`` says.
    """
    if k <= PACKED:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(0).to_pylist()
                for i, j in portions(texts):
                    codes, n = np.unique(packed([prepare(t or "") for t in texts[i:j]], k)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(unpacked(codes, k), pa.string()), pa.array(n, pa.int64())], names=["gram", "n"])

        all_ = df.select(F.col(text).alias("t")).mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    else:
        all_ = df.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(f"(?s)(?=(.{{{k}}}))."), F.lit(1))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    context = all_.groupBy(F.substring("gram", 1, k - 1).alias("c")).agg(F.sum("n").alias("context"))
    return all_.join(context, F.substring("gram", 1, k - 1) == F.col("c")).select("gram", "n", "context")


class Lookup:
    """Logarithms of the probabilities of k-character strings under a model, by binary search."""

    def __init__(self, rows: pa.Table, k: int):
        text = rows.column("gram").to_pylist()
        n, context = (rows.column(c).to_numpy().astype(float) for c in ("n", "context"))
        codes = packed(text, k)[0]
        order = np.argsort(codes)
        self.codes, self.logs = codes[order], np.log((n + PSEUDO) / (context + PSEUDO * POSSIBLE))[order]
        self.heads, at = np.unique(self.codes >> 21, return_index=True)
        self.unseen = np.log(PSEUDO / (context[order][at] + PSEUDO * POSSIBLE))

    def of(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(len(codes), np.log(PSEUDO / (PSEUDO * POSSIBLE)))
        for known, values, wanted in ((self.heads, self.unseen, codes >> 21), (self.codes, self.logs, codes)):
            if len(known):
                at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                hit = known[at] == wanted
                out[hit] = values[at[hit]]
        return out


def sendable(model: DataFrame, k: int) -> bool:
    """Whether a model is small enough to be sent to the workers."""
    return k <= PACKED and model.limit(SENT_GRAMS + 1).count() <= SENT_GRAMS


def log_sums(df: DataFrame, keep: list[str], text: str, model: DataFrame, k: int, prepare: Callable[[str], str] = str) -> DataFrame:
    """The columns to keep, __p, __s, __n: each row's prepared text, its sum of logarithms and number of k-character strings, by a model that is sent to the workers."""
    sent = df.sparkSession.sparkContext.broadcast(Lookup(model.toArrow(), k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for i, j in portions(texts):
                made = [None if t is None else prepare(t) for t in texts[i:j]]
                codes, of = packed([t or "" for t in made], k)
                s, n = np.bincount(of, sent.value.of(codes), j - i).astype(float), np.bincount(of, minlength=j - i)  # of nothing, bincount gives integers
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns[:-1], pa.array(made, pa.string()), pa.array(s), pa.array(n, pa.int64())], names=names)

    x = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__p"))
    fields = [*x.schema.fields, T.StructField("__s", T.DoubleType()), T.StructField("__n", T.LongType())]
    names = [f.name for f in fields]
    return x.mapInArrow(run, T.StructType(fields))


def perplexity(df: DataFrame, key: str, text: str, model: DataFrame, k: int = 3) -> DataFrame:
    """key, perplexity of each text of at least k characters under the model.

    A model of up to SENT_GRAMS goes to the workers, and texts give a row each; grams are joined to a larger one.
    """
    model = stage(model.select("gram", "n", "context"), "ngram-model")
    if sendable(model, k):
        return log_sums(df, [key], text, model, k).filter("__n > 0").groupBy(key).agg(F.exp(-F.sum("__s") / F.sum("__n")).alias("perplexity"))
    return joined(df, key, text, model, k)


def joined(df: DataFrame, key: str, text: str, model: DataFrame, k: int) -> DataFrame:
    """``perplexity`` by joins of each text's grams to the model."""
    contexts = model.select(F.substring("gram", 1, k - 1).alias("c"), "context").dropDuplicates(["c"])
    own = grams(df, key, text, k).select(key, "gram", F.col("n").alias("times"), F.substring("gram", 1, k - 1).alias("c"))
    own = own.join(model.select("gram", "n"), "gram", "left").join(contexts, "c", "left")
    p = (F.coalesce("n", F.lit(0)) + PSEUDO) / (F.coalesce("context", F.lit(0)) + PSEUDO * POSSIBLE)
    return own.groupBy(key).agg(F.exp(-F.sum(F.col("times") * F.log(p)) / F.sum("times")).alias("perplexity"))


def adjusted(raw: Column, processed: Column, c: PerplexityConfig = PerplexityConfig(), spam: Column | None = None) -> Column:
    """A model's perplexity, at most max_ppl; of spam half as much again, and 240 at least. ``spam``, here and below: spam_text where it is known."""
    ppl = F.least(raw, F.lit(c.max_ppl))
    spam = spam_text(processed) if spam is None else spam
    return F.when(F.coalesce(spam, F.lit(False)), F.greatest(ppl * 1.5, F.lit(c.ppl_threshold * 1.2))).otherwise(ppl)


def passed(ppl: Column, text: Column, c: PerplexityConfig = PerplexityConfig(), spam: Column | None = None) -> Column:
    return (ppl <= c.ppl_threshold) & ~(spam_text(text) if spam is None else spam)


def perplexity_score(ppl: Column, text: Column, c: PerplexityConfig = PerplexityConfig(), spam: Column | None = None) -> Column:
    """1 up to 100, falling to 0 at max_ppl; half for spam; .5 for an empty text, which has no spam test."""
    s = F.when(ppl >= c.max_ppl, 0.0).when(ppl <= 100, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - (ppl - 100) / (c.max_ppl - 100)))
    spam = spam_text(text) if spam is None else spam
    return F.when(spam.isNull(), 0.5).when(spam, s * 0.5).otherwise(s)


def score_texts(df: DataFrame, key: str, text: str, model: DataFrame | None = None, c: PerplexityConfig = PerplexityConfig()) -> DataFrame:
    """key, perplexity, perplexity_passed, perplexity_score; texts too short for the model count as max_ppl.

    Without a model, one is counted on the whole texts; only what is scored is cut to segments.
    """
    whole, cut = partial(plain_perplexity_text, compat_emoji=c.compat_emoji), partial(plain_scored_text, limit=c.segment_chars, compat_emoji=c.compat_emoji)
    if model is None and c.order <= PACKED:
        model = train(df, text, c.order, whole)
    elif model is None:
        model = train(df.select(perplexity_text(F.col(text), c.compat_emoji).alias("__p")), "__p", c.order)
    model = stage(model.select("gram", "n", "context"), "ngram-model")
    told = df.select(F.col(key).alias(key), spam_text(F.col(text)).alias("__spam_t"), F.col(text).alias("__t"))
    spam = [key, "__spam_t", spam_text(F.col("__p")).alias("__spam_p")]  # told here, so that no text goes through the exchange
    if sendable(model, c.order):  # texts of one key count together, and a null key has no model's number, as in the join below
        of = Window.partitionBy(key)
        raw = F.when(F.col(key).isNotNull() & (F.sum("__n").over(of) > 0), F.exp(-F.sum("__s").over(of) / F.sum("__n").over(of)))
        x = log_sums(told, [key, "__spam_t"], "__t", model, c.order, cut).select(*spam, "__s", "__n")
        x = x.select(key, "__spam_t", "__spam_p", raw.alias("perplexity"))
    else:
        prepared = told.select(key, "__spam_t", scored_text(F.col("__t"), c.segment_chars, c.compat_emoji).alias("__p"))
        x = prepared.select(*spam).join(joined(prepared, key, "__p", model, c.order), key, "left")
    x = x.withColumn("perplexity", adjusted(F.coalesce("perplexity", F.lit(c.max_ppl)), F.lit(None), c, F.col("__spam_p")))
    return x.select(key, "perplexity", passed(F.col("perplexity"), F.lit(None), c, F.col("__spam_t")).alias("perplexity_passed"), perplexity_score(F.col("perplexity"), F.lit(None), c, F.col("__spam_t")).alias("perplexity_score"))
