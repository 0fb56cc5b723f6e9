"""The quality record of a text, run statistics, and readability measures of our own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.config import EngineConfig
from loomsift.functions.text import WS
from loomsift.operators import lexicon, rules

#: Words that join sentences, for the measure of coherence.
TRANSITIONS = ("因此", "但是", "然而", "所以", "而且", "首先", "其次", "最后", "however", "therefore", "moreover", "finally")
ERROR = "division by zero"


def combined(scores: dict[str, Column], weights: dict[str, float]) -> Column:
    """Weighted mean of the scores that are there; 0 if none is."""
    total, weight = F.lit(0.0), F.lit(0.0)
    for name, s in scores.items():
        w = weights[name]
        total = total + F.coalesce(s * F.lit(w), F.lit(0.0))
        weight = weight + F.when(s.isNotNull(), F.lit(w)).otherwise(F.lit(0.0))
    return F.coalesce(F.try_divide(total, weight), F.lit(0.0))


def quality(df: DataFrame, text: str = "text", words: list[str] | None = None, config: EngineConfig = EngineConfig(), extra: dict[str, str] | None = None) -> DataFrame:
    """The rows with quality_score, is_high_quality, error, component_scores and component_results.

    ``extra`` names columns with scores of other components (perplexity_score, clustering_score). A
    null or empty text is an error: no score, not of high quality.
    """
    keep = df.columns
    x = rules.score(rules.checks(rules.metrics(df.withColumn("__text", F.col(f"`{text}`")), "__text", config.rule.ngram), config.rule), config.rule)
    t = F.col("__text")
    x = x.withColumns({f"__{k}": c for k, c in lexicon.density(t, words, config.feature).items()})
    x = x.withColumn("__feature_score", lexicon.feature_score(t, F.col("__feature_words")))
    empty = F.coalesce(F.length(t), F.lit(0)) == 0
    parts = {"rule_score": F.col("rule_score"), "feature_score": F.col("__feature_score"), **{k: F.col(v) for k, v in (extra or {}).items()}}
    parts = {k: v for k, v in parts.items() if k in config.enabled or k in (extra or {})}
    score = combined(parts, dict(config.weights))
    named = [parts.get(k, F.lit(None).cast("double")).alias(k) for k, _ in config.weights]
    results = F.struct(
        F.struct(F.col("rule_passed").alias("passed"), F.col("rule_details").alias("details")).alias("rule_filter"),
        F.struct(F.col("__feature_passed").alias("passed"), F.struct(F.col("__feature_count").alias("feature_count"), F.col("__feature_words").alias("feature_words"), F.col("__avg_per_line").alias("avg_per_line")).alias("details")).alias("feature_words"),
    )
    return x.select(
        *[F.col(f"`{c}`") for c in keep],
        F.when(~empty, score).alias("quality_score"),
        F.coalesce(F.when(~empty, score >= config.quality_threshold), F.lit(False)).alias("is_high_quality"),
        F.when(empty, F.lit(ERROR)).alias("error"),
        F.when(~empty, F.struct(*named)).alias("component_scores"),
        F.when(~empty, results).alias("component_results"),
    )


def stats(scored: DataFrame) -> DataFrame:
    """One row: total, high_quality, low_quality. Texts that gave an error are of low quality."""
    return scored.agg(F.count(F.lit(1)).alias("total"), F.count_if("is_high_quality").alias("high_quality"), F.count_if(~F.col("is_high_quality")).alias("low_quality"))


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), rf"[{WS}]+", -1), lambda w: w != "")


def readability(c: Column) -> dict[str, Column]:
    """coherence (transition words a sentence), complexity (different words over all) and cohesion (share of words in more than one sentence's worth of use): our own definitions."""
    w = tokens(c)
    n = F.size(w)
    sentences = F.greatest(F.regexp_count(c, F.lit(r"[。！？.!?]+")), F.lit(1))
    joins = None
    for t in TRANSITIONS:
        k = F.regexp_count(F.lower(c), F.lit(t))
        joins = k if joins is None else joins + k
    return {"coherence": joins / sentences, "complexity": F.try_divide(F.size(F.array_distinct(w)), n), "cohesion": F.lit(1.0) - F.try_divide(F.size(F.array_distinct(w)), n)}
