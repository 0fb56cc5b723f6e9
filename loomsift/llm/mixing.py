"""Mixing sources to target weights by entropy balancing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomsift.llm.common import ranked, stage, table

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Copies of a document at most; a source's target stops at as many times its words.
MOST = 2
#: Words of the mix as a share of all words.
SHARE = 1.5
#: Newton steps at most; a step that is no Newton step halves the bracket, so doubles resolve no more.
STEPS = 80
#: Steps between two looks at how far off the sums still are.
STRIDE = 4


def exact(c: Column) -> Column:
    """A number that sums to the same bits in any order."""
    return c.cast("decimal(28,6)")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, n, target from one row per (source, size) with its count n.

    Water filling: with sources in the order of the weight at which they reach their cap, the
    capped ones are those whose cap is below what the rest of the words would give them.
    """
    everything = Window.partitionBy(F.lit(0))
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("w", F.get(pattern, F.pmod(place, F.lit(len(weights)))))
    per = per.withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("total", F.lit(share) * F.sum("source_size").over(everything))
    by_cap = everything.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    capped_before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("w").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("capped", F.col("cap") <= F.col("w") * (F.col("total") - capped_before) / weight_left)
    level = F.try_divide(
        F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything),
        F.sum(F.when(~F.col("capped"), F.col("w")).otherwise(0.0)).over(everything),
    )
    return per.withColumn("level", level).select(
        "source", "source_size", "n", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * F.col("level")).alias("target")
    )


def rate(lam: Column, x: Column, most: int = MOST) -> Column:
    """Mean copies of a document at tilt ``lam``: 0 to ``most`` copies, each tilted by exp(lam * x)."""
    return F.lit(float(most)) / (F.lit(1.0) + F.exp(-lam * x))


def newton_step(state: DataFrame, hist: DataFrame, most: int) -> DataFrame:
    """One step of each source: gradient and curvature over all its (size, count) rows, then Newton, or half the bracket where that would leave it."""
    keep = ["source", "target", "unit"]
    x = F.col("z") / F.col("unit")
    r = rate(F.col("lam"), x, most)
    sums = (
        state.join(hist, F.col("source").eqNullSafe(F.col("s")))
        .groupBy(*keep, "lam", "lo", "hi")
        .agg(
            F.sum(exact(F.col("k") * F.col("z") * r)).cast("double").alias("got"),
            F.sum(exact(F.col("k") * F.col("z") * r * (1 - r / most) * x)).cast("double").alias("slope"),
        )
    )
    off = F.col("got") - F.col("target")
    lo = F.when(off < 0, F.col("lam")).otherwise(F.col("lo"))
    hi = F.when(off > 0, F.col("lam")).otherwise(F.col("hi"))
    newton = F.col("lam") - F.try_divide(off, F.col("slope"))
    step = F.when(off == 0, F.col("lam")).when((newton > lo) & (newton < hi), newton).otherwise((lo + hi) / 2)
    return sums.select(*keep, step.alias("lam"), lo.alias("lo"), hi.alias("hi"), off.alias("off"))


def solve(sizes: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """targets with the dual solution ``lam`` of each source, and the mean size ``unit`` it refers to.

    The dual is convex in one multiplier for each source. Sums are exact decimals, so reruns agree
    to the bit. Sources whose target is nothing or their cap have no finite multiplier and none here.
    """
    unit = F.greatest(F.try_divide(F.col("source_size"), F.col("n")), F.lit(1e-9))
    inside = (F.col("target") > 0) & (F.col("target") < most * F.col("source_size"))
    state = targets.filter(inside).select("source", "target", unit.alias("unit"), F.lit(0.0).alias("lam"), F.lit(-64.0).alias("lo"), F.lit(64.0).alias("hi"))
    hist = sizes.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("n").alias("k"))
    for _ in range(STEPS // STRIDE):
        for _ in range(STRIDE):
            state = newton_step(state, hist, most)
        state = stage(state, "mix-state")
        left = state.filter((F.abs("off") > 1e-6 * F.col("target") + 1e-3) & (F.col("hi") - F.col("lo") > 1e-12))
        if not left.limit(1).count():
            break
    solved = state.select(F.col("source").alias("__s"), "lam")
    return targets.withColumn("unit", unit).join(solved, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")


def copies_by_class(sizes: DataFrame, solved: DataFrame, most: int = MOST) -> DataFrame:
    """source, size, n, copies: how many copies all the documents of one source and size get together.

    Rates are rounded along the sizes of a source so that the running sum of copies is never off
    by more than half a copy; the words are then off by less than the largest document. What is
    still missing or over is made up by single copies from the smallest documents up.
    """
    s = solved.select(F.col("source").alias("s"), "source_size", "target", "unit", "lam")
    x = sizes.join(s, F.col("source").eqNullSafe(F.col("s")))
    r = F.when(F.col("target") >= most * F.col("source_size"), F.lit(float(most))).when(F.col("target") <= 0, F.lit(0.0)).otherwise(rate(F.coalesce(F.col("lam"), F.lit(0.0)), F.col("size") / F.col("unit"), most))
    x = x.withColumn("e", exact(F.col("n") * r))
    order = Window.partitionBy("source").orderBy("size")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("c", F.sum("e").over(upto))
    x = x.withColumn("copies", (F.floor(F.col("c") + F.lit(0.5)) - F.floor(F.col("c") - F.col("e") + F.lit(0.5))).cast("long"))
    x = x.withColumn("copies", F.least(F.greatest(F.col("copies"), F.lit(0)), most * F.col("n")))
    x = x.withColumn("gap", F.col("target") - F.sum(F.col("copies") * F.col("size")).over(Window.partitionBy("source")))
    room = F.when(F.col("size") == 0, F.lit(0)).when(F.col("gap") > 0, most * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
    x = x.withColumn("room", room)
    below = F.coalesce(F.sum(F.col("room") * F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fits = F.floor(F.try_divide(F.abs("gap") - below, F.col("size")))
    x = x.withColumn("change", F.coalesce(F.least(F.greatest(fits, F.lit(0)), F.col("room")), F.lit(0)))
    return x.select("source", "size", "n", "source_size", "target", (F.col("copies") + F.signum("gap") * F.col("change")).cast("long").alias("copies"))


def mix(rows: DataFrame, tie: list[str], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Rows with columns source, size and ``tie``: adds source_size, target and copies (0 to ``most``).

    Among documents of one source and size, hashes of ``tie`` decide which get the odd copy.
    Nulls: a null source is a source of its own, the last; sizes are not null. Documents of no
    words get copies of no words. Equal rows are documents of their own. An empty table gives an
    empty result.
    """
    sizes = stage(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    solved = stage(solve(sizes, stage(source_targets(sizes, weights, share, most), "mix-targets"), most), "mix-solved")
    classes = copies_by_class(sizes, solved, most).select(
        F.col("source").alias("__s"), F.col("size").alias("__z"), "source_size", "target",
        F.floor(F.col("copies") / F.col("n")).alias("__each"), F.pmod(F.col("copies"), F.col("n")).alias("__extra"),
    )
    placed = ranked(rows, ["source", "size"], tie, "__rank")
    return placed.join(classes, F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z"))).select(
        *rows.columns, "source_size", "target", (F.col("__each") + F.when(F.col("__rank") < F.col("__extra"), 1).otherwise(0)).cast("int").alias("copies")
    )


def word_counts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, source and the text's number of words as size (null: 0)."""
    return docs.select("doc_id", "source", *more, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def op10_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    rows = stage(word_counts(table(spark, sf_dir, "documents")), "mix-words")
    return mix(rows, ["doc_id"]).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
