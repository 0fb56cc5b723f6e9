"""Connected components of a graph given by its edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.storage import stage


def components(edges: DataFrame) -> DataFrame:
    """v, c: the least vertex of the component of each vertex that edges a, b name.

    Each round every vertex hooks onto its least neighbour, if that is less than itself, chains are
    shortened twice, and edges are rewritten between what is left. Rounds are written to the shared
    folder; the number of rounds grows with the logarithm of the longest path.
    """
    labels = None
    edges = stage(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "cc-edges")
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("c"))
        for _ in range(2):
            up = hook.select(F.col("v").alias("c"), F.col("c").alias("__up"))
            hook = hook.join(up, "c").select("v", F.col("__up").alias("c"))
        hook = stage(hook, "cc-hooks")
        if labels is None:
            labels = hook
        else:
            up = hook.select(F.col("v").alias("c"), F.col("c").alias("__up"))
            labels = stage(labels.join(up, "c", "left").select("v", F.coalesce("__up", "c").alias("c")), "cc-labels")
        a, b = hook.select(F.col("v").alias("a"), F.col("c").alias("__a")), hook.select(F.col("v").alias("b"), F.col("c").alias("__b"))
        left = edges.join(a, "a").join(b, "b").select(F.col("__a").alias("a"), F.col("__b").alias("b"))
        edges = stage(left.filter(F.col("a") != F.col("b")).distinct(), "cc-edges")
    return labels if labels is not None else edges.select(F.col("a").alias("v"), F.col("b").alias("c"))
