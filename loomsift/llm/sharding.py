"""Sharding by a weighted hash tree of regions, racks and shards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.llm.common import ranked, stage, table


@dataclass(frozen=True)
class Shard:
    """A leaf of the tree; its weight counts in its rack and region too."""

    shard: int
    rack: int
    region: int
    weight: float = 1.0


def even_tree(shards: int = 24, racks: int = 6, regions: int = 2) -> list[Shard]:
    """Shards dealt evenly over racks, racks evenly over regions."""
    return [Shard(s, s * racks // shards, (s * racks // shards) * regions // racks) for s in range(shards)]


def one_more(tree: list[Shard], weight: float = 1.0) -> Shard:
    """A new shard for the lightest rack (the first of equals)."""
    load: dict[tuple[int, int], float] = {}
    for s in tree:
        load[s.region, s.rack] = load.get((s.region, s.rack), 0.0) + s.weight
    region, rack = min(load, key=lambda k: (load[k], k))
    return Shard(max(s.shard for s in tree) + 1, rack, region, weight)


def draw(key: Column, name: Column, weight: Column) -> Column:
    """An exponential draw of rate ``weight`` that key and the node's name decide alone."""
    u = (F.shiftrightunsigned(F.xxhash64(key, name), 11) + F.lit(0.5)) * F.lit(2.0**-53)
    return -F.log(u) / weight


def levels(tree: list[Shard]) -> list[list[list[tuple[int, str, float]]]]:
    """The tree by level: for each node above, its children (their number on the next level, or the shard's), names and weights."""
    region_of: dict[int, list[Shard]] = {}
    rack_of: dict[tuple[int, int], list[Shard]] = {}
    for s in sorted(tree, key=lambda s: (s.region, s.rack, s.shard)):
        region_of.setdefault(s.region, []).append(s)
        rack_of.setdefault((s.region, s.rack), []).append(s)
    weight = lambda shards: float(sum(s.weight for s in shards))
    number = {k: i for i, k in enumerate(rack_of)}
    top = [(i, f"region-{r}", weight(v)) for i, (r, v) in enumerate(region_of.items())]
    middle = [[(number[k], f"rack-{k[0]}-{k[1]}", weight(v)) for k, v in rack_of.items() if k[0] == r] for r in region_of]
    bottom = [[(s.shard, f"shard-{s.shard}", float(s.weight)) for s in v] for v in rack_of.values()]
    return [[top], middle, bottom]


def descend(df: DataFrame, key: str, tree: list[Shard]) -> DataFrame:
    """The rows with __at, the shard in which a descent from the root ends, and __won, the draw that won among the regions.

    On each level the children of the node that was reached draw by their weights, and the least
    draw wins: a region is picked in proportion to its weight, then a rack of that region, then a
    shard of that rack. A row makes as many draws as the nodes on its way have children. A changed
    weight moves rows only into or out of the subtree below it.
    """
    keep = [F.col(f"`{c}`") for c in df.columns]
    x = df.select(*keep, F.lit(0).alias("__at"))
    for depth, nodes in enumerate(levels(tree)):

        def of(j: int, field: int, nodes=nodes) -> Column:
            return F.get(F.array(*[F.lit(children[j][field] if j < len(children) else None) for children in nodes]), F.col("__at"))

        # a place without a child has no weight, and so no draw
        draws = [F.struct(draw(F.col(f"`{key}`"), of(j, 1), of(j, 2)).alias("d"), of(j, 0).alias("to")) for j in range(max(map(len, nodes)))]
        best = F.array_min(F.filter(F.array(*draws), lambda c: c["d"].isNotNull()))
        x = x.select(*keep, *(["__won"] if depth else []), best.alias("__best"))
        x = x.select(*keep, "__won" if depth else F.col("__best.d").alias("__won"), F.col("__best.to").alias("__at"))
    return x


def assign(df: DataFrame, key: str, tree: list[Shard], out: str = "shard", added: list[Shard] | None = None, out_added: str = "grown_shard") -> DataFrame:
    """Add each row's shard, and with ``added`` its shard after those have joined the tree.

    An added shard's weight counts in its rack and region, so there a second draw stands for the
    increment: where it beats what won among the regions, the row goes down the increment, and the
    only thing at its end is the new shard. All other rows descend as before, so the new shard takes
    rows, in proportion to its weight, and nothing else moves.
    Nulls: a null key is a key like any other; all its rows share a shard. Rows of equal keys
    share a shard. An empty table gives an empty result. Other columns pass through; columns
    named as the outputs are replaced.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c not in (out, out_added)]
    x = descend(df.select(*keep), key, tree)
    shard = F.col("__at").cast("int").alias(out)
    if not added:
        return x.select(*keep, shard)
    new = [F.struct(draw(F.col(f"`{key}`"), F.lit(f"shard-{s.shard}"), F.lit(float(s.weight))).alias("d"), F.lit(s.shard).alias("to")) for s in added]
    return x.select(*keep, shard, F.least(F.struct(F.col("__won").alias("d"), F.col("__at").alias("to")), *new)["to"].cast("int").alias(out_added))


def shard_documents(docs: DataFrame, shards: int = 24, racks: int = 6, regions: int = 2) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    size: the text's UTF-8 bytes plus 8; a null text counts as empty in size and CRC. slot: the
    place in the shard, gapless from 0, in an order that hashes of the rows give. Rows of equal
    doc_id share a shard and get slots of their own.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"))
    tree = even_tree(shards, racks, regions)
    placed = stage(assign(slim, "doc_id", tree, added=[one_more(tree)]), "shards")
    return ranked(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op4_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of 6 racks in 2 regions, by doc_id."""
    return shard_documents(table(spark, sf_dir, "documents"))
