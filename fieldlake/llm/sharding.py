"""Shards by a weighted hash tree: region, rack, shard.

At every level a row draws one exponential arrival per child node, divided by
the child's weight, and descends to the first arrival. A draw depends on the
row's key and on the node only, so a changed weight moves rows only into or
out of subtrees whose weight changed. Inner weights are the sums of the leaves
below, so each leaf gets its share of the rows.

A tree holds ``BASE`` shards in regions of racks; every further shard is a
region of its own. One more shard thus takes rows only into itself, whatever
the count was.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldlake.llm.common import let, unit
from fieldlake.session import stored

#: Shards per rack, racks per region, regions of the base tree.
SHARDS, RACKS, REGIONS = 5, 2, 4
BASE = SHARDS * RACKS * REGIONS


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(count: int, weights: dict[int, float] | None = None) -> list[Leaf]:
    """The leaves for ``count`` shards; ``weights`` overrides the weight 1 of single shards."""
    weights = weights or {}
    base = [Leaf(s // (SHARDS * RACKS), s // SHARDS, s, weights.get(s, 1.0)) for s in range(min(count, BASE))]
    more = [Leaf(REGIONS + s - BASE, REGIONS * RACKS + s - BASE, s, weights.get(s, 1.0)) for s in range(BASE, count)]
    return [leaf for leaf in base + more if leaf.weight > 0]


def _nodes(leaves: list[Leaf], level: int) -> Column:
    """The children of a node as an array literal of (id, weight, children)."""
    names = ["region", "rack", "shard"]
    ids = sorted({getattr(leaf, names[level]) for leaf in leaves})
    out = []
    for node in ids:
        below = [leaf for leaf in leaves if getattr(leaf, names[level]) == node]
        parts = [F.lit(node).alias("id"), F.lit(float(sum(leaf.weight for leaf in below))).alias("weight")]
        if level < 2:
            parts.append(_nodes(below, level + 1).alias("children"))
        out.append(F.struct(*parts))
    return F.array(*out)


def _first(nodes: Column, key: Column, level: int) -> Column:
    """The child with the first weighted arrival; equal arrivals go to the smaller id."""
    arrivals = F.transform(nodes, lambda n: F.struct(
        (-F.log(unit(key, F.lit(level), n["id"])) / n["weight"]).alias("at"), n["id"].alias("id"), n.alias("node")))
    return F.array_min(arrivals)["node"]


def shard_of(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of a key; rows without a key share the shard of the null key."""
    region = _first(_nodes(leaves, 0), key, 0)
    return let(region, lambda r: let(_first(r["children"], key, 1), lambda k: _first(k["children"], key, 2)["id"]))


def place(docs: DataFrame, count: int) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): size, checksum, shard, slot, and the shard with one more.

    The size is the UTF-8 length plus 16; null text counts as empty (size 16,
    checksum 0). Slots run from 0 without gaps in each shard. The placed keys are
    written once with the partition they came from; ranks are then taken inside
    (shard, partition), and offsets come from the counts, so neither a large shard
    nor a key with many rows lands in one task. Other columns are ignored; an
    empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.xxhash64(F.col("doc_id"))
    placed = stored(docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(key, tree(count)).alias("shard"),
        shard_of(key, tree(count + 1)).alias("grown_shard"),
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_row"),
    ), "placed")
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = stored(counts.select(
        "shard", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")), "slot-offsets")
    inside = Window.partitionBy("shard", "_part").orderBy("_row")
    ranked = placed.withColumn("_rank", F.row_number().over(inside) - 1)
    return ranked.join(offsets, ["shard", "_part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_offset") + F.col("_rank")).cast("long").alias("slot"), "grown_shard")
