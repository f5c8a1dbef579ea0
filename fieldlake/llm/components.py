"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldlake.session import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the label is the smallest node reachable.

    Large star: every neighbour above a node is tied to the smallest neighbour; small
    star: every neighbour below, too. Both keep what is connected; the edge table
    turns into one star per component in a number of rounds that grows with the
    logarithm of its length. Minima are combined on the map side, so a hub with many
    edges is no task of its own, and each round is a written table.
    """
    up = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, mark = stored(up, "edges"), None
    while mark != (mark := _mark(now)):
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(least, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        now = stored(tied.select("e.a", F.col("e.m").alias("b")).filter("a <> b").distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select("b", "b").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
