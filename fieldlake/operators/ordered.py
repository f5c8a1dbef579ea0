"""Order inside a key without putting one key on one task.

A window ``partitionBy(key)`` sends all rows of a key to one task. When one
key can hold a third of the table, that task decides the run time. The
functions here cut the key's order into chunks: rows are ordered inside a
chunk by a window on (key, chunk), counted per chunk, and the counts of
earlier chunks are added up on the small chunk table. Results equal those of
the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldlake.session import stored


def with_chunk_offsets(per_chunk: DataFrame, keys: Sequence[str], chunk: str, size: str, offset: str) -> DataFrame:
    """Sum of ``size`` over the earlier chunks of a key (one row per key and chunk)."""
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.withColumn(offset, F.coalesce(F.sum(size).over(earlier), F.lit(0)))


HOUR = 3_600_000_000


def _bin(time: str) -> Column:
    """The hour of a row, in microseconds; null without a time."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    return micros - F.pmod(micros, F.lit(HOUR))


def hot_spans(rows: DataFrame, key: str, time: str, rows_per_chunk: int) -> DataFrame:
    """For every hour of a key with more than ``rows_per_chunk`` rows, null keys too: the chunk it
    begins in, and the times inside it at which a further chunk begins.

    Cuts follow counts: rows are counted per key and hour on the map side, a running sum
    over the hours says where each ``rows_per_chunk``-th row lies, and hours that hold
    more rows than that are counted again by time. So a chunk has at most
    ``rows_per_chunk`` rows more than wanted, unless more rows than that share one time.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    hours = rows.groupBy(F.col(key).alias("_key"), _bin(time).alias("_hour")).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy("_key"))
    earlier = Window.partitionBy("_key").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    hot = hours.withColumn("_total", total).filter(F.col("_total") > rows_per_chunk).withColumn(
        "_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_total")
    hot = stored(hot, "hot-hours")
    heavy = hot.filter((F.col("_n") > rows_per_chunk) & F.col("_hour").isNotNull())
    times = (
        rows.select(F.col(key).alias("_k"), _bin(time).alias("_h"), micros.alias("_time"))
        .join(heavy, F.col("_k").eqNullSafe(F.col("_key")) & (F.col("_h") == F.col("_hour")))
        .groupBy("_key", "_hour", "_before", "_time").agg(F.count(F.lit(1)).alias("_at")))
    inside = Window.partitionBy("_key", "_hour").orderBy("_time").rowsBetween(Window.unboundedPreceding, -1)
    chunk = F.floor((F.col("_before") + F.coalesce(F.sum("_at").over(inside), F.lit(0))) / rows_per_chunk)
    by_time = times.withColumn("_chunk_of", chunk)
    begins = by_time.groupBy("_key", "_hour", "_chunk_of").agg(F.min("_time").alias("_begin")).groupBy("_key", "_hour").agg(
        F.min("_chunk_of").alias("_first_chunk"), F.sort_array(F.collect_list("_begin")).alias("_begins"))
    same = F.col("_key").eqNullSafe(F.col("k")) & F.col("_hour").eqNullSafe(F.col("h"))
    cuts = begins.select(F.col("_key").alias("k"), F.col("_hour").alias("h"), F.struct("_first_chunk", "_begins").alias("_cut"))
    marked = hot.join(cuts, same, "left").select(
        "_key", "_hour", F.coalesce("_cut._first_chunk", F.floor(F.col("_before") / rows_per_chunk)).alias("_base"),
        F.coalesce(F.slice("_cut._begins", 2, F.greatest(F.size("_cut._begins"), F.lit(1))), F.array().cast("array<bigint>")).alias("_begins"))
    return stored(marked, "hot-spans")


def with_time_chunk(rows: DataFrame, spans: DataFrame, key: str, time: str, how: str = "left") -> DataFrame:
    """Number of the time chunk of each row; 0 for all rows of a key that is not hot.

    Chunks of a key follow the order of time; ``how="inner"`` keeps hot keys only.
    """
    placed = rows.withColumn("_h", _bin(time))
    joined = placed.join(spans, placed[key].eqNullSafe(spans["_key"]) & placed["_h"].eqNullSafe(spans["_hour"]), how)
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    further = F.size(F.filter(F.coalesce("_begins", F.array().cast("array<bigint>")), lambda b: b <= micros))
    return joined.withColumn("_chunk", F.coalesce(F.col("_base") + further, F.lit(0))).drop("_h", "_key", "_hour", "_base", "_begins")


def cut_points(rows: DataFrame, key: str, order: Column, tie: str, cuts: dict[str, Column],
               chunk: Column) -> DataFrame:
    """For every key the (order, tie) pair at given ranks, one column per cut.

    ``cuts`` maps column names to a rank worked out from the key's row count
    ``total``; ``chunk`` must follow ``order`` (a prefix of it). Rows are counted
    per (key, chunk) on the map side; only the few chunks that hold a cut are
    sorted, so hardly any row is shuffled.
    """
    marked = rows.select(key, order.alias("_order"), F.col(tie).alias("_tie"), chunk.alias("_chunk"))
    sizes = marked.groupBy(key, "_chunk").agg(F.count(F.lit(1)).alias("_size"))
    per_key = Window.partitionBy(key)
    offsets = with_chunk_offsets(sizes, [key], "_chunk", "_size", "_offset").withColumn(
        "total", F.sum("_size").over(per_key))
    named = F.array(*[F.struct(F.lit(n).alias("name"), rank.cast("long").alias("rank")) for n, rank in cuts.items()])
    wanted = offsets.withColumn("_cut", F.explode(named)).filter(
        (F.col("_cut.rank") > F.col("_offset")) & (F.col("_cut.rank") <= F.col("_offset") + F.col("_size"))
    ).select(key, "_chunk", F.col("_cut.name").alias("_name"), (F.col("_cut.rank") - F.col("_offset")).alias("_place"))
    inside = Window.partitionBy(key, "_chunk", "_name").orderBy("_order", "_tie")
    found = (
        marked.join(stored(wanted.withColumnRenamed(key, "_key").withColumnRenamed("_chunk", "_cut_chunk"), "cuts"),
                    F.col(key).eqNullSafe(F.col("_key")) & (F.col("_chunk") == F.col("_cut_chunk")))
        .withColumn("_row", F.row_number().over(inside))
        .filter(F.col("_row") == F.col("_place"))
        .withColumn("_pair", F.struct("_order", "_tie"))
    )
    return found.groupBy(key).agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_pair"))).alias(name) for name in cuts])
