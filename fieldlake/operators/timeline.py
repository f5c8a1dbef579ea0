"""Readings through time: trends, newest rows, duplicates, gaps, rain spells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fieldlake import constants as K
from fieldlake.operators.ordered import hot_spans, with_chunk_offsets, with_time_chunk


def dedupe(readings: DataFrame, keys=("sensor_id", "timestamp"), tie: str = "event_id") -> DataFrame:
    """One row per key, the one with the lowest tie value.

    ``row_number() = 1`` is planned with a partial limit before the shuffle, so
    copies are cut down on the map side.
    """
    order = Window.partitionBy(*keys).orderBy(tie)
    return readings.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1).drop("_n")


def latest_per_sensor(readings: DataFrame) -> DataFrame:
    """Newest reading of each sensor; the partial limit keeps one row per sensor and task."""
    order = Window.partitionBy("sensor_id").orderBy(F.col("timestamp").desc(), F.col("event_id").desc())
    return readings.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1).drop("_n")


def hourly_trend(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy(F.window("timestamp", "1 hour").alias("w"), "sensor_type")
        .agg(
            F.count(F.lit(1)).alias("n_readings"),
            F.avg("temperature").alias("avg_temperature"),
            F.avg("moisture").alias("avg_moisture"),
        )
        .select(F.col("w.start").alias("window_start"), "sensor_type", "n_readings", "avg_temperature", "avg_moisture")
    )


def within_retention(readings: DataFrame, reference, days: int = K.RETENTION_DAYS) -> DataFrame:
    """Rows not older than the retention, counted from a given reference time."""
    return readings.filter(F.col("timestamp") >= F.lit(reference).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS"))


def missing_slots(readings: DataFrame, hours: int = K.SLOT_HOURS) -> DataFrame:
    """Expected slots of each sensor, between its first and last day, without a reading.

    The grid grows with sensors x days; it is made from (sensor, first, last)
    rows after the shuffle, so only those few columns move.
    """
    width = hours * 3600
    slot = F.timestamp_seconds(F.floor(F.unix_timestamp("timestamp") / width) * width)
    filled = readings.select("sensor_id", slot.alias("slot")).distinct()
    spans = filled.groupBy("sensor_id").agg(
        F.date_trunc("day", F.min("slot")).alias("first"), F.date_trunc("day", F.max("slot")).alias("last")
    )
    step = F.expr(f"INTERVAL {hours} HOURS")
    grid = spans.select(
        "sensor_id",
        F.explode(F.sequence("first", F.col("last") + F.expr(f"INTERVAL {24 - hours} HOURS"), step)).alias("slot"),
    )
    return grid.join(filled, ["sensor_id", "slot"], "left_anti")


def rain_spells(readings: DataFrame, rows_per_chunk: int = 1_000_000, time: str = "timestamp",
                tie: str = "event_id") -> DataFrame:
    """Runs of consecutive wet readings per sensor: start, end, length, total, peak.

    A run is named by the number of dry readings before it. A sensor with more
    than ``rows_per_chunk`` readings is counted in chunks of about that many rows
    in order of time, and the counts of earlier chunks are added; pieces of a run that
    crosses a chunk border share the name and meet in the last aggregation.
    """
    wet = F.coalesce(F.col("rainfall") > 0, F.lit(False))
    narrow = readings.select("sensor_id", time, tie, "rainfall")
    spans = hot_spans(readings, "sensor_id", time, rows_per_chunk)
    inside = Window.partitionBy("sensor_id", "_chunk").orderBy(time, tie).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    numbered = with_time_chunk(narrow, spans, "sensor_id", time).withColumn(
        "_dry", F.sum(F.when(wet, 0).otherwise(1)).over(inside))
    pieces = numbered.filter(wet).groupBy("sensor_id", "_chunk", "_dry").agg(
        F.min(time).alias("start"), F.max(time).alias("end"), F.count(F.lit(1)).alias("n"),
        F.sum(F.col("rainfall").cast(K.RAIN_SUM)).alias("total"), F.max("rainfall").alias("peak"),
    )
    dry_per_chunk = with_time_chunk(narrow, spans, "sensor_id", time, "inner").groupBy("sensor_id", "_chunk").agg(
        F.count_if(~wet).alias("_size"))
    offsets = with_chunk_offsets(dry_per_chunk, ["sensor_id"], "_chunk", "_size", "_offset").select(
        F.col("sensor_id").alias("_sensor"), F.col("_chunk").alias("_of"), "_offset")
    same = pieces["sensor_id"].eqNullSafe(offsets["_sensor"]) & (pieces["_chunk"] == offsets["_of"])
    return (
        pieces.join(offsets, same, "left")
        .groupBy("sensor_id", (F.coalesce("_offset", F.lit(0)) + F.col("_dry")).alias("dry_before"))
        .agg(
            F.min("start").alias("spell_start"), F.max("end").alias("spell_end"),
            F.sum("n").alias("n_readings"), F.sum("total").cast("double").alias("total_rainfall"),
            F.max("peak").alias("peak_rainfall"),
        )
    )
