"""Counts and summaries over readings and disease records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def counts_by_field(readings: DataFrame, records: DataFrame) -> DataFrame:
    """Readings and disease events per field; both sides are reduced before the join."""
    n_readings = readings.groupBy("field_id").agg(F.count(F.lit(1)).alias("n_readings"))
    n_diseases = records.groupBy("field_id").agg(F.count(F.lit(1)).alias("n_diseases"))
    return n_readings.join(n_diseases, "field_id", "left").na.fill(0, ["n_diseases"])


def counts_of(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("entity"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def average_moisture(readings: DataFrame) -> DataFrame:
    return readings.groupBy("field_id").agg(F.avg("moisture").alias("avg_moisture"))


def daily_field_summary(readings: DataFrame, records: DataFrame) -> DataFrame:
    """One row per (date, field); records are counted before the join."""
    daily = readings.groupBy(F.to_date("timestamp").alias("analysis_date"), "field_id").agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.avg("temperature").cast("decimal(5,2)").alias("avg_temperature"),
        F.avg("moisture").cast("decimal(5,2)").alias("avg_moisture"),
    )
    sick = records.groupBy(F.to_date("detection_date").alias("analysis_date"), "field_id").agg(
        F.count(F.lit(1)).alias("disease_count")
    )
    return daily.join(sick, ["analysis_date", "field_id"], "left").na.fill(0, ["disease_count"])
