"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def relational(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A relational table kept as Parquet, in its declared schema."""
    from fieldlake.schemas import RELATIONAL

    return spark.read.schema(RELATIONAL[name]).parquet(f"{folder.rstrip('/')}/{name}")


def relational_jdbc(spark: SparkSession, url: str, name: str, partition_column: str, low, high,
                    partitions: int, **options: str) -> DataFrame:
    """The same table over JDBC, read in parallel ranges of one indexed column."""
    return (
        spark.read.format("jdbc").option("url", url).option("dbtable", name)
        .option("partitionColumn", partition_column).option("lowerBound", low).option("upperBound", high)
        .option("numPartitions", partitions).option("fetchsize", "10000").options(**options).load()
    )
