"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldlake.session import is_folder
from fieldlake.sources.domain import readings_from_events
from fieldlake.sources.tables import table


#: Files a batch takes at most, so that a backlog is worked off in bounded batches.
MAX_FILES = 1000


def table_stream(spark: SparkSession, folder: str, name: str, max_files: int = MAX_FILES) -> DataFrame:
    """A table of the data folder as a stream, whether it is one file or a folder of files."""
    folder = folder.rstrip("/")
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, folder, name).schema).option("maxFilesPerTrigger", max_files)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def readings_stream(spark: SparkSession, folder: str, max_files: int = MAX_FILES) -> DataFrame:
    return readings_from_events(table_stream(spark, folder, "events", max_files))


def kafka_readings(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Readings from a broker topic; needs the Kafka package on the class path."""
    from pyspark.sql import functions as F

    from fieldlake.schemas import SENSOR_DATA

    raw = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "earliest").load()
    )
    return raw.select(F.from_json(F.col("value").cast("string"), SENSOR_DATA).alias("r")).select("r.*")
