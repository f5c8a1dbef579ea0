"""File scans: cold JSON archives, metadata CSV, image files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldlake.functions.labels import plain_path
from fieldlake.schemas import IMAGE_METADATA, SENSOR_DATA
from fieldlake.sources.json_arrays import records


def readings_json(spark: SparkSession, path: str, suffix: str = "json") -> DataFrame:
    """Cold history: JSON array files in date folders, however large.

    The declared schema drops ``_id`` and reads rainfall as double. Date folders
    are not ``key=value``, so the ingest date comes from the file path.
    """
    rows = records(spark, path, suffix).select("path", F.from_json("text", SENSOR_DATA).alias("r"))
    day = F.regexp_extract("path", r"/(?:[a-z_]+=)?(\d{8})/", 1)
    return rows.select("r.*", F.to_date(F.when(day != "", day), "yyyyMMdd").alias("ingest_date"))


def metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(IMAGE_METADATA).option("header", True).csv(path)


def image_files(spark: SparkSession, path: str, contents: bool = False) -> DataFrame:
    """All files below a folder; bytes are read only when asked for (column pruning)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    columns = [plain_path(F.col("path")).alias("path"), F.col("length").alias("file_size_bytes"), F.col("modificationTime").alias("modified_at")]
    return files.select(*columns, *(["content"] if contents else []))


def decoded_images(spark: SparkSession, path: str) -> DataFrame:
    """Pixels in BGR order; files that do not decode are kept with height -1.

    The image source spells paths URL-encoded; they are decoded here, so that they
    equal those of ``image_files``.
    """
    images = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(path)
    origin = F.url_decode(F.replace(F.col("image.origin"), F.lit("+"), F.lit("%2B")))
    return images.withColumn("path", plain_path(origin))
