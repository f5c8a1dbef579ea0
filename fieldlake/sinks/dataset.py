"""Files of an image data set: metadata, summaries, manifest, pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from fieldlake import constants as K
from fieldlake.operators import dataset as DS
from fieldlake.schemas import IMAGE_METADATA


def metadata_rows(images: DataFrame) -> DataFrame:
    return images.select(*[F.col(f.name).cast(f.dataType) for f in IMAGE_METADATA.fields])


def write_metadata_csv(images: DataFrame, path: str, order=("split", "class_label", "filename")) -> None:
    """CSV in the order split, class, file: range partitions keep the global order
    without putting the table through one task."""
    metadata_rows(images).repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option(
        "header", True).csv(path)


def write_metadata_json(images: DataFrame, path: str, name: str, task: str) -> None:
    """One JSON line per image under images/, one row of totals under dataset_info/."""
    metadata_rows(images).write.mode("overwrite").json(f"{path}/images")
    images.agg(
        F.lit(name).alias("name"), F.lit(task).alias("task"), F.countDistinct("class_label").alias("num_classes"),
        F.count(F.lit(1)).alias("total_images"), F.current_timestamp().alias("extraction_timestamp"),
    ).write.mode("overwrite").json(f"{path}/dataset_info")


def write_class_distribution(images: DataFrame, path: str, name: str) -> None:
    """Distribution rows, and one row of totals made from the rows just written."""
    spark = images.sparkSession
    DS.class_distribution(images).write.mode("overwrite").parquet(f"{path}/distribution")
    spark.read.parquet(f"{path}/distribution").agg(
        F.lit(name).alias("dataset_name"), F.count(F.lit(1)).alias("total_classes"),
        F.sum("total").alias("total_images"), F.current_timestamp().alias("generated_at"),
    ).write.mode("overwrite").json(f"{path}/totals")


def write_dataset_summary(images: DataFrame, path: str, name: str) -> None:
    """One document with all figures, class names and plant counts; the plants also as rows."""
    lists = DS.class_lists(images)
    DS.dataset_summary(images, name).withColumns({c: lists.select(c).scalar() for c in lists.columns}).withColumn(
        "generated_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    DS.plant_counts(images).write.mode("overwrite").json(f"{path}/plant_types")


def write_manifest(images: DataFrame, path: str) -> None:
    """One row per image: split, class, source path, in order inside each file.

    A list per (split, class) would be one unbounded value; rows are not.
    """
    images.select("split", "class_label", "path").hint("rebalance", "split", "class_label").sortWithinPartitions(
        "split", "class_label", "path").write.mode("overwrite").partitionBy("split", "class_label").parquet(path)


def write_manifest_info(manifest: DataFrame, attempts: DataFrame, path: str, name: str) -> None:
    """One document beside the manifest: what the data set holds, and how its making went."""
    counts = manifest.agg(
        F.lit(name).alias("name"), F.count_distinct("class_label").alias("num_classes"), F.count(F.lit(1)).alias("total_images"),
        F.struct(*[F.count_if(F.col("split") == s).alias(s) for s in K.SPLITS]).alias("splits"))
    figures = DS.processing_stats(attempts)
    counts.withColumn("statistics", figures.select(F.struct("*")).scalar()).withColumn("generated_at", F.current_timestamp()).coalesce(1).write.mode(
        "overwrite").json(path)


def write_processed_images(images: DataFrame, path: str) -> None:
    """Pixels under split=/class_label=, named by stem, copy suffix and .jpg.

    The rebalance hint splits a class with most of the images over many files.
    """
    images.select("split", "class_label", "image_id", "copy", "name", "image").hint(
        "rebalance", "split", "class_label").write.mode("overwrite").partitionBy("split", "class_label").parquet(path)


def ingest_files(files: DataFrame, path: str) -> tuple[int, int]:
    """Copy scanned files into the lake; returns (rows read, rows stored) for the check.

    The read count is observed during the write; the stored count comes from
    the Parquet footers.
    """
    seen = Observation()
    files.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get["n"], files.sparkSession.read.parquet(path).count()
