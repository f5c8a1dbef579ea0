"""Data-quality checks: each returns the violating rows or counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldlake import constants as K
from fieldlake.functions import labels as LB


def out_of_range(rows: DataFrame, ranges, key: str) -> DataFrame:
    """One row per (row, column outside its range), in a single pass over the table.

    A rule for a column that the table does not have is an error: it would pass unseen.
    """
    missing = [column for column, _, _ in ranges if column not in rows.columns]
    if missing:
        raise ValueError(f"no column for the range rules of {', '.join(missing)}")
    checks = []
    for column, low, high in ranges:
        value = F.col(column).cast("double")
        bad = F.lit(False)
        if low is not None:
            bad = bad | (value < low)
        if high is not None:
            bad = bad | (value > high)
        checks.append(F.when(bad, F.struct(F.lit(column).alias("column_name"), value.alias("bad_value"))))
    return rows.select(key, F.explode(F.array_compact(F.array(*checks))).alias("v")).select(
        key, "v.column_name", "v.bad_value"
    )


def key_violations(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that are repeated or hold a null."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter((F.col("n_rows") > 1) | has_null)


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key is set but has no parent."""
    return children.filter(F.col(key).isNotNull()).join(parents.select(key), key, "left_anti")


def null_counts(rows: DataFrame, required: list[str]) -> DataFrame:
    """Nulls per required column, all columns in one pass."""
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in required])
    return counted.select(F.inline(pairs))


def too_long(rows: DataFrame, limits: dict[str, int], key: str) -> DataFrame:
    """Text values longer than their column allows."""
    checks = [
        F.when(F.length(c) > n, F.struct(F.lit(c).alias("column_name"), F.length(c).alias("n_chars")))
        for c, n in limits.items()
    ]
    return rows.select(key, F.explode(F.array_compact(F.array(*checks))).alias("v")).select(
        key, "v.column_name", "v.n_chars"
    )


def class_mismatches(images: DataFrame, expected=K.EXPECTED_CLASSES) -> DataFrame:
    """Classes seen but not expected, or expected but not seen."""
    wanted = images.sparkSession.createDataFrame([(c,) for c in expected], "class_label string")
    seen = images.select("class_label").distinct().withColumn("seen", F.lit(True))
    both = seen.join(wanted.withColumn("wanted", F.lit(True)), "class_label", "full")
    problem = F.when(F.col("wanted").isNull(), "unexpected").when(F.col("seen").isNull(), "missing")
    return both.select("class_label", problem.alias("problem")).filter(F.col("problem").isNotNull())


def name_clashes(images: DataFrame) -> DataFrame:
    """Output names that two or more inputs would share: same class, same stem."""
    return (
        images.groupBy("class_label", LB.stem(LB.path_part(F.col("path"), 1)).alias("stem"))
        .agg(F.count(F.lit(1)).alias("n_inputs"))
        .filter(F.col("n_inputs") > 1)
    )


def split_classes(images: DataFrame) -> DataFrame:
    """Class names met in more than one folder."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    folders = images.select("class_label", folder.alias("folder")).distinct()
    return folders.groupBy("class_label").agg(F.count(F.lit(1)).alias("n_folders")).filter(F.col("n_folders") > 1)


def input_present(paths: DataFrame) -> DataFrame:
    """Number of images and whether there are any; the job should stop if not."""
    good = LB.is_processed_image(LB.path_part(F.col("path"), 1))
    return paths.agg(F.count_if(good).alias("n_images")).withColumn("present", F.col("n_images") > 0)
