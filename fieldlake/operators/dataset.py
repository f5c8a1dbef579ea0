"""Image data sets: scans by path, class labels, splits, copies, counts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake import constants as K
from fieldlake.functions import labels as LB
from fieldlake.operators.ordered import cut_points
from fieldlake.session import stored


def raw_images(files: DataFrame, root: str | None = None) -> DataFrame:
    """Files of a raw tree that are images; the class is the containing folder.

    Folders of the same name in different places form one class. With ``root``, files
    that lie in the root itself have no class and are left out. Spark's file scans
    do not list folders that start with ``_`` or a dot.
    """
    name, folder = LB.path_part(F.col("path"), 1), LB.path_part(F.col("path"), 2)
    if root is not None:
        plain = re.sub("^[a-z0-9]+:/+", "/", root).rstrip("/")
        files = files.filter(F.regexp_replace("path", "/[^/]*$", "") != plain)
    return files.filter(LB.is_raw_image(name) & ~F.startswith(folder, F.lit("."))).withColumns(
        {"filename": name, "class_label": folder}
    )


def processed_images(files: DataFrame) -> DataFrame:
    """Files of a ``split/class/file`` tree: known splits, exact-case suffixes."""
    name = LB.path_part(F.col("path"), 1)
    split = LB.path_part(F.col("path"), 3)
    return files.filter(split.isin(K.SPLITS) & LB.is_processed_image(name)).withColumns(
        {"filename": name, "class_label": LB.path_part(F.col("path"), 2), "split": split}
    )


def union_by_suffix(files: DataFrame) -> DataFrame:
    """The .jpg files, then the .png files: one scan, since a file has one suffix."""
    return files.filter(LB.is_processed_image(LB.path_part(F.col("path"), 1)))


def label_columns(images: DataFrame) -> DataFrame:
    label = F.col("class_label")
    return images.withColumns({
        "plant_type": LB.plant_type(label),
        "disease_name": LB.disease_name(label),
        "health_status": LB.health_status(label),
    })


def file_columns(files: DataFrame, root: str = "") -> DataFrame:
    """Name, path below the root and size. Spark has no creation time; the
    modification time is passed on where the scan provides it."""
    return files.withColumns({
        "filename": LB.path_part(F.col("path"), 1),
        "filepath": F.when(F.startswith("path", F.lit(root)), F.substr("path", F.lit(len(root) + 1))).otherwise(
            F.col("path")),
        "absolute_path": F.col("path"),
        "file_size_kb": LB.size_kb(F.col("file_size_bytes")),
        "format": LB.image_format(LB.path_part(F.col("path"), 1)),
    })


def held_out(n: Column) -> Column:
    """Images of a class of n that are not for training: ceil(0.30 n); none of a single one."""
    return F.when(n == 1, 0).otherwise(F.ceil(F.lit(K.VAL_SHARE + K.TEST_SHARE) * n))


def test_size(n: Column) -> Column:
    """The test part of the held-out images: half of them, rounded up."""
    return F.ceil(held_out(n) * F.lit(K.TEST_SHARE / (K.VAL_SHARE + K.TEST_SHARE)))


def _split_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))


def split_cuts(images: DataFrame, key: str = "image_id", seed: int = K.SPLIT_SEED, chunk_digits: int = 3) -> DataFrame:
    """The hash at the two cut ranks of each class: one row per class, stored.

    Reads keys and labels only. ``chunk_digits`` hex digits cut a class into
    16**digits even pieces, whatever its share of the table.
    """
    digest, n = _split_hash(key, seed), F.col("total")
    cuts = cut_points(images, "class_label", digest, key,
                      {"_train": n - held_out(n), "_val": n - test_size(n)},
                      chunk=F.substring(digest, 1, chunk_digits))
    return stored(cuts, "split-cuts")


def with_split(images: DataFrame, cuts: DataFrame, key: str = "image_id", seed: int = K.SPLIT_SEED) -> DataFrame:
    """Rows labelled by comparing their hash with the cuts of their class, where
    they are: nothing is shuffled unless the table of classes is too large to
    broadcast. Images without a class form one class of their own."""
    place = F.struct(_split_hash(key, seed), F.col(key))
    split = F.when(place <= F.col("_train"), "train").when(place <= F.col("_val"), "val").otherwise("test")
    own = cuts.withColumnRenamed("class_label", "_class")
    return images.join(own, F.col("class_label").eqNullSafe(F.col("_class"))).withColumn("split", split).drop("_class", "_train", "_val")


def stratified_split(images: DataFrame, key: str = "image_id", seed: int = K.SPLIT_SEED,
                     chunk_digits: int = 3) -> DataFrame:
    """Train, val and test per class, by rank of a seeded hash, with exact sizes."""
    return with_split(images, split_cuts(images, key, seed, chunk_digits), key, seed)


def with_copies(images: DataFrame, copies: int = K.AUGMENTED_COPIES) -> DataFrame:
    """Originals, plus numbered copies of training images; row-local."""
    numbers = F.when(F.col("split") == "train", F.sequence(F.lit(0), F.lit(copies))).otherwise(F.array(F.lit(0)))
    return images.withColumn("copy", F.explode(numbers)).withColumn("suffix", LB.copy_suffix(F.col("copy")))


def augmentation_draws(fanned: DataFrame, key: str, seed: int = K.SPLIT_SEED, vertical: bool = False) -> DataFrame:
    """Angle, flips and brightness per copy from a hash of (id, copy, seed).

    A retried or re-planned task gets equal draws. Originals have null draws.
    """
    low, high = K.BRIGHTNESS_RANGE

    def draw(name: str) -> Column:
        return LB.hash_uniform(F.col(key), F.col("copy"), F.lit(seed), F.lit(name))

    is_copy = F.col("copy") > 0
    return fanned.withColumns({
        "angle": F.when(is_copy, (draw("angle") * 2 - 1) * K.ROTATION_RANGE),
        "mirror": F.when(is_copy, draw("mirror") > 0.5).otherwise(False),
        "upend": F.when(is_copy & F.lit(vertical), draw("upend") > 0.5).otherwise(False),
        "factor": F.when(is_copy, F.lit(low) + draw("factor") * F.lit(high - low)).otherwise(1.0),
    })


def output_name(path: Column, suffix: Column) -> Column:
    """File name of a processed image: always .jpg, whatever the input was."""
    return F.concat(LB.stem(LB.path_part(path, 1)), suffix, F.lit(".jpg"))


def class_distribution(images: DataFrame) -> DataFrame:
    """Images per class and split, zero-filled, with the class total."""
    counted = images.groupBy("class_label").agg(
        *[F.count_if(F.col("split") == s).alias(s) for s in K.SPLITS]
    )
    return counted.withColumn("total", sum((F.col(s) for s in K.SPLITS), F.lit(0)))


def class_counts(images: DataFrame) -> DataFrame:
    return images.groupBy("class_label").agg(F.count(F.lit(1)).alias("n_images"))


def split_counts(images: DataFrame) -> DataFrame:
    return images.agg(*[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in K.SPLITS])


def size_aggregates() -> list[Column]:
    """Mean size and total volume. Sizes are summed as decimals, so the result
    does not depend on the order in which tasks finish."""
    kb = F.sum(F.col("file_size_kb").cast("decimal(20,2)")).cast("double")
    return [
        F.avg("width").cast("int").alias("avg_width"),
        F.avg("height").cast("int").alias("avg_height"),
        (kb / F.count("file_size_kb")).alias("avg_file_size_kb"),
        (kb / 1024).alias("total_size_mb"),
    ]


def image_size_stats(images: DataFrame) -> DataFrame:
    return images.agg(*size_aggregates())


def health_counts(images: DataFrame) -> DataFrame:
    return images.agg(
        F.count_if(F.col("health_status") == "healthy").alias("n_healthy"),
        F.count_if(F.col("health_status") == "diseased").alias("n_diseased"),
    )


def counts_by_plant_health(images: DataFrame) -> DataFrame:
    return images.groupBy("plant_type", "health_status").agg(F.count(F.lit(1)).alias("n_images"))


def plant_counts(images: DataFrame) -> DataFrame:
    return images.groupBy("plant_type").agg(F.count(F.lit(1)).alias("n_images")).orderBy(
        F.col("n_images").desc(), "plant_type"
    )


def distinct_classes(images: DataFrame) -> DataFrame:
    """The classes as rows, each with the number of classes (exact).

    Rows instead of one list: the number of classes is not bounded.
    """
    classes = images.select("class_label").distinct()
    number = classes.agg(F.count(F.lit(1))).scalar()
    return classes.withColumn("num_classes", number)


def dataset_summary(images: DataFrame, name: str) -> DataFrame:
    """One nested row: overview, image sizes, health, and pixel statistics where the
    images have them. One pass, map-side combined."""
    sizes = size_aggregates()
    pixels = ["pixel_mean", "pixel_std"] if "pixel_mean" in images.columns else []
    # plain means of the images' values, summed as decimals
    sizes += [(F.sum(F.col(c).cast("decimal(20,8)")).cast("double") / F.count(c)).alias(c.replace("pixel", "overall")) for c in pixels]
    flat = images.agg(
        F.count(F.lit(1)).alias("total_images"),
        F.countDistinct("class_label").alias("num_classes"),
        *[F.count_if(F.col("split") == s).alias(s) for s in K.SPLITS],
        *sizes,
        F.count_if(F.col("health_status") == "healthy").alias("healthy"),
        F.count_if(F.col("health_status") == "diseased").alias("diseased"),
    )
    return flat.select(
        F.lit(name).alias("dataset_name"),
        F.struct("total_images", "num_classes", F.struct(*K.SPLITS).alias("splits")).alias("overview"),
        F.struct("avg_width", "avg_height", "avg_file_size_kb", "total_size_mb").alias("image_properties"),
        F.struct("healthy", "diseased").alias("health_status_distribution"),
        *([F.struct("overall_mean", "overall_std").alias("pixel_statistics")] if pixels else []),
    )


def class_lists(images: DataFrame) -> DataFrame:
    """One row: the class names in order, and the images per plant. Classes are folders of
    the tree; they are counted before they are listed."""
    counted = stored(images.groupBy("class_label", "plant_type").agg(F.count(F.lit(1)).alias("n")), "class-sizes")
    plants = counted.groupBy("plant_type").agg(F.sum("n").alias("n")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("plant_type", F.lit("")).alias("k"), "n")))).alias("plant_types"))
    return counted.agg(F.array_sort(F.collect_set("class_label")).alias("classes")).withColumn("plant_types", plants.scalar())


def attempt_log(planned: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """One row per image and copy that was to be made (``planned``: key, copy): ``processed`` if
    ``done`` (key, copy) has it, ``skipped`` if only its original is there, ``corrupted``,
    once per image, if nothing is.

    Both are lists of names: no pixels are read or decoded again.
    """
    made = done.select(F.col(key).alias("_key"), F.col("copy").alias("_copy")).distinct().withColumn("_made", F.lit(True))
    seen = planned.join(made, (F.col(key) == F.col("_key")) & (F.col("copy") == F.col("_copy")), "left").drop("_key", "_copy")
    originals = made.filter("_copy = 0").select("_key", F.lit(True).alias("_decoded"))
    outcome = F.when(F.col("_made"), "processed").when(F.col("_decoded"), "skipped").when(F.col("copy") == 0, "corrupted")
    return seen.join(originals, F.col(key) == F.col("_key"), "left").withColumn("outcome", outcome).drop(
        "_key", "_made", "_decoded").filter(F.col("outcome").isNotNull())


def processing_stats(attempts: DataFrame) -> DataFrame:
    """Counts over the attempt log (one row per image and copy, with an outcome).

    Copies count as processed, so the rate may pass 100; originals and copies
    are given apart as well.
    """
    processed = F.col("outcome") == "processed"
    return attempts.agg(
        F.count_if(F.col("copy") == 0).alias("n_scanned"),
        F.count_if(processed).alias("n_processed"),
        F.count_if(processed & (F.col("copy") == 0)).alias("n_originals"),
        F.count_if(processed & (F.col("copy") > 0)).alias("n_copies"),
        F.count_if(F.col("outcome") == "skipped").alias("n_skipped"),
        F.count_if(F.col("outcome") == "corrupted").alias("n_corrupted"),
    ).withColumn("success_rate", F.col("n_processed") / F.col("n_scanned") * 100)


def sorted_metadata(images: DataFrame) -> DataFrame:
    return images.orderBy("split", "class_label", "filename")
