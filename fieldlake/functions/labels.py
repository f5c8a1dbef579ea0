"""Class labels, file names and path parts of image data sets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fieldlake import constants as K


def label_parts(label: Column) -> Column:
    """Pieces of a label. Three underscores leave an empty piece, on purpose."""
    return F.split(F.replace(label, F.lit("__"), F.lit("_")), "_")


def plant_type(label: Column) -> Column:
    return F.element_at(label_parts(label), 1)


def is_healthy(label: Column) -> Column:
    return F.contains(F.lower(label), F.lit("healthy"))


def disease_name(label: Column) -> Column:
    parts = label_parts(label)
    return (
        F.when(is_healthy(label), "None")
        .when(F.size(parts) > 1, F.array_join(F.slice(parts, 2, F.size(parts) - 1), "_"))
        .otherwise("Unknown")
    )


def health_status(label: Column) -> Column:
    return F.when(is_healthy(label), "healthy").otherwise("diseased")


def path_part(path: Column, from_end: int) -> Column:
    """Path part counted from the end: 1 = file, 2 = its folder, ... (null if absent)."""
    parts = F.split(path, "/")
    return F.try_element_at(parts, F.lit(-from_end))


def plain_path(path: Column) -> Column:
    """Path without its scheme: sources spell local files file:/ or file:///."""
    return F.regexp_replace(path, "^[a-z0-9]+:/+", "/")


def suffix(name: Column) -> Column:
    """Text after the last dot, as written."""
    return F.regexp_extract(name, r"\.([^.]+)$", 1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]+$", "")


def is_raw_image(name: Column) -> Column:
    return F.lower(suffix(name)).isin(K.RAW_SUFFIXES)


def is_processed_image(name: Column) -> Column:
    """Case counts here, as it does for the file patterns of a processed tree."""
    return suffix(name).isin(K.PROCESSED_SUFFIXES)


def size_kb(size: Column) -> Column:
    return F.round(size / 1024, 2)


def image_format(name: Column) -> Column:
    kind = F.lower(suffix(name))
    return (
        F.when(kind == "png", "PNG").when(kind == "bmp", "BMP").when(kind == "tiff", "TIFF").otherwise("JPEG")
    )


def copy_suffix(copy: Column) -> Column:
    return F.when(copy == 0, "").otherwise(F.concat(F.lit("_aug_"), copy.cast("string")))


def hash_uniform(*parts: Column) -> Column:
    """A repeatable draw in [0, 1) from the md5 of the parts.

    A retried task draws the same number, which a seeded generator would not
    promise across partitions.
    """
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
