"""Pixel operators over the column ``image`` (the struct of Spark's image source)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake import constants as K
from fieldlake.functions import pixels as P

CHANNEL_NAMES = ["blue", "green", "red"]  # stored order of the image source


def valid_images(images: DataFrame, skip_corrupted: bool = True) -> DataFrame:
    """Decoded images. Undecodable ones (height -1) are dropped, or fail the job."""
    decoded = F.col("image.height") > 0
    if skip_corrupted:
        return images.filter(decoded)
    return images.filter(F.when(decoded, True).otherwise(
        F.raise_error(F.concat(F.lit("cannot decode "), F.coalesce("image.origin", F.lit("?"))))))


def corrupt_count(images: DataFrame) -> DataFrame:
    return images.agg(
        F.count(F.lit(1)).alias("n_images"), F.count_if(F.col("image.height") <= 0).alias("n_corrupted")
    )


def image_properties(images: DataFrame) -> DataFrame:
    names = {1: "L", 3: "RGB", 4: "RGBA"}
    channels = F.col("image.nChannels")
    mode = F.when(channels == 1, names[1]).when(channels == 3, names[3]).when(channels == 4, names[4])
    return images.withColumns({
        "width": F.col("image.width"), "height": F.col("image.height"), "channels": channels, "mode": mode,
    })


def _mean(m: Column) -> Column:
    return m["total"] / m["n"]


def _std(m: Column) -> Column:
    """Population deviation from exact integer sums."""
    return F.sqrt(F.greatest(F.lit(0.0), m["squares"] / m["n"] - _mean(m) * _mean(m)))


def pixel_stats(images: DataFrame, digits: int = 4) -> DataFrame:
    """Mean, population deviation, least and greatest pixel value per image. No shuffle."""
    return images.withColumn("_m", P.moments("image.data")).withColumns({
        "pixel_mean": F.round(_mean(F.col("_m")), digits),
        "pixel_std": F.round(_std(F.col("_m")), digits),
        "pixel_min": F.col("_m.low"),
        "pixel_max": F.col("_m.high"),
    }).drop("_m")


def channel_stats(images: DataFrame, digits: int = 4, names=CHANNEL_NAMES) -> DataFrame:
    """Mean and deviation per colour, of three-channel images only. No shuffle.

    ``names`` gives the stored channel order.
    """
    return channel_columns(images.filter(F.col("image.nChannels") == 3), digits, names)


def channel_columns(images: DataFrame, digits: int = 4, names=CHANNEL_NAMES) -> DataFrame:
    """The same for all images; null where there are not three channels."""
    found = images.withColumn("_c", P.channel_moments("image.data", "image.nChannels"))
    columns = {}
    for position, name in enumerate(names):
        moments = F.when(F.col("image.nChannels") == 3, F.get("_c", F.lit(position)))
        columns[f"{name}_mean"] = F.round(_mean(moments), digits)
        columns[f"{name}_std"] = F.round(_std(moments), digits)
    return found.withColumns(columns).drop("_c")


def metadata(files: DataFrame, names=CHANNEL_NAMES) -> DataFrame:
    """Every metadata column that pixels give: shape, values, colours."""
    return channel_columns(pixel_stats(image_properties(files)), names=names)


def pixel_summary(stats: DataFrame) -> DataFrame:
    """Plain mean of the images' means and of their deviations (not pooled).

    Summed as decimals, so the order of tasks does not matter.
    """
    def mean(c: str) -> Column:
        return F.sum(F.col(c).cast("decimal(20,8)")).cast("double") / F.count(c)

    return stats.agg(mean("pixel_mean").alias("overall_mean"), mean("pixel_std").alias("overall_std"))


def normalised(images: DataFrame) -> DataFrame:
    return images.withColumn("tensor", P.normalised("image.data"))


def denormalised(images: DataFrame) -> DataFrame:
    return images.withColumn("data", P.denormalised("tensor"))


def to_rgb(images: DataFrame) -> DataFrame:
    """Three channels in R, G, B order, in the column ``rgb``."""
    return images.withColumn("rgb", P.rgb("image.data", "image.nChannels"))


def as_rgb(images: DataFrame) -> DataFrame:
    """The image struct itself with three channels in R, G, B order."""
    rgb = P.rgb("image.data", "image.nChannels")
    image = F.col("image").withField("data", rgb).withField("nChannels", F.lit(3))
    return images.withColumn("image", image)


def _replace(images: DataFrame, data: Column, height=None, width=None) -> DataFrame:
    image = F.col("image").withField("data", data)
    if height is not None:
        image = image.withField("height", F.lit(height)).withField("width", F.lit(width))
    return images.withColumn("image", image)


_SHAPE = ("image.data", "image.height", "image.width", "image.nChannels")


def flip_horizontal(images: DataFrame) -> DataFrame:
    return _replace(images, P.flipped(*_SHAPE, F.lit(True), F.lit(False)))


def flip_vertical(images: DataFrame) -> DataFrame:
    return _replace(images, P.flipped(*_SHAPE, F.lit(False), F.lit(True)))


def brightness(images: DataFrame, factor: Column) -> DataFrame:
    return _replace(images, P.brightened("image.data", factor))


def rotate(images: DataFrame, angle: Column) -> DataFrame:
    return _replace(images, P.rotated(*_SHAPE, angle))


def resize(images: DataFrame, height: int = K.TARGET_SIZE[0], width: int = K.TARGET_SIZE[1]) -> DataFrame:
    return _replace(images, P.lanczos_resizer(height, width)(*_SHAPE), height, width)


def apply_augmentation(drawn: DataFrame) -> DataFrame:
    """All drawn changes of each copy in one Python crossing."""
    return _replace(drawn, P.augmented(*_SHAPE, "angle", "mirror", "upend", "factor"))


def colour_histogram(images: DataFrame, bins: int = 8) -> DataFrame:
    """Pixels per class, channel and value band.

    Each image is reduced to its channels x bins counts inside the task; only
    these counts are exploded and summed, never the pixels.
    """
    counts = P.histogrammer(bins)("image.data", "image.nChannels")
    return (
        images.select("class_label", F.posexplode(counts).alias("slot", "n"))
        .groupBy("class_label", F.floor(F.col("slot") / bins).cast("int").alias("channel"),
                 (F.col("slot") % bins).alias("bin"))
        .agg(F.sum("n").alias("n_pixels"))
    )
