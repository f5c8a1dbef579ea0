"""Pixel functions over the small images made from embeddings."""

from pyspark.sql import functions as F

from fieldlake.operators import dataset as DS, images as IM
from fieldlake.plans.registry import query
from fieldlake.plans.views import _CHANNELS, _mean_sql, _std_sql, hex_sql, resized_sql, rotated_sql, uniform_sql, with_views
from fieldlake.sources import domain as V


STATS_SQL = f"""SELECT image_id, {_mean_sql()} AS pixel_mean, {_std_sql()} AS pixel_std,
    min(v) AS pixel_min, max(v) AS pixel_max FROM gray_pixels GROUP BY image_id"""


@query("pixel_stats", with_views("gray_pixels", STATS_SQL))
def pixel_stats(spark, sf):
    return IM.pixel_stats(V.pixel_images(spark, sf)).select(
        "image_id", "pixel_mean", "pixel_std", "pixel_min", "pixel_max")


@query("channel_stats", with_views("colour_pixels", f"""
    SELECT image_id, {_CHANNELS}
    FROM colour_pixels GROUP BY image_id"""))
def channel_stats(spark, sf):
    return IM.channel_stats(V.pixel_images(spark, sf, "colour")).select(
        "image_id", *[f"{c}_{m}" for c in IM.CHANNEL_NAMES for m in ("mean", "std")])


@query("normalise_pixels", with_views("gray_pixels", """
    SELECT image_id, CAST(i AS INTEGER) AS i, CAST(CAST(v AS FLOAT) / CAST(255 AS FLOAT) AS DOUBLE) AS value
    FROM gray_pixels"""))
def normalise_pixels(spark, sf):
    return IM.normalised(V.pixel_images(spark, sf)).select(
        "image_id", F.posexplode("tensor").alias("i", "value")).withColumn("value", F.col("value").cast("double"))


@query("denormalise_pixels", with_views("gray", f"SELECT image_id, {hex_sql('px')} AS pixels FROM gray"))
def denormalise_pixels(spark, sf):
    return IM.denormalised(IM.normalised(V.pixel_images(spark, sf))).select("image_id", F.hex("data").alias("pixels"))


@query("to_rgb", with_views("gray colour", f"""
    SELECT image_id, 'gray' AS kind, list_aggregate([printf('%02X%02X%02X', v, v, v) for v in px], 'string_agg', '')
    AS pixels FROM gray UNION ALL SELECT image_id, 'colour', list_aggregate([printf('%02X%02X%02X', px[3 * k + 3],
    px[3 * k + 2], px[3 * k + 1]) for k in range(24)], 'string_agg', '') FROM colour"""))
def to_rgb(spark, sf):
    both = V.pixel_images(spark, sf).withColumn("kind", F.lit("gray")).unionByName(
        V.pixel_images(spark, sf, "colour").withColumn("kind", F.lit("colour")))
    return IM.to_rgb(both).select("image_id", "kind", F.hex("rgb").alias("pixels"))


@query("resize_pixels", with_views("colour", f"""
    SELECT image_id, 16 AS height, 16 AS width, {hex_sql('px')} AS pixels FROM ({resized_sql("colour", 4, 6, 16, 16)})"""))
def resize_pixels(spark, sf):
    return IM.resize(V.pixel_images(spark, sf, "colour"), 16, 16).select(
        "image_id", "image.height", "image.width", F.hex("image.data").alias("pixels"))


@query("flip_horizontal", with_views("gray", f"""
    SELECT image_id, {hex_sql('[px[8 * (k // 8) + 8 - k % 8] for k in range(64)]')} AS pixels FROM gray"""))
def flip_horizontal(spark, sf):
    return IM.flip_horizontal(V.pixel_images(spark, sf)).select("image_id", F.hex("image.data").alias("pixels"))


@query("flip_vertical", with_views("colour", f"""
    SELECT image_id, {hex_sql('[px[18 * (3 - k // 18) + k % 18 + 1] for k in range(72)]')} AS pixels FROM colour"""))
def flip_vertical(spark, sf):
    return IM.flip_vertical(V.pixel_images(spark, sf, "colour")).select("image_id", F.hex("image.data").alias("pixels"))


@query("brightness", with_views("gray", f"""
    SELECT image_id, {hex_sql('''[CAST(floor(least(255, CAST(p AS FLOAT)
      * CAST(CAST(0.8 AS DOUBLE) + image_id % 5 / CAST(10 AS DOUBLE) AS FLOAT))) AS INTEGER) for p in px]''')} AS pixels
    FROM gray"""))
def brightness(spark, sf):
    factor = F.lit(0.8) + F.col("image_id") % 5 / F.lit(10.0)
    return IM.brightness(V.pixel_images(spark, sf), factor).select("image_id", F.hex("image.data").alias("pixels"))


@query("rotate", with_views("colour", f"""
    SELECT image_id, {hex_sql('px')} AS pixels
    FROM ({rotated_sql("(SELECT *, CAST(image_id % 31 - 15 AS DOUBLE) AS angle FROM colour)", 4, 6)})"""))
def rotate(spark, sf):
    angle = (F.col("image_id") % 31 - 15).cast("double")
    return IM.rotate(V.pixel_images(spark, sf, "colour"), angle).select(
        "image_id", F.hex("image.data").alias("pixels"))


@query("augment_fanout", with_views("fanned", f"""
    SELECT image_id, copy, suffix, CASE WHEN copy > 0 THEN round(({uniform_sql("image_id", "copy", "42", "'angle'")} * 2 - 1) * 15, 9) END AS angle,
    copy > 0 AND {uniform_sql("image_id", "copy", "42", "'mirror'")} > 0.5 AS mirror,
    CASE WHEN copy > 0 THEN round(CAST(0.8 AS DOUBLE) + {uniform_sql("image_id", "copy", "42", "'factor'")}
      * CAST(0.4 AS DOUBLE), 9) ELSE 1 END AS factor FROM fanned"""))
def augment_fanout(spark, sf):
    split = DS.stratified_split(V.images(spark, sf).select("image_id", "class_label"))
    return DS.augmentation_draws(DS.with_copies(split), "image_id").select(
        "image_id", "copy", "suffix", F.round("angle", 9).alias("angle"), "mirror", F.round("factor", 9).alias("factor"))


@query("colour_histogram", with_views("colour_pixels", """
    SELECT class_label, channel, bin, count(*) FILTER (WHERE v // 32 = bin) AS n_pixels
    FROM (SELECT class_label, CAST(i % 3 AS INTEGER) AS channel, v FROM colour_pixels),
    (SELECT CAST(unnest(range(8)) AS INTEGER) AS bin) GROUP BY 1, 2, 3"""))
def colour_histogram(spark, sf):
    return IM.colour_histogram(V.pixel_images(spark, sf, "colour"))
