"""Scans and sources."""

from pyspark.sql import functions as F

from fieldlake.functions import weather as W
from fieldlake.operators import dataset as DS, fields as FL, images as IM, timeline as TL
from fieldlake.plans.registry import query
from fieldlake.plans.views import ZONE, season_sql, with_views
from fieldlake.schemas import WEATHER_PAYLOAD
from fieldlake.session import work_path
from fieldlake.sinks import dataset as SD, stores as ST
from fieldlake.sources import domain as V, files as FS, streams as SR, tables as TB
from fieldlake.streaming import jobs as J


@query("scan_active_fields", with_views("fields", "SELECT * FROM fields WHERE active"))
def scan_active_fields(spark, sf):
    return FL.active_fields(V.fields(spark, sf))


@query("scan_field_sensors", with_views("sensors", "SELECT * FROM sensors WHERE status = 'active'"))
def scan_field_sensors(spark, sf):
    return FL.active_sensors(V.sensors(spark, sf))


@query("scan_user", with_views("users", "SELECT * FROM users WHERE user_id = 7"))
def scan_user(spark, sf):
    return FL.user_by_id(V.users(spark, sf), 7)


@query("scan_readings_json", with_views("readings", """
    SELECT CAST(sensor_id AS VARCHAR) AS sensor_id, CAST(field_id AS VARCHAR) AS field_id, sensor_type, "timestamp",
    CASE WHEN sensor_type = 'soil' THEN moisture END AS moisture, temperature,
    CASE WHEN sensor_type = 'atmospheric' THEN rainfall END AS rainfall, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS ingest_date FROM readings"""))
def scan_readings_json(spark, sf):
    path = work_path(spark, "json-archive")
    ST.write_json_archive(ST.nested_readings(V.readings(spark, sf)), path)
    return FS.readings_json(spark, path, suffix="txt").select(
        "sensor_id", "field_id", "sensor_type", "timestamp", "readings.moisture", "readings.temperature",
        "readings.rainfall", F.col("ingest_date").cast("string"),
    )


METADATA = "SELECT * FROM metadata"


def image_metadata(spark, sf):
    """Metadata of pixel images in a split/class/file tree, from their names and pixels."""
    files = DS.processed_images(V.processed_pixels(spark, sf))
    return DS.label_columns(DS.file_columns(IM.metadata(files)))


def processed_metadata(spark, sf):
    files = DS.processed_images(V.processed_files(spark, sf))
    return DS.label_columns(DS.file_columns(files))


@query("scan_metadata_csv", with_views("metadata", METADATA))
def scan_metadata_csv(spark, sf):
    path = work_path(spark, "metadata-csv")
    SD.write_metadata_csv(image_metadata(spark, sf), path)
    return FS.metadata_csv(spark, path)


@query("scan_raw_images", with_views("images", """
    SELECT image_id, path, filename, class_label, file_size_bytes FROM images
    WHERE lower(regexp_extract(filename, '\\.([^.]+)$', 1)) IN ('jpg', 'jpeg', 'png', 'bmp', 'tiff')"""))
def scan_raw_images(spark, sf):
    files = V.images(spark, sf).select("image_id", "path", "file_size_bytes")
    return DS.raw_images(files).select("image_id", "path", "filename", "class_label", "file_size_bytes")


@query("scan_processed_images", with_views("processed", """
    SELECT image_id, split || '/' || class_label || '/' || filename AS path, filename, class_label, split
    FROM processed"""))
def scan_processed_images(spark, sf):
    return DS.processed_images(V.processed_files(spark, sf)).select(
        "image_id", "path", "filename", "class_label", "split"
    )


@query("scan_image_pixels", with_views("gray", """
    SELECT image_id, 8 AS height, 8 AS width, 1 AS n_channels,
    list_aggregate([printf('%02X', v) for v in px], 'string_agg', '') AS pixels FROM gray WHERE image_id % 13 <> 0"""))
def scan_image_pixels(spark, sf):
    return IM.valid_images(V.pixel_images(spark, sf, "mixed")).select(
        "image_id", "image.height", "image.width", F.col("image.nChannels").alias("n_channels"),
        F.hex("image.data").alias("pixels"),
    )


@query("scan_corrupt_images", with_views("gray", """
    SELECT count(*) AS n_images, count(*) FILTER (WHERE image_id % 13 = 0) AS n_corrupted FROM gray"""))
def scan_corrupt_images(spark, sf):
    return IM.corrupt_count(V.pixel_images(spark, sf, "mixed"))


RELATIONAL = ("fields", "sensors", "batch_jobs", "analytics_summary")


@query("scan_relational", with_views("r_fields r_sensors r_batch_jobs r_analytics_summary", " UNION ALL BY NAME ".join(
    f"SELECT '{t}' AS table_name, * FROM r_{t}" for t in RELATIONAL)))
def scan_relational(spark, sf):
    base, out = work_path(spark, "relational"), None
    for name, rows in V.relational_tables(spark, sf).items():
        rows.write.parquet(f"{base}/{name}")
        one = TB.relational(spark, base, name).withColumn("table_name", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


@query("weather_payload_normalise", with_views("readings fields", f"""
    SELECT r.event_id, r.temperature, r.humidity, CAST(1000 + event_id % 30 AS DOUBLE) AS pressure,
    CAST(event_id % 12 AS DOUBLE) AS wind_speed,
    CAST(CASE WHEN event_id % 5 <> 0 THEN event_id % 360 ELSE 0 END AS INTEGER) AS wind_direction,
    CASE WHEN event_id % 3 <> 1 THEN r.rainfall ELSE 0 END AS rainfall, r.clouds, {ZONE} AS climate_zone,
    CASE WHEN event_id % 3 <> 1 THEN r.rainfall ELSE 0 END > 0 AS is_raining,
    {season_sql('dayofyear("timestamp")')} AS season, 'openweathermap' AS source
    FROM readings r JOIN fields f ON f.field_id = r.field_id"""))
def weather_payload_normalise(spark, sf):
    rows = V.weather_payloads(spark, sf).join(V.fields(spark, sf).select("field_id", "lat"), "field_id")
    return W.normalised_payloads(rows, "payload", WEATHER_PAYLOAD).select("event_id", *W.payload_columns(F.col("p"), F.col("lat"), F.dayofyear("timestamp")))


@query("stream_source_readings", with_views("readings", "SELECT * FROM readings"))
def stream_source_readings(spark, sf):
    return J.drain_to_table(SR.readings_stream(spark, sf), "stream-source")
