"""Projections, filters and scalar functions.

Derived doubles that pass through sine or decimal fractions are compared at
nine places; everything else is compared as it is.
"""

from pyspark.sql import functions as F

from fieldlake.functions import labels as LB, risk as R, weather as W
from fieldlake.operators import dataset as DS, disease as D, fields as FL, images as IM, timeline as TL
from fieldlake.plans.registry import query
from fieldlake.plans.scans import processed_metadata
from fieldlake.plans.views import ZONE, season_sql, with_views
from fieldlake.sources import domain as V

SEASONAL_SQL = """(CASE WHEN lat < 0 THEN -1 ELSE 1 END
    * sin(CAST(2 AS DOUBLE) * pi() * (dayofyear("timestamp") - 80) / 365))"""
PLACED = 'SELECT r.*, f.lat, f.lon FROM readings r JOIN fields f ON f.field_id = r.field_id'


def placed_readings(spark, sf):
    return V.readings(spark, sf).join(V.fields(spark, sf).select("field_id", "lat", "lon"), "field_id")


@query("climate_zone", with_views("fields", f"SELECT field_id, lat, {ZONE} AS climate_zone FROM fields"))
def climate_zone(spark, sf):
    return V.fields(spark, sf).select("field_id", "lat", W.climate_zone(F.col("lat")).alias("climate_zone"))


@query("season", with_views("field_days", f"""
    SELECT day_id, "timestamp", lat, {season_sql('dayofyear("timestamp")')} AS season FROM field_days"""))
def season(spark, sf):
    return V.field_days(spark, sf).select(
        "day_id", "timestamp", "lat", W.season(F.dayofyear("timestamp"), F.col("lat")).alias("season"))


@query("seasonal_factor", with_views("field_days", f"SELECT day_id, round({SEASONAL_SQL}, 9) AS seasonal FROM field_days"))
def seasonal_factor(spark, sf):
    factor = W.seasonal_factor(F.dayofyear("timestamp"), F.col("lat"))
    return V.field_days(spark, sf).select("day_id", F.round(factor, 9).alias("seasonal"))


@query("temperature_baseline", with_views("readings fields", f"""
    SELECT event_id, climate_zone, round(baseline, 9) AS baseline, round(temperature - baseline, 9) AS anomaly FROM (
    SELECT *, CASE climate_zone WHEN 'tropical' THEN 27 WHEN 'subtropical' THEN 22 WHEN 'temperate' THEN 15
      WHEN 'continental' THEN 10 ELSE -5 END
      + CASE climate_zone WHEN 'tropical' THEN 5 WHEN 'subtropical' THEN 10 WHEN 'temperate' THEN 15
      WHEN 'continental' THEN 20 ELSE 25 END * {SEASONAL_SQL}
      + CAST(8 AS DOUBLE) * (1 - abs(12 - hour("timestamp")) / CAST(12 AS DOUBLE)) - 4 AS baseline
    FROM (SELECT *, {ZONE} AS climate_zone FROM ({PLACED})))"""))
def temperature_baseline(spark, sf):
    rows = placed_readings(spark, sf).withColumn("climate_zone", W.climate_zone(F.col("lat")))
    seasonal = W.seasonal_factor(F.dayofyear("timestamp"), F.col("lat"))
    baseline = W.temperature_baseline(F.col("climate_zone"), seasonal, F.hour("timestamp"))
    return rows.select("event_id", "climate_zone", F.round(baseline, 9).alias("baseline"),
                       F.round(F.col("temperature") - baseline, 9).alias("anomaly"))


@query("humidity_baseline", with_views("readings fields", f"""
    SELECT event_id, round(baseline, 9) AS baseline, round(humidity - baseline, 9) AS anomaly FROM (SELECT *,
    greatest(20, least(95, CASE WHEN {ZONE} = 'tropical' THEN 70 ELSE 60 END
      - (temperature - 20) * CAST(1.5 AS DOUBLE))) AS baseline FROM ({PLACED}))"""))
def humidity_baseline(spark, sf):
    baseline = W.humidity_baseline(W.climate_zone(F.col("lat")), F.col("temperature"))
    return placed_readings(spark, sf).select(
        "event_id", F.round(baseline, 9).alias("baseline"),
        F.round(F.col("humidity") - baseline, 9).alias("anomaly"))


@query("rain_probability", with_views("readings fields", f"""
    SELECT climate_zone, south, day, count(*) AS n_readings,
    CAST(count(*) FILTER (WHERE rainfall > 0) AS DOUBLE) / count(*) AS observed_share,
    round(CASE WHEN climate_zone = 'tropical' THEN CAST(0.15 AS DOUBLE) ELSE CAST(0.08 AS DOUBLE) END
      * (1 + CAST(0.3 AS DOUBLE) * CASE WHEN south THEN -1 ELSE 1 END
      * sin(CAST(2 AS DOUBLE) * pi() * (day - 80) / 365)), 9) AS expected_share
    FROM (SELECT *, {ZONE} AS climate_zone, lat < 0 AS south, CAST(dayofyear("timestamp") AS INTEGER) AS day
      FROM ({PLACED})) GROUP BY climate_zone, south, day"""))
def rain_probability(spark, sf):
    rows = placed_readings(spark, sf).groupBy(
        W.climate_zone(F.col("lat")).alias("climate_zone"), (F.col("lat") < 0).alias("south"),
        F.dayofyear("timestamp").alias("day"))
    share = F.avg((F.col("rainfall") > 0).cast("int")).alias("observed_share")
    hemisphere = F.when(F.col("south"), -1.0).otherwise(1.0)
    expected = W.rain_probability(F.col("climate_zone"), W.seasonal_factor(F.col("day"), hemisphere))
    return rows.agg(F.count(F.lit(1)).alias("n_readings"), share).withColumn("expected_share", F.round(expected, 9))


@query("soil_baseline", with_views("readings", """
    SELECT event_id, round(temperature - temperature * CAST(0.85 AS DOUBLE), 9) AS temperature_residual,
    round(m, 9) AS expected_moisture, round(moisture - m, 9) AS moisture_residual,
    round(ph - greatest(CAST(5.5 AS DOUBLE), least(8, CAST(6.8 AS DOUBLE) - (m - 45) * CAST(0.01 AS DOUBLE))), 9) AS ph_residual,
    round(m / 50 * CAST(0.5 AS DOUBLE), 9) AS expected_ec
    FROM (SELECT *, greatest(15, least(95, 45 + rainfall * 5 + (humidity - 50) * CAST(0.2 AS DOUBLE)
      - (temperature - 20) * CAST(0.5 AS DOUBLE))) AS m FROM readings WHERE sensor_type = 'soil')"""))
def soil_baseline(spark, sf):
    air = F.col("temperature")
    expected = W.soil_moisture_baseline(F.col("rainfall"), F.col("humidity"), air)
    rows = V.readings(spark, sf).filter(F.col("sensor_type") == "soil").withColumn("m", expected)
    return rows.select(
        "event_id", F.round(air - W.soil_temperature_baseline(air), 9).alias("temperature_residual"),
        F.round("m", 9).alias("expected_moisture"), F.round(F.col("moisture") - F.col("m"), 9).alias("moisture_residual"),
        F.round(F.col("ph") - W.soil_ph_baseline(F.col("m")), 9).alias("ph_residual"),
        F.round(W.soil_ec_baseline(F.col("m")), 9).alias("expected_ec"))


@query("light_baseline", with_views("readings", """
    SELECT event_id, round(expected, 9) AS expected_light, round(CASE WHEN expected IS NOT NULL THEN light - expected
      ELSE light - greatest(0, least(100, light)) END, 9) AS residual
    FROM (SELECT *, moisture * 800 AS light, CASE WHEN hour("timestamp") BETWEEN 6 AND 18 THEN
      CAST(80000 AS DOUBLE) * (1 - abs(12 - hour("timestamp")) / CAST(6 AS DOUBLE)) * (100 - clouds) / 100 END AS expected
      FROM readings WHERE sensor_type = 'atmospheric')"""))
def light_baseline(spark, sf):
    hour, clouds, light = F.hour("timestamp"), F.col("clouds"), F.col("moisture") * 800
    return V.readings(spark, sf).filter(F.col("sensor_type") == "atmospheric").select(
        "event_id", F.round(W.light_baseline(hour, clouds), 9).alias("expected_light"),
        F.round(W.light_residual(hour, clouds, light), 9).alias("residual"))


@query("wind_direction_normalise", with_views("readings", """
    SELECT event_id, wind_direction, CAST(((wind_direction % 360) + 360) % 360 AS INTEGER) AS degrees FROM readings"""))
def wind_direction_normalise(spark, sf):
    return V.readings(spark, sf).select(
        "event_id", "wind_direction", W.wind_direction_normalised(F.col("wind_direction")).alias("degrees"))


def conditions(spark, sf):
    return D.with_crop(D.field_conditions(V.readings(spark, sf)), V.fields(spark, sf))


@query("risk_score", with_views("scored", "SELECT field_id, slot, disease, risk FROM scored"))
def risk_score(spark, sf):
    return D.score_all_rules(conditions(spark, sf)).select("field_id", "slot", "disease", "risk")


@query("risk_threshold", with_views("scored", """
    SELECT field_id, slot, disease, risk FROM scored WHERE risk > CAST(0.6 AS DOUBLE)"""))
def risk_threshold(spark, sf):
    return D.risky(D.score_all_rules(conditions(spark, sf))).select("field_id", "slot", "disease", "risk")


@query("severity_progress", with_views("readings", """
    SELECT event_id, progression, days, round(CASE progression
      WHEN 'exponential' THEN least(1, base * pow(CAST(1.1 AS DOUBLE), days))
      WHEN 'fast_exponential' THEN least(1, base * pow(CAST(1.2 AS DOUBLE), days))
      WHEN 'linear' THEN least(1, base + CAST(0.05 AS DOUBLE) * days)
      WHEN 'slow' THEN least(1, base + CAST(0.02 AS DOUBLE) * days) ELSE base END, 9) AS severity
    FROM (SELECT event_id, moisture / 200 AS base, CAST(event_id % 31 AS INTEGER) AS days,
      (['exponential', 'fast_exponential', 'linear', 'slow', 'other'])[event_id % 5 + 1] AS progression
      FROM readings)"""))
def severity_progress(spark, sf):
    kinds = F.array(*[F.lit(k) for k in ("exponential", "fast_exponential", "linear", "slow", "other")])
    rows = V.readings(spark, sf).select(
        "event_id", F.element_at(kinds, (F.col("event_id") % 5 + 1).cast("int")).alias("progression"),
        (F.col("event_id") % 31).cast("int").alias("days"), (F.col("moisture") / 200).alias("base"))
    grown = R.severity(F.col("base"), F.col("days"), F.col("progression"))
    return rows.select("event_id", "progression", "days", F.round(grown, 9).alias("severity"))


REFERENCE_TIME = "2024-01-30 00:00:00"


@query("freshness_gate", with_views("readings", f"""
    SELECT event_id, "timestamp", abs(epoch_us(TIMESTAMP '{REFERENCE_TIME}') - epoch_us("timestamp")) < 3600000000
    AS fresh FROM readings"""))
def freshness_gate(spark, sf):
    return V.readings(spark, sf).select(
        "event_id", "timestamp", W.freshness(F.col("timestamp"), F.lit(REFERENCE_TIME)).alias("fresh"))


@query("retention_filter", with_views("readings", f"""
    SELECT * FROM readings WHERE "timestamp" >= TIMESTAMP '{REFERENCE_TIME}' - INTERVAL 10 DAY"""))
def retention_filter(spark, sf):
    return TL.within_retention(V.readings(spark, sf), REFERENCE_TIME, days=10)


@query("permission_check", with_views("users roles", """
    SELECT o.o_orderkey AS request_id, o.o_custkey AS user_id, o.o_custkey IN (SELECT u.user_id FROM users u
      JOIN roles r ON r.role = u.role WHERE r.permission = 'run_simulation') AS allowed FROM orders o"""))
def permission_check(spark, sf):
    return FL.permission_check(requests(spark, sf), FL.with_permissions(V.users(spark, sf)), "run_simulation")


def requests(spark, sf):
    """Action requests, one per order; most requesters are unknown."""
    return V.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request_id"), F.col("o_custkey").alias("user_id"))


@query("parse_class_label", with_views("images", """
    SELECT image_id, class_label, split_part(class_label, '_', 1) AS plant_type,
    CASE WHEN contains(lower(class_label), 'healthy') THEN 'None' WHEN contains(replace(class_label, '__', '_'), '_')
    THEN substr(replace(class_label, '__', '_'), strpos(replace(class_label, '__', '_'), '_') + 1) ELSE 'Unknown' END AS disease_name,
    CASE WHEN contains(lower(class_label), 'healthy') THEN 'healthy' ELSE 'diseased' END AS health_status FROM images"""))
def parse_class_label(spark, sf):
    return DS.label_columns(V.images(spark, sf)).select("image_id", "class_label", "plant_type", "disease_name", "health_status")


@query("health_status", with_views("images", """
    SELECT image_id, CASE WHEN contains(lower(class_label), 'healthy') THEN 'healthy' ELSE 'diseased' END
    AS health_status FROM images"""))
def health_status(spark, sf):
    return V.images(spark, sf).select("image_id", LB.health_status(F.col("class_label")).alias("health_status"))


@query("file_properties", with_views("images", """
    SELECT image_id, filename, substr(path, 2) AS filepath, file_size_bytes,
    round(file_size_bytes / CAST(1024 AS DOUBLE), 2) AS file_size_kb, CASE WHEN filename LIKE '%.png' THEN 'PNG'
    ELSE 'JPEG' END AS format FROM images"""))
def file_properties(spark, sf):
    files = V.images(spark, sf).drop("filename")
    return DS.file_columns(files, root="s").select(
        "image_id", "filename", "filepath", "file_size_bytes", "file_size_kb", "format")


@query("image_properties", with_views("colour", """
    SELECT image_id, 6 AS width, 4 AS height, 3 AS channels, 'RGB' AS mode FROM colour
    UNION ALL SELECT image_id, 8, 8, 1, 'L' FROM gray"""))
def image_properties(spark, sf):
    both = V.pixel_images(spark, sf, "colour").unionByName(V.pixel_images(spark, sf))
    return IM.image_properties(both).select("image_id", "width", "height", "channels", "mode")


@query("build_disease_record", with_views("records", "SELECT * FROM records"))
def build_disease_record(spark, sf):
    records = D.disease_records(V.readings(spark, sf), V.fields(spark, sf))
    return records.select("*", "environmental_conditions.*").drop("environmental_conditions")


@query("sensor_ids", with_views("fields", """
    SELECT 'SOIL_' || field_id || '_' || printf('%03d', i) AS sensor_id, field_id, 'soil' AS sensor_type
    FROM fields, (SELECT unnest([1, 2, 3, 4, 5]) AS i)
    UNION ALL SELECT 'ATM_' || field_id || '_001', field_id, 'atmospheric' FROM fields"""))
def sensor_ids(spark, sf):
    return FL.expected_sensors(V.fields(spark, sf))


@query("field_defaults", with_views("fields", """
    SELECT field_id, CASE WHEN field_id % 3 = 0 THEN 1 ELSE area_hectares END AS area_hectares,
    CASE WHEN field_id % 5 = 0 THEN 'mixed' ELSE crop_type END AS crop_type,
    CASE WHEN field_id % 7 = 0 THEN 'loam' ELSE soil_type END AS soil_type,
    CASE WHEN field_id % 2 = 0 THEN TRUE ELSE active END AS active FROM fields"""))
def field_defaults(spark, sf):
    sparse = V.fields(spark, sf).select("field_id", *[
        F.when(F.col("field_id") % n != 0, F.col(c)).alias(c)
        for c, n in (("area_hectares", 3), ("crop_type", 5), ("soil_type", 7), ("active", 2))])
    return FL.with_field_defaults(sparse)


@query("geo_grid_key", with_views("fields", """
    SELECT field_id, printf('%.2f,%.2f', lat + area_hectares / 65536, lon) AS grid_key FROM fields"""))
def geo_grid_key(spark, sf):
    lat = F.col("lat") + F.col("area_hectares") / 65536
    return V.fields(spark, sf).select("field_id", W.grid_key(lat, F.col("lon")).alias("grid_key"))


@query("sensor_in_field_bbox", with_views("sensors fields", """
    SELECT s.sensor_id, s.field_id, abs((f.lat + (s.sensor_id % 5 - 2) * CAST(0.006 AS DOUBLE)) - f.lat)
      <= CAST(0.01 AS DOUBLE) AS in_field FROM sensors s JOIN fields f ON f.field_id = s.field_id"""))
def sensor_in_field_bbox(spark, sf):
    fields = V.fields(spark, sf)
    shift = (F.col("sensor_id") % 5 - 2) * F.lit(0.006)
    placed = V.sensors(spark, sf).join(fields.select("field_id", "lat", "lon"), "field_id").select(
        "sensor_id", "field_id", (F.col("lat") + shift).alias("lat"), "lon")
    return FL.sensors_in_field_box(placed, fields).select("sensor_id", "field_id", "in_field")


@query("ingest_path_date", with_views("readings", """
    SELECT event_id, strftime("timestamp", '%Y%m%d') AS day_part, strftime("timestamp", '%H%M%S') AS time_part
    FROM readings"""))
def ingest_path_date(spark, sf):
    return V.readings(spark, sf).select(
        "event_id", F.date_format("timestamp", "yyyyMMdd").alias("day_part"),
        F.date_format("timestamp", "HHmmss").alias("time_part"))


@query("recommend_fertiliser", with_views("readings", """
    SELECT field_id, avg_nitrogen, 'Nitrogen levels are low (' || CAST(floor(avg_nitrogen) AS BIGINT)
    || ' mg/kg). Recommended: apply urea fertilizer.' AS message
    FROM (SELECT field_id, avg(nitrogen - CASE WHEN field_id % 3 = 0 THEN 8 ELSE 0 END) AS avg_nitrogen FROM readings WHERE sensor_type = 'soil' GROUP BY 1)
    WHERE avg_nitrogen < 45"""))
def recommend_fertiliser(spark, sf):
    poor = F.when(F.col("field_id") % 3 == 0, 8).otherwise(0)  # a third of the fields lies under the limit
    return D.fertiliser_advice(V.readings(spark, sf).withColumn("nitrogen", F.col("nitrogen") - poor))
