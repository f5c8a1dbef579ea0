"""Joins and set operations."""

from pyspark.sql import functions as F

from fieldlake.functions import labels as LB
from fieldlake.operators import dataset as DS, disease as D, fields as FL
from fieldlake.plans.registry import query
from fieldlake.plans.scalars import conditions, requests
from fieldlake.plans.views import with_views
from fieldlake.session import stored
from fieldlake.sources import domain as V


@query("join_fields_sensors", with_views("fields sensors", """
    SELECT f.field_id, f.name, f.crop_type, s.sensor_id, s.sensor_type FROM fields f
    JOIN sensors s ON s.field_id = f.field_id WHERE f.active AND s.status = 'active'"""))
def join_fields_sensors(spark, sf):
    return FL.fields_with_sensors(V.fields(spark, sf), V.sensors(spark, sf)).select(
        "field_id", "name", "crop_type", "sensor_id", "sensor_type")


@query("join_readings_weather", with_views("readings weather", """
    SELECT r.event_id, r.field_id, r.slot, w.temperature, w.humidity, w.rainfall FROM readings r
    JOIN weather w ON w.field_id = r.field_id AND w.slot = r.slot"""))
def join_readings_weather(spark, sf):
    rows = V.readings(spark, sf).select("event_id", "field_id", "slot")
    return D.readings_with_weather(rows, stored(V.weather(spark, sf), "weather")).select(
        "event_id", "field_id", "slot", "weather_context.*")


@query("join_conditions_rules", with_views("scored", """
    SELECT field_id, slot, crop_type, ordinal, disease, progression FROM scored"""))
def join_conditions_rules(spark, sf):
    return D.score_all_rules(conditions(spark, sf)).select(
        "field_id", "slot", "crop_type", "ordinal", "disease", "progression")


@query("join_role_permissions", with_views("users roles", """
    SELECT u.user_id, u.name, u.role, r.permission FROM users u JOIN roles r ON r.role = u.role"""))
def join_role_permissions(spark, sf):
    return FL.with_permissions(V.users(spark, sf)).select(
        "user_id", "name", "role", F.explode("permissions").alias("permission"))


@query("semi_authorised", with_views("users roles", """
    SELECT o_orderkey AS request_id, o_custkey AS user_id FROM orders WHERE o_custkey IN (SELECT u.user_id FROM users u
      JOIN roles r ON r.role = u.role WHERE r.permission = 'run_simulation')"""))
def semi_authorised(spark, sf):
    return FL.authorised_requests(requests(spark, sf), FL.with_permissions(V.users(spark, sf)), "run_simulation")


@query("rows_visible_to_user", with_views("readings fields", """
    SELECT * FROM readings WHERE field_id IN (SELECT field_id FROM fields WHERE user_id = 16)"""))
def rows_visible_to_user(spark, sf):
    """A farmer: rows of own fields only."""
    return FL.rows_for_user(V.readings(spark, sf), V.fields(spark, sf), FL.with_permissions(V.users(spark, sf)), 16)


@query("rows_visible_to_researcher", with_views("readings", "SELECT * FROM readings"))
def rows_visible_to_researcher(spark, sf):
    return FL.rows_for_user(V.readings(spark, sf), V.fields(spark, sf), FL.with_permissions(V.users(spark, sf)), 2)


@query("own_rows_by_user", with_views("readings fields users", """
    SELECT r.event_id, r.field_id, u.user_id FROM readings r JOIN fields f ON f.field_id = r.field_id
    JOIN users u ON u.user_id = f.user_id WHERE u.role = 'FARMER'"""))
def own_rows_by_user(spark, sf):
    rows = V.readings(spark, sf).select("event_id", "field_id")
    return FL.own_rows(rows, V.fields(spark, sf), FL.with_permissions(V.users(spark, sf)))


@query("alerts_from_disease", with_views("records fields", """
    SELECT r.detection_date AS created_at, r.status, r.field_id,
    regexp_replace(regexp_replace(r.disease, '^[^_]*_+', ''), '_+', ' ', 'g') || ' risk detected in ' || f.name AS message
    FROM records r JOIN fields f ON f.field_id = r.field_id"""))
def alerts_from_disease(spark, sf):
    fields = V.fields(spark, sf)
    return D.alerts(D.disease_records(V.readings(spark, sf), fields), fields)


@query("join_labels_training", with_views("readings records", """
    SELECT r.event_id, r.field_id, coalesce(d.disease, 'healthy') AS label FROM readings r LEFT JOIN records d
    ON d.field_id = r.field_id AND CAST(d.detection_date AS DATE) = CAST(r."timestamp" AS DATE)"""))
def join_labels_training(spark, sf):
    readings = V.readings(spark, sf)
    records = D.disease_records(readings, V.fields(spark, sf))
    return D.labelled_readings(readings, records).select("event_id", "field_id", "label")


@query("union_soil_atmospheric", with_views("readings", """
    SELECT event_id, sensor_type, CASE WHEN sensor_type = 'soil' THEN moisture END AS moisture,
    CASE WHEN sensor_type = 'soil' THEN nitrogen END AS nitrogen, temperature,
    CASE WHEN sensor_type = 'atmospheric' THEN humidity END AS humidity FROM readings"""))
def union_soil_atmospheric(spark, sf):
    rows = V.readings(spark, sf)
    soil = rows.filter(F.col("sensor_type") == "soil").select(
        "event_id", "sensor_type", "moisture", "nitrogen", "temperature")
    air = rows.filter(F.col("sensor_type") == "atmospheric").select(
        "event_id", "sensor_type", "temperature", "humidity")
    return soil.unionByName(air, allowMissingColumns=True)


@query("union_image_globs", with_views("images", """
    SELECT image_id, path FROM images WHERE filename LIKE '%.jpg'
    UNION ALL SELECT image_id, path FROM images WHERE filename LIKE '%.png'"""))
def union_image_globs(spark, sf):
    return DS.union_by_suffix(V.images(spark, sf).select("image_id", "path"))


@query("union_original_augmented", with_views("fanned", """
    SELECT image_id, class_label, split, copy, suffix, split_part(filename, '.', 1) || suffix || '.jpg' AS output_name
    FROM fanned"""))
def union_original_augmented(spark, sf):
    images = V.images(spark, sf).select("image_id", "class_label", "path")
    fanned = DS.with_copies(DS.stratified_split(images))
    return fanned.select("image_id", "class_label", "split", "copy", "suffix",
                         DS.output_name(F.col("path"), F.col("suffix")).alias("output_name"))
