"""State through time and ranks inside classes."""

from fieldlake.operators import dataset as DS, disease as D, timeline as TL
from fieldlake.plans.registry import query
from fieldlake.plans.views import with_views
from fieldlake.sources import domain as V


@query("infection_progress", with_views("progress", """
    SELECT field_id, disease, slot, risk, days_active, status, severity FROM progress"""))
def infection_progress(spark, sf):
    return D.detections(V.readings(spark, sf), V.fields(spark, sf)).select(
        "field_id", "disease", "slot", "risk", "days_active", "status", "severity")


@query("stratified_split", with_views("split", """
    SELECT image_id, class_label, split FROM split"""))
def stratified_split(spark, sf):
    images = V.images(spark, sf).select("image_id", "class_label")
    return DS.stratified_split(images)


@query("latest_per_sensor", with_views("readings", """
    SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id
      ORDER BY "timestamp" DESC, event_id DESC) AS n FROM readings) WHERE n = 1"""))
def latest_per_sensor(spark, sf):
    return TL.latest_per_sensor(V.readings(spark, sf))


@query("rain_spells", with_views("readings", """
    SELECT sensor_id, dry_before, min("timestamp") AS spell_start, max("timestamp") AS spell_end,
    count(*) AS n_readings, CAST(sum(CAST(rainfall AS DECIMAL(28,9))) AS DOUBLE) AS total_rainfall,
    max(rainfall) AS peak_rainfall
    FROM (SELECT *, CAST(sum(CASE WHEN rainfall > 0 THEN 0 ELSE 1 END) OVER (PARTITION BY sensor_id
      ORDER BY "timestamp", event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS dry_before FROM readings)
    WHERE rainfall > 0 GROUP BY sensor_id, dry_before"""))
def rain_spells(spark, sf):
    return TL.rain_spells(V.readings(spark, sf))
