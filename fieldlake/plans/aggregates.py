"""Aggregations, sorts, top-k."""

from pyspark.sql import functions as F

from fieldlake.functions import weather as W
from fieldlake.operators import dataset as DS, disease as D, images as IM, summary as S, timeline as TL
from fieldlake.plans.pixels import STATS_SQL
from fieldlake.plans.registry import query
from fieldlake.plans.scalars import conditions
from fieldlake.plans.scans import processed_metadata
from fieldlake.plans.sinks import SUMMARY
from fieldlake.plans.views import ZONE, season_sql, with_views
from fieldlake.session import work_path
from fieldlake.sinks import dataset as SD
from fieldlake.sources import domain as V


def records(spark, sf):
    return D.disease_records(V.readings(spark, sf), V.fields(spark, sf))


def flat_records(spark, sf):
    return records(spark, sf).select("*", "environmental_conditions.*").drop("environmental_conditions")


@query("avg_soil_by_field_time", with_views("soil", "SELECT * FROM soil"))
def avg_soil_by_field_time(spark, sf):
    return D.soil_averages(V.readings(spark, sf))


@query("field_counts", with_views("readings records", """
    SELECT r.field_id, r.n_readings, coalesce(d.n, 0) AS n_diseases
    FROM (SELECT field_id, count(*) AS n_readings FROM readings GROUP BY 1) r
    LEFT JOIN (SELECT field_id, count(*) AS n FROM records GROUP BY 1) d ON d.field_id = r.field_id"""))
def field_counts(spark, sf):
    return S.counts_by_field(V.readings(spark, sf), records(spark, sf))


@query("global_counts", with_views("readings records", """
    SELECT 'readings' AS entity, count(*) AS n_rows FROM readings
    UNION ALL SELECT 'disease_records', count(*) FROM records"""))
def global_counts(spark, sf):
    return S.counts_of({"readings": V.readings(spark, sf), "disease_records": records(spark, sf)})


@query("avg_moisture_by_field", with_views("readings", """
    SELECT field_id, avg(moisture) AS avg_moisture FROM readings GROUP BY field_id"""))
def avg_moisture_by_field(spark, sf):
    return S.average_moisture(V.readings(spark, sf))


@query("daily_field_summary", with_views("readings records", """
    SELECT CAST(r.day AS VARCHAR) AS analysis_date, r.field_id, r.total_readings, r.avg_temperature, r.avg_moisture,
    coalesce(d.n, 0) AS disease_count FROM (SELECT CAST("timestamp" AS DATE) AS day, field_id,
      count(*) AS total_readings, CAST(avg(temperature) AS DECIMAL(5,2)) AS avg_temperature,
      CAST(avg(moisture) AS DECIMAL(5,2)) AS avg_moisture FROM readings GROUP BY 1, 2) r
    LEFT JOIN (SELECT CAST(detection_date AS DATE) AS day, field_id, count(*) AS n FROM records GROUP BY 1, 2) d
    ON d.day = r.day AND d.field_id = r.field_id"""))
def daily_field_summary(spark, sf):
    summary = S.daily_field_summary(V.readings(spark, sf), records(spark, sf))
    return summary.withColumn("analysis_date", F.col("analysis_date").cast("string"))


@query("disease_analytics", with_views("progress fields", f"""
    SELECT disease, season, climate_zone, status, count(*) AS n_records,
    CAST(sum(CAST(severity AS DECIMAL(10,3))) AS DOUBLE) / count(*) AS mean_severity, max(severity) AS max_severity
    FROM (SELECT p.*, {season_sql('dayofyear(p.slot)')} AS season, {ZONE} AS climate_zone
      FROM (SELECT field_id, disease, slot, status, severity FROM progress) p
      JOIN (SELECT field_id, lat FROM fields) f ON f.field_id = p.field_id) GROUP BY 1, 2, 3, 4"""))
def disease_analytics(spark, sf):
    found = D.detections(V.readings(spark, sf), V.fields(spark, sf))
    return D.analytics(found.withColumns({
        "season": W.season(F.dayofyear("slot"), F.col("lat")), "climate_zone": W.climate_zone(F.col("lat"))}))


@query("disease_analytics_noon", with_views("records", """
    SELECT disease, season, climate_zone, status, count(*) AS n_records,
    CAST(sum(CAST(severity AS DECIMAL(10,3))) AS DOUBLE) / count(*) AS mean_severity, max(severity) AS max_severity
    FROM records GROUP BY 1, 2, 3, 4"""))
def disease_analytics_noon(spark, sf):
    return D.analytics(records(spark, sf))


@query("sensor_trend_hourly", with_views("readings", """
    SELECT slot AS window_start, sensor_type, count(*) AS n_readings, avg(temperature) AS avg_temperature,
    avg(moisture) AS avg_moisture FROM readings GROUP BY 1, 2"""))
def sensor_trend_hourly(spark, sf):
    return TL.hourly_trend(V.readings(spark, sf))


@query("count_by_plant_health", with_views("labelled", """
    SELECT plant_type, health_status, count(*) AS n_images FROM labelled GROUP BY 1, 2"""))
def count_by_plant_health(spark, sf):
    return DS.counts_by_plant_health(processed_metadata(spark, sf))


@query("class_distribution", with_views("split", """
    SELECT class_label, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'val') AS val,
    count(*) FILTER (WHERE split = 'test') AS test, count(*) AS total FROM split GROUP BY class_label"""))
def class_distribution(spark, sf):
    return DS.class_distribution(DS.stratified_split(V.images(spark, sf).select("image_id", "class_label")))


@query("class_counts", with_views("images", """
    SELECT class_label, count(*) AS n_images FROM images
    WHERE lower(filename) LIKE '%.jpg' OR lower(filename) LIKE '%.png' GROUP BY class_label"""))
def class_counts(spark, sf):
    return DS.class_counts(DS.raw_images(V.images(spark, sf)))


@query("split_counts", with_views("split", """
    SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'val') AS n_val,
    count(*) FILTER (WHERE split = 'test') AS n_test FROM split"""))
def split_counts(spark, sf):
    return DS.split_counts(DS.stratified_split(V.images(spark, sf).select("image_id", "class_label")))


@query("image_size_stats", with_views("labelled", f"""
    SELECT avg_width, avg_height, avg_file_size_kb, total_size_mb FROM ({SUMMARY})"""))
def image_size_stats(spark, sf):
    return DS.image_size_stats(processed_metadata(spark, sf))


@query("health_counts", with_views("labelled", """
    SELECT count(*) FILTER (WHERE health_status = 'healthy') AS n_healthy,
    count(*) FILTER (WHERE health_status = 'diseased') AS n_diseased FROM labelled"""))
def health_counts(spark, sf):
    return DS.health_counts(processed_metadata(spark, sf))


@query("plant_value_counts", with_views("labelled", """
    SELECT plant_type, count(*) AS n_images FROM labelled GROUP BY 1 ORDER BY 2 DESC, 1"""))
def plant_value_counts(spark, sf):
    return DS.plant_counts(processed_metadata(spark, sf))


@query("distinct_classes", with_views("images", """
    SELECT DISTINCT class_label, (SELECT count(DISTINCT class_label) FROM images) AS num_classes FROM images"""))
def distinct_classes(spark, sf):
    return DS.distinct_classes(V.images(spark, sf))


@query("dataset_summary", with_views("labelled", SUMMARY))
def dataset_summary(spark, sf):
    return DS.dataset_summary(processed_metadata(spark, sf), "leaf-images").select(
        "dataset_name", "overview.total_images", "overview.num_classes", "overview.splits.*", "image_properties.*",
        "health_status_distribution.*")


@query("pixel_summary", with_views("gray_pixels", f"""
    SELECT CAST(sum(CAST(pixel_mean AS DECIMAL(20,8))) AS DOUBLE) / count(*) AS overall_mean,
    CAST(sum(CAST(pixel_std AS DECIMAL(20,8))) AS DOUBLE) / count(*) AS overall_std FROM ({STATS_SQL})"""))
def pixel_summary(spark, sf):
    return IM.pixel_summary(IM.pixel_stats(V.pixel_images(spark, sf)))


@query("processing_stats", with_views("pixel_files", """
    , tried AS (SELECT image_id % 13 = 0 AS bad, CASE WHEN split = 'train' THEN 4 ELSE 1 END AS n FROM pixel_files)
    SELECT count(*) AS n_scanned, CAST(sum(n) FILTER (WHERE NOT bad) AS BIGINT) AS n_processed,
    count(*) FILTER (WHERE NOT bad) AS n_originals, CAST(sum(n - 1) FILTER (WHERE NOT bad) AS BIGINT) AS n_copies,
    CAST(0 AS BIGINT) AS n_skipped, count(*) FILTER (WHERE bad) AS n_corrupted,
    CAST(sum(n) FILTER (WHERE NOT bad) AS DOUBLE) / count(*) * 100 AS success_rate FROM tried"""))
def processing_stats(spark, sf):
    """Images with undecodable ones among them go through copying, changing and storing; the log follows from what is stored."""
    files = DS.processed_images(V.processed_pixels(spark, sf, "mixed"))
    made = IM.apply_augmentation(DS.augmentation_draws(DS.with_copies(IM.valid_images(files)), "image_id"))
    path = work_path(spark, "processed")
    SD.write_processed_images(made.withColumn("name", DS.output_name(F.col("path"), F.col("suffix"))), path)
    planned = DS.with_copies(files.select("image_id", "split")).select("image_id", "copy")
    return DS.processing_stats(DS.attempt_log(planned, spark.read.parquet(path).select("image_id", "copy"), "image_id"))


@query("best_rule_argmax", with_views("best", """
    SELECT field_id, slot, crop_type, disease, risk, progression FROM best"""))
def best_rule_argmax(spark, sf):
    return D.best_rules(conditions(spark, sf)).select(
        "field_id", "slot", "crop_type", "disease", "risk", "progression")


@query("entity_counts", with_views("users fields sensors records", """
    SELECT 'users' AS entity, count(*) AS n_rows FROM users UNION ALL SELECT 'fields', count(*) FROM fields
    UNION ALL SELECT 'sensors', count(*) FROM sensors UNION ALL SELECT 'diseases', count(*) FROM records"""))
def entity_counts(spark, sf):
    return S.counts_of({"users": V.users(spark, sf), "fields": V.fields(spark, sf),
                        "sensors": V.sensors(spark, sf), "diseases": records(spark, sf)})


@query("dedupe_readings", with_views("readings", "SELECT * FROM readings"))
def dedupe_readings(spark, sf):
    return TL.dedupe(V.repeated_readings(spark, sf))


@query("latest_n_readings", with_views("readings", """
    SELECT * FROM readings ORDER BY "timestamp" DESC, event_id LIMIT 3"""))
def latest_n_readings(spark, sf):
    return D.newest(V.readings(spark, sf), "timestamp", ["event_id"], 3)


@query("sort_metadata", with_views("labelled", """
    SELECT image_id, split, class_label, filename FROM labelled ORDER BY split, class_label, filename"""))
def sort_metadata(spark, sf):
    return DS.sorted_metadata(processed_metadata(spark, sf).select("image_id", "split", "class_label", "filename"))


@query("newest_alerts", with_views("records fields", """
    SELECT r.detection_date AS created_at, r.status, r.field_id,
    regexp_replace(regexp_replace(r.disease, '^[^_]*_+', ''), '_+', ' ', 'g') || ' risk detected in ' || f.name AS message
    FROM records r JOIN fields f ON f.field_id = r.field_id ORDER BY created_at DESC, r.field_id, message LIMIT 20"""))
def newest_alerts(spark, sf):
    fields = V.fields(spark, sf)
    return D.newest_alerts(D.alerts(records(spark, sf), fields), 20)


@query("newest_diseases", with_views("records", """
    SELECT * FROM records ORDER BY detection_date DESC, field_id, disease LIMIT 20"""))
def newest_diseases(spark, sf):
    return D.newest_diseases(flat_records(spark, sf), 20)


@query("newest_alerts_by_status", with_views("records fields", """
    SELECT r.detection_date AS created_at, r.status, r.field_id,
    regexp_replace(regexp_replace(r.disease, '^[^_]*_+', ''), '_+', ' ', 'g') || ' risk detected in ' || f.name AS message
    FROM records r JOIN fields f ON f.field_id = r.field_id WHERE r.status = 'active_infection'
    ORDER BY created_at DESC, r.field_id, message LIMIT 10"""))
def newest_alerts_by_status(spark, sf):
    return D.newest_alerts(D.alerts(records(spark, sf), V.fields(spark, sf)), 10, status="active_infection")


@query("newest_severe_diseases", with_views("records", """
    SELECT * FROM records WHERE severity >= 0.8 AND disease = 'Tomato_Septoria_leaf_spot'
    ORDER BY detection_date DESC, field_id, disease LIMIT 10"""))
def newest_severe_diseases(spark, sf):
    return D.newest_diseases(flat_records(spark, sf), 10, disease="Tomato_Septoria_leaf_spot", least_severity=0.8)


@query("active_infections", with_views("records", "SELECT * FROM records WHERE status = 'active_infection'"))
def active_infections(spark, sf):
    return D.active_infections(flat_records(spark, sf))
