"""Streaming jobs, each run to the end of its input: all rows and all windows."""

from pyspark.sql import functions as F

from fieldlake.operators import disease as D
from fieldlake.plans.registry import query
from fieldlake.plans.views import progress_sql, with_views
from fieldlake.session import work_path
from fieldlake.sources import domain as V, streams as SR
from fieldlake.streaming import jobs as J


@query("stream_hot_cold", with_views("readings", """
    SELECT event_id, 'hot' AS store, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS ingest_date FROM readings
    UNION ALL SELECT event_id, 'cold', CAST(CAST("timestamp" AS DATE) AS VARCHAR) FROM readings"""))
def stream_hot_cold(spark, sf):
    hot, cold = J.hot_and_cold(SR.readings_stream(spark, sf), work_path(spark, "hot-cold"))
    day = F.to_date("timestamp").cast("string").alias("ingest_date")
    return spark.read.parquet(hot).select("event_id", F.lit("hot").alias("store"), day).unionByName(
        spark.read.parquet(cold).select("event_id", F.lit("cold").alias("store"),
                                        F.col("ingest_date").cast("string")))


@query("stream_infection_state", with_views("best readings", f"""
    , course AS ({progress_sql('best')})
    SELECT field_id, disease, slot, risk, days_active, status, severity FROM course"""))
def stream_infection_state(spark, sf):
    infections = J.Infections(spark, work_path(spark, "infections"), V.fields(spark, sf))
    return infections.drain(SR.readings_stream(spark, sf)).settle().result().select(
        "field_id", "disease", "slot", "risk", "days_active", "status", "severity")


@query("stream_alerts", with_views("records fields", """
    SELECT r.detection_date AS created_at, r.status, r.field_id,
    regexp_replace(regexp_replace(r.disease, '^[^_]*_+', ''), '_+', ' ', 'g') || ' risk detected in ' || f.name AS message
    FROM records r JOIN fields f ON f.field_id = r.field_id"""))
def stream_alerts(spark, sf):
    stored, fields = work_path(spark, "records"), V.fields(spark, sf)
    records = D.disease_records(V.readings(spark, sf), fields)
    records.write.parquet(stored)
    return J.drain_to_table(J.alert_stream(spark.readStream.schema(records.schema).parquet(stored), fields), "alerts")


@query("stream_trend_window", with_views("readings", """
    SELECT slot AS window_start, sensor_type, count(*) AS n_readings, avg(temperature) AS avg_temperature,
    avg(moisture) AS avg_moisture FROM readings GROUP BY 1, 2"""))
def stream_trend_window(spark, sf):
    trend = J.trend(spark, work_path(spark, "trend"))
    return J.trend_rows(trend.drain(SR.readings_stream(spark, sf)).result())


@query("stream_rain_sessions", with_views("readings", """
    , wet AS (SELECT * FROM readings WHERE rainfall > 0),
    begun AS (SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER s < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS first
      FROM wet WINDOW s AS (PARTITION BY sensor_id ORDER BY "timestamp", event_id)),
    numbered AS (SELECT *, sum(first) OVER (PARTITION BY sensor_id ORDER BY "timestamp", event_id
      ROWS UNBOUNDED PRECEDING) AS session FROM begun)
    SELECT sensor_id, min("timestamp") AS session_start, max("timestamp") + INTERVAL 12 HOUR AS session_end,
    count(*) AS n_readings, CAST(sum(CAST(rainfall AS DECIMAL(28,9))) AS DOUBLE) AS total_rainfall,
    max(rainfall) AS peak_rainfall FROM numbered GROUP BY sensor_id, session"""))
def stream_rain_sessions(spark, sf):
    sessions = J.rain_sessions(spark, work_path(spark, "rain-sessions"))
    return J.session_rows(sessions.drain(SR.readings_stream(spark, sf)).result())


@query("stream_dedupe", with_views("readings", "SELECT * FROM readings"))
def stream_dedupe(spark, sf):
    rows = SR.readings_stream(spark, sf)
    again = SR.readings_stream(spark, sf).filter(F.col("event_id") % 10 == 0)
    return J.deduped(spark, work_path(spark, "dedupe"), rows.schema).drain(rows.unionByName(again)).result()
