"""Data-quality checks."""

from pyspark.sql import functions as F

from fieldlake import constants as K
from fieldlake.operators import constraints as C, quality as Q, timeline as TL
from fieldlake.plans.registry import query
from fieldlake.plans.views import CLASSES, with_views
from fieldlake.sources import domain as V

# Measured columns that the mapped readings lack, so that every rule meets rows.
MORE_READINGS = {
    "electrical_conductivity": "CAST(event_id % 40 - 1 AS DOUBLE)", "phosphorus": "CAST(event_id % 60 - 2 AS DOUBLE)",
    "potassium": "CAST(event_id % 70 - 3 AS DOUBLE)", "wind_speed": "CAST(event_id % 30 - 1 AS DOUBLE)",
    "light_intensity": "CAST(event_id % 90 - 2 AS DOUBLE)",
}
MORE_WEATHER = {
    "wind_speed": "CAST(rainfall - 1 AS DOUBLE)", "clouds": "CAST(humidity + 3 AS DOUBLE)",
    "wind_direction": "CAST(humidity * 5 - 160 AS DOUBLE)",
}


def _more(columns):
    return {name: F.expr(sql) for name, sql in columns.items()}


def _range_sql(table, key, ranges, more) -> str:
    parts, source = [], f"(SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in more.items())} FROM {table})"
    for column, low, high in ranges:
        tests = ([f"{column} < {low}"] if low is not None else []) + ([f"{column} > {high}"] if high is not None else [])
        parts.append(f"SELECT {key}, '{column}' AS column_name, CAST({column} AS DOUBLE) AS bad_value "
                     f"FROM {source} WHERE {' OR '.join(tests)}")
    return " UNION ALL ".join(parts)


@query("dq_range", with_views("readings", _range_sql("readings", "event_id", K.READING_RANGES, MORE_READINGS)))
def dq_range(spark, sf):
    return Q.out_of_range(V.readings(spark, sf).withColumns(_more(MORE_READINGS)), K.READING_RANGES, "event_id")


@query("dq_range_weather", with_views("weather", _range_sql("weather", "field_id", K.WEATHER_RANGES, MORE_WEATHER)))
def dq_range_weather(spark, sf):
    return Q.out_of_range(V.weather(spark, sf).withColumns(_more(MORE_WEATHER)), K.WEATHER_RANGES, "field_id")


@query("dq_primary_key", with_views("repeated", """
    SELECT sensor_id, "timestamp", count(*) AS n_rows FROM repeated GROUP BY 1, 2 HAVING count(*) > 1"""))
def dq_primary_key(spark, sf):
    return Q.key_violations(V.repeated_readings(spark, sf), ["sensor_id", "timestamp"])


@query("dq_foreign_key", with_views("sensors fields", """
    SELECT * FROM sensors WHERE field_id NOT IN (SELECT field_id FROM fields WHERE active)"""))
def dq_foreign_key(spark, sf):
    return Q.orphans(V.sensors(spark, sf), V.fields(spark, sf).filter("active"), "field_id")


@query("dq_not_null", with_views("fields", """
    SELECT 'name' AS column_name, count(*) FILTER (WHERE field_id % 4 = 3) AS n_null FROM fields
    UNION ALL SELECT 'soil_type', count(*) FILTER (WHERE field_id % 10 = 9) FROM fields"""))
def dq_not_null(spark, sf):
    holed = V.fields(spark, sf).select(
        F.when(F.col("crop_type") != "mixed", F.col("name")).alias("name"),
        F.when(F.col("active"), F.col("soil_type")).alias("soil_type"))
    return Q.null_counts(holed, ["name", "soil_type"])


def flawed_tables(spark, sf):
    """The relational tables with flaws in each kind of column: long and missing values, repeated keys."""
    tables = V.relational_tables(spark, sf)
    key = lambda c: F.col(c).cast("long")
    fields, sensors, jobs, daily = (tables[t] for t in ("fields", "sensors", "batch_jobs", "analytics_summary"))
    fields = fields.withColumns({
        "name": F.when(key("field_id") % 7 == 0, None).when(key("field_id") % 11 == 0, F.repeat("name", F.lit(8))).otherwise(F.col("name")),
        "soil_type": F.when(key("field_id") % 5 == 0, F.repeat("soil_type", F.lit(9))).otherwise(F.col("soil_type"))})
    sensors = sensors.unionByName(sensors.filter(key("sensor_id") % 9 == 0)).withColumns({
        "sensor_type": F.when(key("sensor_id") % 13 != 0, F.col("sensor_type")),
        "status": F.when(key("sensor_id") % 8 == 0, F.repeat("status", F.lit(5))).otherwise(F.col("status"))})
    jobs = jobs.withColumns({
        "job_id": F.when(key("job_id") % 17 != 0, F.col("job_id")), "job_name": F.when(key("records_processed") % 19 != 0, F.col("job_name")),
        "start_time": F.when(key("records_processed") % 23 != 0, F.col("start_time"))})
    daily = daily.withColumn("field_id", F.when(key("field_id") % 4 == 0, F.repeat("field_id", F.lit(60))).otherwise(F.col("field_id")))
    return {"fields": fields, "sensors": sensors, "batch_jobs": jobs, "analytics_summary": daily}


FLAWED = """
    , x_fields AS (SELECT * REPLACE (CASE WHEN CAST(field_id AS BIGINT) % 7 = 0 THEN NULL WHEN CAST(field_id AS BIGINT) % 11 = 0
      THEN repeat(name, 8) ELSE name END AS name, CASE WHEN CAST(field_id AS BIGINT) % 5 = 0 THEN repeat(soil_type, 9) ELSE soil_type END
      AS soil_type) FROM r_fields),
    x_sensors AS (SELECT * REPLACE (CASE WHEN CAST(sensor_id AS BIGINT) % 13 <> 0 THEN sensor_type END AS sensor_type,
      CASE WHEN CAST(sensor_id AS BIGINT) % 8 = 0 THEN repeat(status, 5) ELSE status END AS status)
      FROM (SELECT * FROM r_sensors UNION ALL SELECT * FROM r_sensors WHERE CAST(sensor_id AS BIGINT) % 9 = 0)),
    x_jobs AS (SELECT * REPLACE (CASE WHEN CAST(job_id AS BIGINT) % 17 <> 0 THEN job_id END AS job_id,
      CASE WHEN records_processed % 19 <> 0 THEN job_name END AS job_name, CASE WHEN records_processed % 23 <> 0 THEN start_time END AS start_time)
      FROM r_batch_jobs),
    x_daily AS (SELECT * REPLACE (CASE WHEN CAST(field_id AS BIGINT) % 4 = 0 THEN repeat(field_id, 60) ELSE field_id END AS field_id)
      FROM r_analytics_summary)"""


def _rule_sql(table: str, source: str, key: str, tests: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {key} AS row_key, '{column}' AS column_name, '{rule}' AS rule, count(*) AS n_rows "
        f"FROM {source} WHERE {test} GROUP BY 2" + (" HAVING count(*) > 1" if rule == "primary_key" else "") for column, rule, test in tests)


RULES_SQL = " UNION ALL ".join([
    _rule_sql("fields", "x_fields", "coalesce(field_id, 'null')", [
        ("field_id", "not_null", "field_id IS NULL"), ("name", "not_null", "name IS NULL"), ("field_id", "length", "length(field_id) > 50"),
        ("name", "length", "length(name) > 100"), ("soil_type", "length", "length(soil_type) > 50"), ("field_id", "primary_key", "field_id IS NOT NULL")]),
    _rule_sql("sensors", "x_sensors", "coalesce(sensor_id, 'null')", [
        ("sensor_id", "not_null", "sensor_id IS NULL"), ("sensor_type", "not_null", "sensor_type IS NULL"),
        ("sensor_id", "length", "length(sensor_id) > 50"), ("field_id", "length", "length(field_id) > 50"),
        ("sensor_type", "length", "length(sensor_type) > 20"), ("status", "length", "length(status) > 20"),
        ("sensor_id", "primary_key", "sensor_id IS NOT NULL")]),
    _rule_sql("batch_jobs", "x_jobs", "coalesce(job_id, 'null')", [
        ("job_id", "not_null", "job_id IS NULL"), ("job_name", "not_null", "job_name IS NULL"), ("start_time", "not_null", "start_time IS NULL"),
        ("job_name", "length", "length(job_name) > 100"), ("status", "length", "length(status) > 20"), ("job_id", "primary_key", "job_id IS NOT NULL")]),
    _rule_sql("analytics_summary", "x_daily", "coalesce(CAST(analysis_date AS VARCHAR), 'null') || '|' || coalesce(field_id, 'null')", [
        ("analysis_date", "not_null", "analysis_date IS NULL"), ("field_id", "not_null", "field_id IS NULL"), ("field_id", "length", "length(field_id) > 50"),
        ("avg_moisture", "range", "avg_moisture < 15 OR avg_moisture > 95"),
        ("analysis_date,field_id", "primary_key", "analysis_date IS NOT NULL AND field_id IS NOT NULL")]),
])


@query("dq_declared", with_views("r_fields r_sensors r_batch_jobs r_analytics_summary", FLAWED + RULES_SQL))
def dq_declared(spark, sf):
    """Every declared rule of the four relational tables, one scan of each."""
    return C.declared_violations(flawed_tables(spark, sf), V.relational_sizes(spark, sf))


@query("dq_length", with_views("r_fields r_sensors r_batch_jobs r_analytics_summary", FLAWED + f"SELECT * FROM ({RULES_SQL}) WHERE rule = 'length'"))
def dq_length(spark, sf):
    """Texts longer than their declared column."""
    return C.declared_violations(flawed_tables(spark, sf), V.relational_sizes(spark, sf)).filter("rule = 'length'")


@query("dq_expected_classes", with_views("images", f"""
    , seen AS (SELECT DISTINCT CASE WHEN class_label = 'Potato___healthy' THEN 'Unknownclass' ELSE class_label END
      AS class_label FROM images), wanted AS (SELECT unnest([{CLASSES}]) AS class_label)
    SELECT class_label, 'unexpected' AS problem FROM seen WHERE class_label NOT IN (SELECT class_label FROM wanted)
    UNION ALL SELECT class_label, 'missing' FROM wanted WHERE class_label NOT IN (SELECT class_label FROM seen)"""))
def dq_expected_classes(spark, sf):
    label = F.when(F.col("class_label") == "Potato___healthy", "Unknownclass").otherwise(F.col("class_label"))
    return Q.class_mismatches(V.images(spark, sf).select(label.alias("class_label")))


@query("dq_duplicate_paths", with_views("images", """
    SELECT class_label, stem, count(*) AS n_inputs FROM (
      SELECT class_label, path, split_part(filename, '.', 1) AS stem FROM images
      UNION ALL SELECT class_label, path || '.bmp', filename FROM images WHERE image_id % 3 = 0
      UNION ALL SELECT class_label, replace(path, '.', '0.'), split_part(filename, '.', 1) || '0' FROM images)
    GROUP BY class_label, stem HAVING count(*) > 1"""))
def dq_duplicate_paths(spark, sf):
    images = V.images(spark, sf).select("image_id", "class_label", "path")
    double = images.filter(F.col("image_id") % 3 == 0).withColumn("path", F.concat("path", F.lit(".bmp")))
    longer = images.withColumn("path", F.replace("path", F.lit("."), F.lit("0.")))
    return Q.name_clashes(images.unionByName(double).unionByName(longer))


@query("dq_split_classes", with_views("images", """
    SELECT class_label, count(DISTINCT regexp_replace(path, '/[^/]*$', '')) AS n_folders FROM images
    GROUP BY class_label HAVING count(DISTINCT regexp_replace(path, '/[^/]*$', '')) > 1"""))
def dq_split_classes(spark, sf):
    return Q.split_classes(V.images(spark, sf))


@query("dq_missing_slots", with_views("readings", """
    , filled AS (SELECT DISTINCT sensor_id, time_bucket(INTERVAL 3 HOUR, "timestamp", TIMESTAMP '2000-01-01') AS slot
      FROM readings), spans AS (SELECT sensor_id, date_trunc('day', min(slot)) AS a, date_trunc('day', max(slot)) AS b
      FROM filled GROUP BY 1),
    grid AS (SELECT sensor_id, CAST(unnest(range(a, b + INTERVAL 1 DAY, INTERVAL 3 HOUR)) AS TIMESTAMP) AS slot FROM spans)
    SELECT sensor_id, slot FROM grid EXCEPT SELECT sensor_id, slot FROM filled"""))
def dq_missing_slots(spark, sf):
    return TL.missing_slots(V.readings(spark, sf))


@query("dq_input_present", with_views("images", """
    SELECT count(*) FILTER (WHERE filename LIKE '%.jpg' OR filename LIKE '%.png') AS n_images,
    count(*) FILTER (WHERE filename LIKE '%.jpg' OR filename LIKE '%.png') > 0 AS present FROM images"""))
def dq_input_present(spark, sf):
    return Q.input_present(V.images(spark, sf))
