"""Disease risk, infection course, alerts and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fieldlake import constants as K
from fieldlake.functions import risk as R, weather as W


def soil_averages(readings: DataFrame) -> DataFrame:
    """Mean soil moisture and temperature of a field at one time."""
    return readings.filter(F.col("sensor_type") == "soil").groupBy("field_id", "slot").agg(
        F.avg("moisture").alias("soil_moisture"), F.avg("temperature").alias("soil_temperature")
    )


def field_conditions(readings: DataFrame, time="slot") -> DataFrame:
    """Weather and mean soil state per field and time, in one aggregation.

    Readings carry their weather, so no join is needed. Partial aggregation
    leaves one row per (field, time) and map task before the shuffle, so a
    field with a third of all readings does not load one task. Fields without
    a soil sensor at that time are dropped: they are not checked.
    """
    soil = F.col("sensor_type") == "soil"
    return (
        readings.groupBy("field_id", time)
        .agg(
            F.max("temperature").alias("temperature"),
            F.max("humidity").alias("humidity"),
            F.max("rainfall").alias("rainfall"),
            F.avg(F.when(soil, F.col("moisture"))).alias("soil_moisture"),
            F.count_if(soil).alias("_soil_sensors"),
        )
        .filter(F.col("_soil_sensors") > 0)
        .drop("_soil_sensors")
    )


def readings_with_weather(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Every reading with the weather of its field at the same time (exact equi key).

    Pass the stored weather table rather than an aggregation: then both join
    sides are plain shuffles, and AQE can split a hot field and time.
    """
    context = [c for c in weather.columns if c not in ("field_id", "slot")]
    packed = weather.select("field_id", "slot", F.struct(*context).alias("weather_context"))
    return readings.join(packed, ["field_id", "slot"])


def with_crop(conditions: DataFrame, fields: DataFrame) -> DataFrame:
    """Conditions of active fields with crop and latitude."""
    places = fields.filter(F.col("active")).select("field_id", "crop_type", "lat")
    return conditions.join(places, "field_id")


def score_all_rules(conditions: DataFrame) -> DataFrame:
    """Join form: one row per (conditions, applicable rule) with its score.

    A theta join on text containment; the rule side has twelve fixed rows, so
    it is a broadcast nested loop of bounded width.
    """
    rules = F.broadcast(R.rule_table(conditions.sparkSession))
    joined = conditions.join(rules, R.crop_matches(F.col("disease"), F.col("crop_type")))
    score = R.risk_score(*[F.col(c) for c in (
        "temperature", "humidity", "rainfall", "soil_moisture", "temp_lo", "temp_hi", "hum_lo", "hum_hi",
        "rain_trigger", "moist_lo", "moist_hi")])
    return joined.withColumn("risk", score)


def risky(scored: DataFrame, threshold: float = K.RISK_THRESHOLD) -> DataFrame:
    """Scores strictly above the threshold."""
    return scored.filter(F.col("risk") > threshold)


def best_rules(conditions: DataFrame) -> DataFrame:
    """The winning rule per row of conditions; rows without one are dropped.

    Row-local (see ``functions.risk.best_rule``): neither join nor shuffle.
    """
    return (
        conditions.withColumn("_best", R.best_rule())
        .filter(F.col("_best").isNotNull())
        .withColumns({c: F.col(f"_best.{c}") for c in ("disease", "risk", "progression")})
        .drop("_best")
    )


def infection_progress(selected: DataFrame, time="slot", started: DataFrame | None = None) -> DataFrame:
    """Status, days and severity along each (field, disease).

    Input holds at most one row per field and time, so the window of one
    (field, disease) is bounded by the number of times, not by the number of
    readings: a hot field has been reduced before this point. ``started`` are the
    first detections of earlier runs (field_id, disease, started): an infection
    goes on from there.
    """
    course = Window.partitionBy("field_id", "disease").orderBy(time)
    first = F.first(time).over(course)
    is_new = F.row_number().over(course) == 1
    if started is not None:
        selected = selected.join(started, ["field_id", "disease"], "left")
        first = F.least(first, F.col("started"))
        is_new = is_new & (F.col(time) == first)
    days = R.whole_days(first, F.col(time))
    return (
        selected.withColumn("days_active", days)
        .withColumn("status", F.when(is_new, "new_infection").otherwise("active_infection"))
        .withColumn("severity", F.round(R.severity(F.col("risk"), F.col("days_active"), F.col("progression")), 3))
        .drop("started")
    )


def detections(readings: DataFrame, fields: DataFrame, started: DataFrame | None = None) -> DataFrame:
    """Readings to infections: which field has which disease, how severe, since when."""
    return infection_progress(best_rules(with_crop(field_conditions(readings), fields)), started=started)


def disease_records(readings: DataFrame, fields: DataFrame, started: DataFrame | None = None) -> DataFrame:
    """Nested records from the noon rows, the only ones the daily check looks at."""
    noon = readings.filter(F.hour("slot") == 12)
    found = detections(noon, fields, started)
    return found.select(
        "field_id", "disease", "severity", "status", F.col("slot").alias("detection_date"),
        F.struct("temperature", "humidity", "rainfall", "soil_moisture").alias("environmental_conditions"),
        W.season(F.dayofyear("slot"), F.col("lat")).alias("season"),
        W.climate_zone(F.col("lat")).alias("climate_zone"),
    )


def alerts(records: DataFrame, fields: DataFrame) -> DataFrame:
    names = fields.select("field_id", "name")
    words = F.regexp_replace(F.regexp_replace("disease", "^[^_]*_+", ""), "_+", " ")
    return records.join(names, "field_id").select(
        F.col("detection_date").alias("created_at"), "status", "field_id",
        F.format_string("%s risk detected in %s", words, F.col("name")).alias("message"),
    )


def active_infections(records: DataFrame) -> DataFrame:
    return records.filter(F.col("status") == "active_infection")


def newest(rows: DataFrame, time: str, tie: list[str], n: int) -> DataFrame:
    """The n newest rows (top-k per task, then merged; no full sort)."""
    return rows.orderBy(F.col(time).desc(), *tie).limit(n)


def newest_alerts(alerts: DataFrame, n: int, status: str | None = None, field_id=None) -> DataFrame:
    """The newest alerts, of one status or field when given; the filters reach the stored rows."""
    return newest(_only(alerts, status=status, field_id=field_id), "created_at", ["field_id", "message"], n)


def newest_diseases(records: DataFrame, n: int, field_id=None, disease: str | None = None, least_severity: float | None = None) -> DataFrame:
    """The newest disease records, of one field or disease, or from a severity on, when given."""
    found = _only(records, field_id=field_id, disease=disease)
    if least_severity is not None:
        found = found.filter(F.col("severity") >= least_severity)
    return newest(found, "detection_date", ["field_id", "disease"], n)


def _only(rows: DataFrame, **wanted) -> DataFrame:
    for column, value in wanted.items():
        if value is not None:
            rows = rows.filter(F.col(column) == value)
    return rows


def analytics(records: DataFrame) -> DataFrame:
    """Counts and severity per disease, season, zone and status. Severities are
    summed as decimals, so the mean does not depend on the order of tasks."""
    total = F.sum(F.col("severity").cast("decimal(10,3)")).cast("double")
    return records.groupBy("disease", "season", "climate_zone", "status").agg(
        F.count(F.lit(1)).alias("n_records"),
        (total / F.count("severity")).alias("mean_severity"),
        F.max("severity").alias("max_severity"),
    )


def labelled_readings(readings: DataFrame, records: DataFrame) -> DataFrame:
    """Readings with the disease found in their field on that day, else ``healthy``."""
    labels = records.select("field_id", F.to_date("detection_date").alias("day"), F.col("disease").alias("label"))
    return readings.withColumn("day", F.to_date("timestamp")).join(labels, ["field_id", "day"], "left").withColumn(
        "label", F.coalesce("label", F.lit("healthy"))
    )


def fertiliser_advice(readings: DataFrame, low: float = K.NITROGEN_LOW) -> DataFrame:
    """Advice per field whose mean soil nitrogen is under the limit."""
    mean = readings.filter(F.col("sensor_type") == "soil").groupBy("field_id").agg(
        F.avg("nitrogen").alias("avg_nitrogen")
    )
    text = F.format_string("Nitrogen levels are low (%d mg/kg). Recommended: apply urea fertilizer.",
                           F.floor("avg_nitrogen"))
    return mean.filter(F.col("avg_nitrogen") < low).withColumn("message", text)
