"""Fields, sensors and users: scans, joins, access and defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldlake import constants as K
from fieldlake.functions import labels as LB


def active_fields(fields: DataFrame, owner=None) -> DataFrame:
    """Active fields, of one owner when given."""
    active = fields.filter(F.col("active"))
    return active if owner is None else active.filter(F.col("user_id") == owner)


def active_sensors(sensors: DataFrame, field_id=None) -> DataFrame:
    active = sensors.filter(F.col("status") == "active")
    return active if field_id is None else active.filter(F.col("field_id") == field_id)


def user_by_id(users: DataFrame, user_id) -> DataFrame:
    return users.filter(F.col("user_id") == user_id).limit(1)


def fields_with_sensors(fields: DataFrame, sensors: DataFrame) -> DataFrame:
    """Active fields with their active sensors. No hint: Catalyst broadcasts the
    field side only when its measured size is below the threshold."""
    return active_fields(fields).join(active_sensors(sensors).drop("status"), "field_id")


def with_field_defaults(fields: DataFrame) -> DataFrame:
    return fields.withColumns({
        name: F.coalesce(F.col(name), F.lit(value)) for name, value in K.FIELD_DEFAULTS.items()
    })


def expected_sensors(fields: DataFrame) -> DataFrame:
    """The sensor set a field gets: five soil sensors and one atmospheric one."""
    numbers = F.sequence(F.lit(1), F.lit(K.SOIL_SENSORS_PER_FIELD))
    kinds = F.array_append(
        F.transform(numbers, lambda i: F.struct(F.lit("soil").alias("sensor_type"), i.alias("number"))),
        F.struct(F.lit("atmospheric").alias("sensor_type"), F.lit(1).alias("number")),
    )
    prefix = F.when(F.col("s.sensor_type") == "soil", "SOIL").otherwise("ATM")
    return fields.select("field_id", F.explode(kinds).alias("s")).select(
        F.format_string("%s_%s_%03d", prefix, F.col("field_id").cast("string"), F.col("s.number")).alias("sensor_id"),
        "field_id", F.col("s.sensor_type").alias("sensor_type"),
    )


def placed_sensors(fields: DataFrame, seed: int = K.SPLIT_SEED, box: float = K.SENSOR_BOX_DEGREES) -> DataFrame:
    """The sensor set of new fields with places: soil sensors anywhere in the field's box, the
    atmospheric one at its centre. The draws depend on sensor and seed alone."""
    def draw(name: str):
        return (LB.hash_uniform(F.col("sensor_id"), F.lit(seed), F.lit(name)) * 2 - 1) * box

    soil = F.col("sensor_type") == "soil"
    places = fields.select("field_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    return expected_sensors(fields).join(places, "field_id").select(
        "sensor_id", "field_id", "sensor_type", F.lit("active").alias("status"),
        (F.col("_lat") + F.when(soil, draw("lat")).otherwise(0.0)).alias("lat"), (F.col("_lon") + F.when(soil, draw("lon")).otherwise(0.0)).alias("lon"))


def sensors_in_field_box(sensors: DataFrame, fields: DataFrame, box: float = K.SENSOR_BOX_DEGREES) -> DataFrame:
    """Each placed sensor with whether it lies in its field's box (equi join, then a test)."""
    places = fields.select("field_id", F.col("lat").alias("field_lat"), F.col("lon").alias("field_lon"))
    near = (F.abs(F.col("lat") - F.col("field_lat")) <= box) & (F.abs(F.col("lon") - F.col("field_lon")) <= box)
    return sensors.join(places, "field_id").withColumn("in_field", near)


def role_permissions(spark: SparkSession) -> DataFrame:
    """Role table: three fixed rows, so safe to broadcast."""
    return spark.createDataFrame(list(K.ROLE_PERMISSIONS.items()), "role string, permissions array<string>")


def with_permissions(users: DataFrame) -> DataFrame:
    return users.join(F.broadcast(role_permissions(users.sparkSession)), "role")


def has_permission(permissions: Column, wanted: str) -> Column:
    return F.coalesce(F.array_contains(permissions, wanted), F.lit(False))


def permission_check(requests: DataFrame, users: DataFrame, wanted: str) -> DataFrame:
    """One answer per request; an unknown user is refused."""
    return requests.join(users.select("user_id", "permissions"), "user_id", "left").withColumn(
        "allowed", has_permission(F.col("permissions"), wanted)
    ).drop("permissions")


def authorised_requests(requests: DataFrame, users: DataFrame, wanted: str) -> DataFrame:
    """Only the requests whose requester holds the permission."""
    holders = users.filter(has_permission(F.col("permissions"), wanted)).select("user_id")
    return requests.join(holders, "user_id", "left_semi")


def own_rows(rows: DataFrame, fields: DataFrame, users: DataFrame) -> DataFrame:
    """Rows of own fields, per user with ``view_own_data``. A field has one owner,
    so the result is never larger than the table."""
    own = users.filter(has_permission(F.col("permissions"), "view_own_data")).select("user_id")
    owned = fields.select("field_id", "user_id").join(own, "user_id")
    return rows.join(owned, "field_id")


def rows_for_user(rows: DataFrame, fields: DataFrame, users: DataFrame, user_id) -> DataFrame:
    """All rows for a holder of ``view_all_data``, rows of own fields for a holder of
    ``view_own_data``, none for anybody else. A semi join: a field that is listed twice
    does not double its rows."""
    user = users.filter(F.col("user_id") == user_id)
    sees_all = user.filter(has_permission(F.col("permissions"), "view_all_data"))
    sees_own = user.filter(has_permission(F.col("permissions"), "view_own_data"))
    visible = fields.select("field_id", "user_id").join(sees_own.select("user_id"), "user_id", "left_semi").select("field_id")
    everything = sees_all.agg(F.count(F.lit(1)) > 0).scalar()
    return rows.filter(everything).unionByName(rows.filter(~everything).join(visible, "field_id", "left_semi").select(*rows.columns))
