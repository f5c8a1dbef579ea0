"""Declared schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()
TS, DT = T.TimestampType(), T.DateType()

LOCATION = _struct(lat=D, lon=D)

# Soil sensors fill the first seven; atmospheric ones temperature and the last seven.
READINGS = _struct(
    moisture=D, temperature=D, ph=D, electrical_conductivity=D, nitrogen=D, phosphorus=D, potassium=D,
    humidity=D, light_intensity=D, wind_speed=D, wind_direction=D, rainfall=D,
    atmospheric_pressure=D, cloud_coverage=D,
)

WEATHER = _struct(
    timestamp=S, temperature=D, humidity=D, pressure=D, wind_speed=D, wind_direction=I, rainfall=D,
    clouds=I, climate_zone=S, is_raining=B, season=S, source=S,
)

SENSOR_DATA = _struct(
    sensor_id=S, field_id=S, sensor_type=S, timestamp=TS, location=LOCATION, readings=READINGS,
    weather_context=WEATHER,
)

# Training history: nested readings with the disease of their field and day.
TRAINING_DATA = T.StructType([T.StructField("event_id", L), *SENSOR_DATA.fields, T.StructField("label", S)])

# Live weather answer; every optional part may be missing.
WEATHER_PAYLOAD = T.StructType([
    T.StructField("main", _struct(temp=D, humidity=D, pressure=D)),
    T.StructField("wind", _struct(speed=D, deg=I)),
    T.StructField("clouds", _struct(all=I)),
    T.StructField("rain", T.StructType([T.StructField("1h", D)])),
])

CONDITIONS = _struct(temperature=D, humidity=D, rainfall=D, soil_moisture=D)

DISEASE_RECORDS = _struct(
    field_id=S, disease=S, severity=D, status=S, detection_date=TS, environmental_conditions=CONDITIONS,
    season=S, climate_zone=S,
)

REGISTERED_FIELDS = _struct(
    field_id=L, user_id=L, name=S, lat=D, lon=D, area_hectares=D, crop_type=S, soil_type=S, active=B, created_at=TS,
)
REGISTERED_SENSORS = _struct(sensor_id=S, field_id=L, sensor_type=S, status=S, lat=D, lon=D, created_at=TS)

USERS = _struct(user_id=L, name=S, role=S, version=L, created_at=TS, permissions=T.ArrayType(S))

FIRST_DETECTIONS = _struct(field_id=L, disease=S, started=TS, source=S)

# One row per image file; a creation stamp is the only thing that Spark's file scans don't give.
IMAGE_METADATA = _struct(
    filename=S, filepath=S, absolute_path=S, file_size_bytes=L, file_size_kb=D, width=I, height=I, channels=I,
    mode=S, format=S, class_label=S, split=S, plant_type=S, disease_name=S, health_status=S, modified_at=TS,
    pixel_mean=D, pixel_std=D, pixel_min=I, pixel_max=I, red_mean=D, red_std=D, green_mean=D, green_std=D,
    blue_mean=D, blue_std=D,
)

# Relational tables: lengths are checked by dq_length, decimals are exact.
RELATIONAL = {
    "fields": _struct(
        field_id=S, name=S, location_lat=T.DecimalType(10, 7), location_lon=T.DecimalType(10, 7),
        area_hectares=T.DecimalType(10, 2), soil_type=S, created_at=TS,
    ),
    "sensors": _struct(
        sensor_id=S, field_id=S, sensor_type=S, status=S, last_maintenance=DT, created_at=TS,
    ),
    "batch_jobs": _struct(
        job_id=S, job_name=S, start_time=TS, end_time=TS, status=S, records_processed=L,
        error_message=S, created_at=TS,
    ),
    "analytics_summary": _struct(
        analysis_date=DT, field_id=S, total_readings=L, avg_temperature=T.DecimalType(5, 2),
        avg_moisture=T.DecimalType(5, 2), disease_count=L, created_at=TS,
    ),
}

# Longest value per text column (VARCHAR(n) of the relational tables).
TEXT_LENGTHS = {
    "fields": {"field_id": 50, "name": 100, "soil_type": 50},
    "sensors": {"sensor_id": 50, "field_id": 50, "sensor_type": 20, "status": 20},
    "batch_jobs": {"job_name": 100, "status": 20},
    "analytics_summary": {"field_id": 50},
}

# Primary keys, and columns that must be set, of the relational tables.
PRIMARY_KEYS = {
    "fields": ("field_id",), "sensors": ("sensor_id",), "batch_jobs": ("job_id",),
    "analytics_summary": ("analysis_date", "field_id"),
}
REQUIRED = {
    "fields": ("name",), "sensors": ("sensor_type",), "batch_jobs": ("job_name", "start_time"),
    "analytics_summary": ("analysis_date",),
}

# One image: the layout of Spark's image source (pixel bytes interleaved, BGR).
IMAGE = _struct(origin=S, height=I, width=I, nChannels=I, mode=I, data=T.BinaryType())
