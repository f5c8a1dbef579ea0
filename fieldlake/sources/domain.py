"""The farm-sensing views over a data folder's general tables.

Each view selects only the columns it maps, so scans stay narrow; every view
grows with the table behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldlake import constants as K
from fieldlake.session import tasks_for
from fieldlake.sources.tables import table


def readings_from_events(events: DataFrame) -> DataFrame:
    """Sensor readings; also works on a stream of events."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    ts = F.col("ts").cast("timestamp")
    eid = F.col("event_id")
    return events.select(
        "event_id",
        F.col("user_id").alias("sensor_id"),
        F.floor(F.col("user_id") / 6.0).cast("long").alias("field_id"),
        F.when(F.col("user_id") % 6 == 5, "atmospheric").otherwise("soil").alias("sensor_type"),
        ts.alias("timestamp"),
        F.date_trunc("hour", ts).alias("slot"),
        k.cast("double").alias("moisture"),
        (10 + eid % 25).cast("double").alias("temperature"),
        (30 + k % 71).cast("double").alias("humidity"),
        F.when(eid % 3 == 0, F.col("value") / 10).otherwise(0.0).alias("rainfall"),
        (30 + eid % 41).cast("double").alias("nitrogen"),
        (5.0 + (eid % 35) / 10.0).alias("ph"),
        (eid % 800 - 400).cast("int").alias("wind_direction"),
        (eid % 101).cast("int").alias("clouds"),
    )


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return readings_from_events(table(spark, folder, "events"))


def repeated_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings as left by overlapping runs: every tenth one twice."""
    rows = readings(spark, folder)
    return rows.unionByName(rows.filter(F.col("event_id") % 10 == 0))


def weather(spark: SparkSession, folder: str) -> DataFrame:
    return readings(spark, folder).groupBy("field_id", "slot").agg(
        F.max("temperature").alias("temperature"), F.max("humidity").alias("humidity"),
        F.max("rainfall").alias("rainfall"),
    )


def fields(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    crop = F.when(key % 4 == 0, "tomato").when(key % 4 == 1, "pepper").when(key % 4 == 2, "potato").otherwise("mixed")
    return table(spark, folder, "customer").select(
        key.alias("field_id"), F.col("c_nationkey").alias("user_id"), F.col("c_name").alias("name"),
        ((key * 37) % 181 - 90).cast("double").alias("lat"), ((key * 53) % 361 - 180).cast("double").alias("lon"),
        F.col("c_acctbal").alias("area_hectares"), crop.alias("crop_type"), F.col("c_mktsegment").alias("soil_type"),
        (key % 10 != 9).alias("active"),
    )


def sensors(spark: SparkSession, folder: str) -> DataFrame:
    """Sensors seen in the readings, reduced on the map side."""
    user = F.col("user_id")
    return table(spark, folder, "events").select("user_id").distinct().select(
        user.alias("sensor_id"),
        F.floor(user / 6.0).cast("long").alias("field_id"),
        F.when(user % 6 == 5, "atmospheric").otherwise("soil").alias("sensor_type"),
        F.when(user % 7 == 3, "inactive").otherwise("active").alias("status"),
    )


def field_days(spark: SparkSession, folder: str) -> DataFrame:
    """A date and a place per order: dates over whole years, for season work."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("day_id"), F.col("o_custkey").alias("field_id"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"), F.col("o_totalprice").alias("price"),
    )
    return orders.join(fields(spark, folder).select("field_id", "lat", "lon"), "field_id")


def users(spark: SparkSession, folder: str) -> DataFrame:
    region = F.col("n_regionkey")
    role = F.when(region % 3 == 0, "ADMIN").when(region % 3 == 1, "FARMER").otherwise("RESEARCHER")
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("user_id"), F.col("n_name").alias("name"), role.alias("role")
    )


#: File endings by the tens of an id, so that every split has files of each: most are images, one in the wrong case, one no image.
SUFFIXES = (".jpg", ".png", ".jpg", ".png", ".jpg", ".JPG", ".png", ".txt")


def images(spark: SparkSession, folder: str) -> DataFrame:
    """Image files, one per document: class, size and path."""
    doc = F.col("doc_id")
    label = F.element_at(F.array(*[F.lit(c) for c in K.EXPECTED_CLASSES]), (doc % 15 + 1).cast("int"))
    ext = F.element_at(F.array(*[F.lit(e) for e in SUFFIXES]), (F.floor(doc / 10) % 8 + 1).cast("int"))
    filename = F.concat(doc.cast("string"), ext)
    return table(spark, folder, "documents").select(
        doc.alias("image_id"), label.alias("class_label"), F.col("n_chars").alias("file_size_bytes"),
        F.concat_ws("/", "source", label, filename).alias("path"), filename.alias("filename"),
        (200 + doc % 57).cast("int").alias("width"), (200 + doc % 31).cast("int").alias("height"),
    )


def processed_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files under a split/class/file tree; one tenth lies in no known split."""
    split = F.element_at(
        F.array(*[F.lit(s) for s in ["train"] * 7 + ["val", "test", "extra"]]), (F.col("image_id") % 10 + 1).cast("int"))
    return images(spark, folder).select(
        "image_id", "file_size_bytes", F.concat_ws("/", split, "class_label", "filename").alias("path"),
        "width", "height",
    )


def pixel_images(spark: SparkSession, folder: str, shape: str = "gray") -> DataFrame:
    """Embeddings as small images in the image-source layout.

    ``gray``: one channel; ``colour``: BGR pixels. Every value of a vector is a byte; the
    picture is about square, and its last pixels are filled up with zeros. Every 13th
    image counts as undecodable when ``shape`` is ``mixed``.
    """
    byte = lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(F.abs(x) * 512))).cast("int")
    channels, size = 3 if shape == "colour" else 1, F.size("embedding")
    pixels = F.ceil(size / channels)
    height = F.greatest(F.lit(1), F.floor(F.sqrt(pixels)))
    width = F.ceil(pixels / height)
    rest = F.repeat(F.lit("00"), (height * width * channels - size).cast("int"))
    data = F.unhex(F.concat(F.array_join(F.transform("embedding", lambda x: F.lpad(F.hex(byte(x)), 2, "0")), ""), rest))
    bad = (F.col("vec_id") % 13 == 0) if shape == "mixed" else F.lit(False)
    image = F.struct(
        F.concat(F.lit("image-"), F.col("vec_id").cast("string")).alias("origin"),
        F.when(bad, -1).otherwise(height).cast("int").alias("height"),
        F.when(bad, -1).otherwise(width).cast("int").alias("width"),
        F.when(bad, -1).otherwise(channels).alias("nChannels"),
        F.lit(0 if channels == 1 else 16).alias("mode"),
        F.when(~bad, data).alias("data"),
    )
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("image_id"), F.col("label").cast("string").alias("class_label"), image.alias("image")
    )


def processed_pixels(spark: SparkSession, folder: str, shape: str = "colour") -> DataFrame:
    """Pixel images as files of a split/class/file tree; one tenth lies in no known split."""
    key = F.col("image_id")
    split = F.element_at(F.array(*[F.lit(s) for s in ["train"] * 7 + ["val", "test", "extra"]]), (key % 10 + 1).cast("int"))
    label = F.element_at(F.array(*[F.lit(c) for c in K.EXPECTED_CLASSES]), (key % 15 + 1).cast("int"))
    ext = F.element_at(F.array(*[F.lit(e) for e in SUFFIXES]), (F.floor(key / 10) % 8 + 1).cast("int"))
    return pixel_images(spark, folder, shape).select(
        "image_id", F.concat_ws("/", split, label, F.concat(key.cast("string"), ext)).alias("path"),
        F.length("image.data").cast("long").alias("file_size_bytes"), F.timestamp_seconds(F.lit(1_700_000_000) + key).alias("modified_at"), "image")


def weather_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Live weather answers as JSON text; a third lack rain, a fifth the wind direction."""
    eid = F.col("event_id")
    payload = F.to_json(F.struct(
        F.struct(F.col("temperature").alias("temp"), "humidity", (1000.0 + eid % 30).alias("pressure")).alias("main"),
        F.struct((eid % 12).cast("double").alias("speed"),
                 F.when(eid % 5 != 0, (eid % 360).cast("int")).alias("deg")).alias("wind"),
        F.struct(F.col("clouds").alias("all")).alias("clouds"),
        F.when(eid % 3 != 1, F.struct(F.col("rainfall").alias("1h"))).alias("rain"),
    ))
    return readings(spark, folder).select("event_id", "field_id", "timestamp", payload.alias("payload"))


def relational_sizes(spark: SparkSession, folder: str) -> dict[str, int]:
    """At most how many rows the relational tables have, from the footers of the files behind them."""
    behind = {"fields": "customer", "sensors": "events", "batch_jobs": "orders", "analytics_summary": "lineitem"}
    return {name: table(spark, folder, source).count() for name, source in behind.items()}


def relational_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four relational tables, from customers, events, orders and line items.

    Few line items share a day and a supplier: they are dealt to tasks before they are
    summed up, so that no scanning task holds a group for nearly each of its rows.
    """
    own, seen = fields(spark, folder), sensors(spark, folder)
    orders = table(spark, folder, "orders").withColumn("start_time", F.col("o_orderdate").cast("timestamp"))
    items = table(spark, folder, "lineitem")
    daily = items.withColumns({"analysis_date": F.col("l_shipdate").cast("date"), "field_id": F.col("l_suppkey").cast("string")})
    lines = daily.repartition(tasks_for(items.count()), "analysis_date", "field_id").groupBy("analysis_date", "field_id")
    whole = lambda total: F.floor(F.sum(total) / F.count(F.lit(1))).cast("decimal(5,2)")
    return {
        "fields": own.select(
            F.col("field_id").cast("string"), "name", F.col("lat").cast("decimal(10,7)").alias("location_lat"),
            F.col("lon").cast("decimal(10,7)").alias("location_lon"), F.col("area_hectares").cast("decimal(10,2)"), "soil_type",
            F.timestamp_seconds(F.col("field_id") * 60).alias("created_at")),
        "sensors": seen.select(
            F.col("sensor_id").cast("string"), F.col("field_id").cast("string"), "sensor_type", "status",
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("sensor_id") % 28).cast("int")).alias("last_maintenance"),
            F.timestamp_seconds(F.col("sensor_id") * 60).alias("created_at")),
        "batch_jobs": orders.select(
            F.col("o_orderkey").cast("string").alias("job_id"), F.concat(F.lit("job-"), F.col("o_orderpriority")).alias("job_name"), "start_time",
            (F.col("start_time") + F.expr("INTERVAL 1 HOUR")).alias("end_time"),
            F.when(F.col("o_orderstatus") == "F", "failed").otherwise("completed").alias("status"), F.col("o_orderkey").cast("long").alias("records_processed"),
            F.when(F.col("o_orderstatus") == "F", "stopped").alias("error_message"), F.col("start_time").alias("created_at")),
        "analytics_summary": lines.agg(
            F.count(F.lit(1)).alias("total_readings"), whole("l_quantity").alias("avg_temperature"), whole(F.round(F.col("l_discount") * 100) * 10).alias("avg_moisture"),
            F.count_if(F.col("l_returnflag") == "R").alias("disease_count")).withColumn("created_at", F.col("analysis_date").cast("timestamp")),
    }
