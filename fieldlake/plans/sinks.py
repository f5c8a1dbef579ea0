"""Sinks: write under the shared work folder, read back."""

from pyspark.sql import functions as F, types as T

from fieldlake.operators import dataset as DS, disease as D, images as IM
from fieldlake.plans.registry import query
from fieldlake.plans.scans import METADATA, image_metadata, processed_metadata
from fieldlake.plans.views import hex_sql, resized_sql, rotated_sql, uniform_sql, with_views
from fieldlake.schemas import IMAGE_METADATA, REGISTERED_FIELDS, REGISTERED_SENSORS, USERS
from fieldlake.session import work_path
from fieldlake.sinks import dataset as SD, stores as ST, tables as TS
from fieldlake.sinks.folders import KeyedTable
from fieldlake.sources import domain as V, files as FS, streams as SR
from fieldlake.streaming import jobs as J

def event_day():
    return F.to_date("timestamp")

TYPE_SQL = """CASE WHEN event_id % 10 < 6 THEN 'realtime' WHEN event_id % 10 < 8 THEN 'historical'
    WHEN event_id % 10 = 8 THEN 'ml_training' ELSE 'other' END"""


def typed_readings(spark, sf):
    place = F.col("event_id") % 10
    kind = (F.when(place < 6, "realtime").when(place < 8, "historical").when(place == 8, "ml_training")
            .otherwise("other"))
    return V.readings(spark, sf).withColumn("data_type", kind)


@query("route_hot_cold", with_views("readings", f"""
    SELECT event_id, 'hot' AS store, {TYPE_SQL} AS data_type FROM readings WHERE event_id % 10 < 6
    UNION ALL SELECT event_id, 'cold', 'realtime_archive' FROM readings WHERE event_id % 10 < 6
    UNION ALL SELECT event_id, 'cold', {TYPE_SQL} FROM readings WHERE event_id % 10 BETWEEN 6 AND 8"""))
def route_hot_cold(spark, sf):
    base = work_path(spark, "route")
    ST.route(typed_readings(spark, sf), f"{base}/hot", f"{base}/cold", f"{base}/log", event_day())
    columns = ["event_id", "store", "data_type"]
    hot = spark.read.parquet(f"{base}/hot").withColumn("store", F.lit("hot")).select(columns)
    return hot.unionByName(spark.read.parquet(f"{base}/cold").withColumn("store", F.lit("cold")).select(columns))


@query("sink_hot_append", with_views("readings", "SELECT * FROM readings"))
def sink_hot_append(spark, sf):
    path = work_path(spark, "hot")
    ST.append_hot(V.readings(spark, sf), path)
    return spark.read.parquet(path)


@query("sink_cold_partitioned", with_views("readings", f"""
    SELECT event_id, sensor_id, moisture, {TYPE_SQL} AS data_type,
    CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS ingest_date FROM readings"""))
def sink_cold_partitioned(spark, sf):
    path = work_path(spark, "cold")
    ST.append_cold(typed_readings(spark, sf), path, event_day())
    return spark.read.parquet(path).select(
        "event_id", "sensor_id", "moisture", "data_type", F.col("ingest_date").cast("string"))


@query("sink_archive_threshold", with_views("readings", "SELECT * FROM readings"))
def sink_archive_threshold(spark, sf):
    archive = J.threshold_archive(SR.readings_stream(spark, sf), work_path(spark, "archive"))
    return spark.read.parquet(archive).drop("flush_id", "data_type", "ingest_date", "commit")


@query("sink_fallback", with_views("readings", f"""
    SELECT event_id, moisture, {TYPE_SQL} AS data_type, event_id % 2 = 0 AS was_kept FROM readings"""))
def sink_fallback(spark, sf):
    """Half of the rows meet a store that fails; they wait aside and are replayed into the store that works."""
    base, rows = work_path(spark, "fallback"), typed_readings(spark, sf).withColumn("ingest_date", event_day())
    even = F.col("event_id") % 2 == 0
    rows = rows.withColumn("was_kept", even)
    broken, store = (ST.cold_store(spark, path, rows.schema) for path in ("nostore://nowhere/cold", f"{base}/cold"))
    side = ST.SideStore(spark, f"{base}/side", store.schema)
    ST.append_or_keep(rows.filter(even), broken, side, ("job", 0))
    ST.append_or_keep(rows.filter(~even), store, side, ("job", 1))
    return store.read().select("event_id", "moisture", "data_type", "was_kept")


@query("sink_generation_log", with_views("readings", f"""
    SELECT {TYPE_SQL} AS type, count(*) AS record_count, 'stored' AS status FROM readings
    WHERE event_id % 10 BETWEEN 6 AND 8 GROUP BY 1"""))
def sink_generation_log(spark, sf):
    base = work_path(spark, "generation")
    rows = typed_readings(spark, sf)
    cold = rows.filter(F.col("data_type").isin(ST.COLD_TYPES))
    ST.append_logged(cold, ST.COLD_TYPES, f"{base}/cold", f"{base}/log", event_day())
    return spark.read.parquet(f"{base}/log").select("type", "record_count", "status")


@query("sink_disease_records", with_views("records", "SELECT * FROM records"))
def sink_disease_records(spark, sf):
    path = work_path(spark, "disease-records")
    D.disease_records(V.readings(spark, sf), V.fields(spark, sf)).write.mode("append").parquet(path)
    return spark.read.parquet(path).select("*", "environmental_conditions.*").drop("environmental_conditions")


@query("upsert_users", """
    WITH old AS (SELECT c_custkey AS user_id, c_name AS name, 'FARMER' AS role, 0 AS version,
      TIMESTAMP '2020-01-01 00:00:00' AS created_at FROM customer),
    new AS (SELECT o_custkey AS user_id, 'renamed-' || o_orderkey AS name,
      CASE o_orderkey % 3 WHEN 0 THEN 'ADMIN' WHEN 1 THEN 'FARMER' ELSE 'RESEARCHER' END AS role,
      o_orderkey + 1 AS version, CAST(o_orderdate AS TIMESTAMP) AS created_at FROM orders),
    latest AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY version DESC) AS n
      FROM (SELECT * FROM old UNION ALL SELECT * FROM new))
    SELECT user_id, name, role, version, created_at, CASE role WHEN 'ADMIN' THEN 5 ELSE 3 END AS n_permissions
    FROM latest WHERE n = 1""")
def upsert_users(spark, sf):
    """A stored table of users takes two batches of changes, the second of them twice."""
    key = F.col("o_orderkey")
    role = F.when(key % 3 == 0, "ADMIN").when(key % 3 == 1, "FARMER").otherwise("RESEARCHER")
    old = V.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.lit("FARMER").alias("role"),
        F.lit(0).cast("long").alias("version"), F.lit("2020-01-01").cast("timestamp").alias("created_at"))
    new = V.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"), F.concat(F.lit("renamed-"), key.cast("string")).alias("name"),
        role.alias("role"), (key + 1).alias("version"), F.col("o_orderdate").cast("timestamp").alias("created_at"))
    users = KeyedTable(spark, work_path(spark, "users"), USERS, ["user_id"], parts=16)
    users.add(TS.checked_users(old))
    for n in (0, 1, 1):
        TS.upsert_users(users, new.filter(key % 2 == n), "version", ("changes", n))
    return users.rows().select("user_id", "name", "role", "version", "created_at", F.size("permissions").alias("n_permissions"))


@query("register_fields", f"""
    WITH new AS (SELECT c_custkey AS field_id, CAST((c_custkey * 37) % 181 - 90 AS DOUBLE) AS lat, CAST((c_custkey * 53) % 361 - 180 AS DOUBLE) AS lon,
      CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE 1.0 END AS area_hectares, 'mixed' AS crop_type FROM customer),
    kinds AS (SELECT 'SOIL' AS prefix, 'soil' AS sensor_type, unnest([1, 2, 3, 4, 5]) AS n UNION ALL SELECT 'ATM', 'atmospheric', 1),
    placed AS (SELECT prefix || '_' || field_id || '_' || printf('%03d', n) AS sensor_id, * FROM new, kinds)
    SELECT sensor_id, field_id, sensor_type, area_hectares, crop_type,
    round(lat + CASE WHEN sensor_type = 'soil' THEN ({uniform_sql("sensor_id", "'42'", "'lat'")} * 2 - 1) * 0.01 ELSE 0 END, 9) AS lat,
    round(lon + CASE WHEN sensor_type = 'soil' THEN ({uniform_sql("sensor_id", "'42'", "'lon'")} * 2 - 1) * 0.01 ELSE 0 END, 9) AS lon FROM placed""")
def register_fields(spark, sf):
    """Fields are registered in two overlapping batches; each gets its sensors once."""
    from fieldlake.plans.pipelines import register_fields as register

    out, key = work_path(spark, "registry"), F.col("field_id")
    new = V.fields(spark, sf).select(
        "field_id", "user_id", "name", "lat", "lon", F.when(key % 3 == 0, F.col("area_hectares")).alias("area_hectares"))
    register(new.filter(key % 2 == 0), out)
    register(new, out)
    fields = KeyedTable(spark, f"{out}/fields", REGISTERED_FIELDS, ["field_id"], 16).rows()
    sensors = KeyedTable(spark, f"{out}/sensors", REGISTERED_SENSORS, ["sensor_id"], 16).rows()
    return sensors.join(fields.select("field_id", "area_hectares", "crop_type"), "field_id").select(
        "sensor_id", "field_id", "sensor_type", "area_hectares", "crop_type", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


ABSENT = """SELECT c_custkey AS field_id, c_name AS name FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"""


def _incoming_fields(spark, sf):
    """Each customer sent twice; those with an urgent order are stored already."""
    new = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("field_id"), F.col("c_name").alias("name"))
    both = new.withColumn("version", F.lit(1)).unionByName(
        new.select("field_id", F.lit("second").alias("name"), F.lit(2).alias("version")))
    urgent = V.table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return both, urgent.select(F.col("o_custkey").alias("field_id"))


@query("insert_if_absent", f"""{ABSENT}
    UNION ALL SELECT DISTINCT o_custkey, 'stored' FROM orders WHERE o_orderpriority = '1-URGENT'""")
def insert_if_absent(spark, sf):
    new, stored = _incoming_fields(spark, sf)
    path = work_path(spark, "fields")
    stored.distinct().withColumn("name", F.lit("stored")).write.parquet(path)
    fresh = TS.absent_rows(new, spark.read.parquet(path), "field_id", "version").drop("version")
    fresh.select("field_id", "name").write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("anti_insert", ABSENT)
def anti_insert(spark, sf):
    new, stored = _incoming_fields(spark, sf)
    return TS.absent_rows(new, stored, "field_id", "version").select("field_id", "name")


@query("sink_metadata_csv", with_views("metadata", METADATA))
def sink_metadata_csv(spark, sf):
    path = work_path(spark, "metadata")
    SD.write_metadata_csv(image_metadata(spark, sf), path)
    return FS.metadata_csv(spark, path)


@query("sink_metadata_json", with_views("metadata", """
    SELECT m.*, t.name, t.num_classes, t.total_images
    FROM metadata m JOIN (SELECT 'leaf-images' AS name, count(DISTINCT class_label) AS num_classes,
    count(*) AS total_images FROM metadata) t ON TRUE"""))
def sink_metadata_json(spark, sf):
    path = work_path(spark, "metadata")
    SD.write_metadata_json(image_metadata(spark, sf), path, "leaf-images", "disease_classification")
    info = spark.read.schema("name string, task string, num_classes long, total_images long").json(
        f"{path}/dataset_info")
    totals = {c: info.select(c).scalar() for c in ("name", "num_classes", "total_images")}
    return spark.read.schema(IMAGE_METADATA).json(f"{path}/images").withColumns(totals)


@query("sink_class_distribution", with_views("processed", """
    SELECT class_label, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'val') AS val,
    count(*) FILTER (WHERE split = 'test') AS test, count(*) AS total,
    (SELECT count(DISTINCT class_label) FROM processed) AS total_classes,
    (SELECT count(*) FROM processed) AS total_images FROM processed GROUP BY class_label"""))
def sink_class_distribution(spark, sf):
    path = work_path(spark, "distribution")
    SD.write_class_distribution(processed_metadata(spark, sf), path, "leaf-images")
    totals = spark.read.schema("total_classes long, total_images long").json(f"{path}/totals")
    return spark.read.parquet(f"{path}/distribution").withColumns(
        {c: totals.select(c).scalar() for c in ("total_classes", "total_images")})


SUMMARY = """SELECT 'leaf-images' AS dataset_name, count(*) AS total_images,
    count(DISTINCT class_label) AS num_classes, count(*) FILTER (WHERE split = 'train') AS train,
    count(*) FILTER (WHERE split = 'val') AS val, count(*) FILTER (WHERE split = 'test') AS test,
    CAST(trunc(avg(width)) AS INTEGER) AS avg_width, CAST(trunc(avg(height)) AS INTEGER) AS avg_height,
    CAST(sum(CAST(file_size_kb AS DECIMAL(20,2))) AS DOUBLE) / count(*) AS avg_file_size_kb,
    CAST(sum(CAST(file_size_kb AS DECIMAL(20,2))) AS DOUBLE) / 1024 AS total_size_mb,
    count(*) FILTER (WHERE health_status = 'healthy') AS healthy,
    count(*) FILTER (WHERE health_status = 'diseased') AS diseased FROM labelled"""


@query("sink_dataset_summary", with_views("metadata", SUMMARY.replace("FROM labelled", "FROM metadata").replace("AS diseased", """AS diseased,
    CAST(sum(CAST(pixel_mean AS DECIMAL(20,8))) AS DOUBLE) / count(*) AS overall_mean,
    CAST(sum(CAST(pixel_std AS DECIMAL(20,8))) AS DOUBLE) / count(*) AS overall_std,
    (SELECT string_agg(DISTINCT class_label, ',' ORDER BY class_label) FROM metadata) AS classes,
    (SELECT string_agg(plant_type || '=' || n, ',' ORDER BY plant_type)
      FROM (SELECT plant_type, count(*) AS n FROM metadata GROUP BY 1)) AS plant_types""")))
def sink_dataset_summary(spark, sf):
    path, images = work_path(spark, "summary"), image_metadata(spark, sf)
    SD.write_dataset_summary(images, path, "leaf-images")
    schema = DS.dataset_summary(images, "leaf-images").schema.add("classes", T.ArrayType(T.StringType())).add(
        "plant_types", T.MapType(T.StringType(), T.LongType()))
    plants = F.array_sort(F.map_entries("plant_types"))
    return spark.read.schema(schema).json(f"{path}/summary").select(
        "dataset_name", "overview.total_images", "overview.num_classes", "overview.splits.*",
        "image_properties.*", "health_status_distribution.*", "pixel_statistics.*", F.array_join("classes", ",").alias("classes"),
        F.array_join(F.transform(plants, lambda p: F.concat(p["key"], F.lit("="), p["value"].cast("string"))), ",").alias("plant_types"))


@query("sink_manifest", with_views("split", "SELECT split, class_label, path FROM split"))
def sink_manifest(spark, sf):
    path = work_path(spark, "manifest")
    SD.write_manifest(DS.stratified_split(V.images(spark, sf).select("image_id", "class_label", "path")), path)
    return spark.read.parquet(path)


def prepared_images(spark, sf, size: int = 16):
    """Split, resize, copy and change the pixel images: the whole preparation chain."""
    images = V.pixel_images(spark, sf, "colour")
    sized = IM.resize(DS.stratified_split(images), size, size)
    drawn = DS.augmentation_draws(DS.with_copies(sized), "image_id")
    name = F.concat("image.origin", "suffix", F.lit(".jpg"))
    return IM.apply_augmentation(drawn).withColumn("name", name)


PREPARED = f"""SELECT image_id, split, class_label, copy, suffix, factor, angle,
    CASE WHEN mirror THEN [px[48 * (k // 48) + 45 - k % 48 // 3 * 3 + k % 3 + 1] for k in range(768)] ELSE px END AS px
    FROM (SELECT * EXCLUDE (px), CASE WHEN copy > 0 THEN px ELSE original END AS px FROM (
      {rotated_sql(f"""(SELECT *, px AS original, (draw_angle * 2 - 1) * 15 AS angle, copy > 0 AND draw_mirror > 5e-1 AS mirror,
        8e-1 + draw_factor * CAST({1.2 - 0.8!r} AS DOUBLE) AS factor
        FROM (SELECT *, {', '.join(f'{uniform_sql("image_id", "copy", "42", f"{chr(39)}{d}{chr(39)}")} AS draw_{d}' for d in ("angle", "mirror", "factor"))}
        FROM ({resized_sql("px_fanned", 4, 6, 16, 16)})))""", 16, 16)}))"""
BRIGHT = "[CASE WHEN copy = 0 THEN p ELSE CAST(floor(least(255, CAST(p AS FLOAT) * CAST(factor AS FLOAT))) AS INTEGER) END for p in px]"


@query("sink_processed_images", with_views("px_fanned", f"""
    SELECT split, class_label, 'image-' || image_id || suffix || '.jpg' AS name, 16 AS height, 16 AS width,
    md5(unhex({hex_sql(BRIGHT)})) AS pixels FROM ({PREPARED})"""))
def sink_processed_images(spark, sf):
    path = work_path(spark, "processed")
    SD.write_processed_images(prepared_images(spark, sf), path)
    return spark.read.parquet(path).select(
        "split", F.col("class_label").cast("string"), "name", "image.height", "image.width",
        F.md5("image.data").alias("pixels"))


@query("ingest_image_files", "SELECT count(*) AS n_read, count(*) AS n_stored FROM documents")
def ingest_image_files(spark, sf):
    path = work_path(spark, "ingest")
    read, _ = SD.ingest_files(V.images(spark, sf), path)
    return spark.read.parquet(path).agg(
        F.lit(read).cast("long").alias("n_read"), F.count(F.lit(1)).alias("n_stored"))


@query("job_ledger", """
    SELECT 'summarise' AS job_name, 'completed' AS status, count(*) AS records_processed, TRUE AS ended FROM events""")
def job_ledger(spark, sf):
    base = work_path(spark, "ledger")
    with TS.ledgered(spark, f"{base}/runs", "summarise") as run:
        run.records, _ = SD.ingest_files(V.readings(spark, sf), f"{base}/rows")
    return TS.latest_runs(spark.read.parquet(f"{base}/runs")).select(
        "job_name", "status", "records_processed", (F.col("end_time") >= F.col("start_time")).alias("ended"))


@query("sink_recommendations", with_views("readings", """
    SELECT field_id, avg_nitrogen, 'Nitrogen levels are low (' || CAST(floor(avg_nitrogen) AS BIGINT)
    || ' mg/kg). Recommended: apply urea fertilizer.' AS message
    FROM (SELECT field_id, avg(nitrogen) AS avg_nitrogen FROM readings WHERE sensor_type = 'soil' GROUP BY 1)
    WHERE avg_nitrogen < 50"""))
def sink_recommendations(spark, sf):
    path = work_path(spark, "recommendations")
    D.fertiliser_advice(V.readings(spark, sf), low=50.0).write.mode("append").parquet(path)
    return spark.read.parquet(path)
