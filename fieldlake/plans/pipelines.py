"""The three end-to-end jobs: history, live stream, image preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldlake import constants as K
from fieldlake.functions import weather as W
from fieldlake.operators import dataset as DS, disease as D, fields as FL, images as IM, summary as S
from fieldlake.operators.infections import FirstDetections
from fieldlake.schemas import REGISTERED_FIELDS, REGISTERED_SENSORS
from fieldlake.session import stored
from fieldlake.sinks import dataset as SD, stores as ST, tables as TS
from fieldlake.sinks.folders import KeyedTable
from fieldlake.sources import files as FS
from fieldlake.streaming import jobs as J


#: Weather that readings carry.
WEATHER = ("temperature", "humidity", "rainfall", "wind_direction", "clouds")


def check_allowed(users: DataFrame, user_id, permission: str) -> None:
    request = users.sparkSession.createDataFrame([(user_id,)], users.select("user_id").schema)
    if FL.authorised_requests(request, users, permission).isEmpty():
        raise PermissionError(f"{user_id} lacks {permission}")


def readings_of(readings: DataFrame, fields: DataFrame, owner=None) -> DataFrame:
    """Readings of active fields, of one owner when given."""
    return readings.join(FL.active_fields(fields, owner).select("field_id"), "field_id", "left_semi")


def recent(readings: DataFrame, days: int | None, until=None) -> DataFrame:
    """Readings of the ``days`` up to a time, the newest reading's when left out; all without ``days``."""
    if days is None:
        return readings
    until = until or readings.agg(F.max("timestamp")).scalar()
    end = until if isinstance(until, Column) else F.lit(until).cast("timestamp")
    return readings.filter((F.col("timestamp") > end - F.make_dt_interval(F.lit(days))) & (F.col("timestamp") <= end))


def training_rows(readings: DataFrame, fields: DataFrame, records: DataFrame | None) -> DataFrame:
    """Nested readings with the weather of their field and hour, and the disease of their field and
    day as label; without disease records the label is null."""
    weather = stored(readings.groupBy("field_id", "slot").agg(*[F.max(c).alias(f"w_{c}") for c in WEATHER]), "weather")
    places = weather.join(fields.select("field_id", "lat", "lon"), "field_id", "left").withColumns({
        "w_time": F.date_format("slot", "yyyy-MM-dd'T'HH:mm:ssxxx"), "climate_zone": W.climate_zone(F.col("lat")),
        "season": W.season(F.dayofyear("slot"), F.col("lat")), "is_raining": F.col("w_rainfall") > 0, "source": F.lit("observed")})
    placed = readings.join(places, ["field_id", "slot"])
    labelled = D.labelled_readings(placed, records) if records is not None else placed.withColumn("label", F.lit(None).cast("string"))
    return ST.nested_readings(labelled, {"timestamp": "w_time"} | {c: f"w_{c}" for c in WEATHER}, keep=["label"])


def history(readings: DataFrame, fields: DataFrame, users: DataFrame, requester, out: str, owner=None,
            include_diseases: bool = True, days: int | None = None, until=None) -> None:
    """Training history of the last ``days``: noon disease records with their alerts, the daily
    summary mart, advice, and the readings with weather and label to the cold store with
    a log row, all in one ledger entry.

    Infections go on from the first detections of earlier runs, which are stored. Disease
    records, alerts, summary and advice of the owner's fields are replaced, those of other
    fields stay, so a run may be repeated or made for one owner. Cold readings are an
    archive and are appended per run; when the cold store fails they wait beside it.
    """
    spark = readings.sparkSession
    check_allowed(users, requester, "run_simulation")
    own = recent(readings_of(readings, fields, owner), days, until)
    mine = FL.active_fields(fields, owner).select("field_id")
    with TS.ledgered(spark, f"{out}/batch_jobs", "history") as run:
        records = None
        if include_diseases:
            started = FirstDetections(spark, f"{out}/first_detections")
            found = stored(D.disease_records(own, fields, started.rows()), "records")
            started.merge(found, "detection_date")
            _replace(found, f"{out}/disease_records", mine)
            records = found
            _replace(D.alerts(records, fields), f"{out}/alerts", mine)
            _replace(S.daily_field_summary(own, records), f"{out}/analytics_summary", mine)
        _replace(D.fertiliser_advice(own), f"{out}/recommendations", mine)
        run.records = ST.append_logged(
            training_rows(own, fields, records).withColumn("data_type", F.lit("ml_training")), ["ml_training"], f"{out}/cold",
            f"{out}/data_generation_logs", F.to_date("timestamp"), fallback=f"{out}/fallback")["ml_training"]


def _replace(rows: DataFrame, path: str, fields: DataFrame) -> None:
    """Replace the fields' rows of a small mart. Only its last version stays, so that it can be read as a plain folder."""
    table = TS.replace_rows(rows, path, "field_id", fields, parts=16)
    table.vacuum(keep=1)
    if not table.version().live:  # a file without rows still tells the columns
        table.rows().coalesce(1).write.mode("overwrite").parquet(f"{path}/bucket=0/commit=none")


def register_fields(new: DataFrame, out: str, created_at: Column | None = None) -> int:
    """Take in new fields with their defaults and place their sensors; returns how many were new.

    ``new`` has field_id, user_id, name, lat and lon, and may lack or leave open the rest.
    Fields that are stored already stay as they are, and keep their sensors: fields are
    written last, so a run that stopped half-way is made good by the next one.
    """
    spark = new.sparkSession
    fields = KeyedTable(spark, f"{out}/fields", REGISTERED_FIELDS, ["field_id"], 16)
    sensors = KeyedTable(spark, f"{out}/sensors", REGISTERED_SENSORS, ["sensor_id"], 16)
    for name in K.FIELD_DEFAULTS:
        if name not in new.columns:
            new = new.withColumn(name, F.lit(None).cast(REGISTERED_FIELDS[name].dataType))
    complete = FL.with_field_defaults(new).withColumn("created_at", F.current_timestamp() if created_at is None else created_at)
    fresh = stored(TS.absent_rows(complete.select(*REGISTERED_FIELDS.names), fields.rows(), "field_id", "name"), "new-fields")
    placed = FL.placed_sensors(fresh).join(fresh.select("field_id", "created_at"), "field_id").select(*REGISTERED_SENSORS.names)
    known = sensors.rows().select("sensor_id")
    sensors.add(placed.join(known, "sensor_id", "left_anti"))
    fields.add(fresh)
    return fresh.count()


def live(readings: DataFrame, fields: DataFrame, out: str, owner=None,
         interval: int | None = None, jobs=("store",)) -> tuple[str, str]:
    """Live readings of an owner's active fields: to the hot table and the cold archive (``store``),
    hourly trend (``trend``), rain sessions (``rain``), infections (``infections``).

    Each job has a folder of its own under ``out`` and goes on there when it is started
    again. Over bounded input the results are written at the end; with ``interval`` the
    jobs run until they are stopped.
    """
    spark, rows = readings.sparkSession, readings_of(readings, fields, owner)
    trend, rain = J.trend(spark, f"{out}/trend"), J.rain_sessions(spark, f"{out}/rain")
    ill = J.Infections(spark, f"{out}/infections", fields, FirstDetections(spark, f"{out}/first_detections"))
    starts = {"store": lambda: J.start_hot_and_cold(rows, out, interval), "trend": lambda: trend.start(rows, interval),
              "rain": lambda: rain.start(rows, interval), "infections": lambda: ill.start(rows, interval)}
    for running in [starts[job]() for job in jobs]:
        running.awaitTermination()
    results = {"trend": lambda: J.trend_rows(trend.result()), "rain": lambda: J.session_rows(rain.result()), "infections": lambda: ill.settle().result()}
    for job in results.keys() & set(jobs):
        results[job]().write.mode("overwrite").parquet(f"{out}/{job}/result")
    if "store" in jobs:
        J.replay_cold(spark, out, rows.schema)
    return f"{out}/hot", f"{out}/cold"


def prepare_images(spark: SparkSession, raw: str, out: str, name: str, size=K.TARGET_SIZE,
                   copies: int = K.AUGMENTED_COPIES, skip_corrupted: bool = True) -> None:
    """Raw image tree to a split, resized and augmented pixel table with manifest,
    metadata and summaries.

    The split is worked out on paths alone; pixels are decoded once, labelled
    and changed in their task, and only shuffled to size the output files.
    """
    paths = DS.raw_images(FS.image_files(spark, raw), raw)
    if paths.isEmpty():
        raise ValueError(f"no images under {raw}")
    cuts = DS.split_cuts(paths, key="path")
    SD.write_manifest(DS.with_split(paths, cuts, key="path"), f"{out}/manifest")
    pixels = IM.valid_images(DS.raw_images(FS.decoded_images(spark, raw), raw), skip_corrupted)
    placed = IM.resize(IM.as_rgb(DS.with_split(pixels, cuts, key="path")), *size)
    drawn = DS.augmentation_draws(DS.with_copies(placed, copies), "path")
    named = IM.apply_augmentation(drawn).withColumns({
        "name": DS.output_name(F.col("path"), F.col("suffix")), "image_id": F.col("path")})
    SD.write_processed_images(named, f"{out}/processed")
    manifest = spark.read.parquet(f"{out}/manifest")
    done = spark.read.parquet(f"{out}/processed").select(F.col("image_id").alias("path"), "copy")
    DS.attempt_log(DS.with_copies(manifest, copies).select("path", "copy", "split", "class_label"), done).write.mode("overwrite").parquet(f"{out}/attempts")
    SD.write_manifest_info(manifest, spark.read.parquet(f"{out}/attempts"), f"{out}/manifest_info", name)
    write_metadata(spark, out, name)


def processed_metadata(spark: SparkSession, out: str) -> DataFrame:
    """Metadata of every processed image: file, shape, labels and pixel statistics."""
    table = spark.read.parquet(f"{out}/processed").withColumns({
        "split": F.col("split").cast("string"), "class_label": F.col("class_label").cast("string")})
    files = table.withColumns({
        "path": F.concat_ws("/", F.lit(out), F.lit("processed"), "split", "class_label", "name"),
        "file_size_bytes": F.length("image.data").cast("long"), "modified_at": F.col("_metadata.file_modification_time")})
    stats = IM.metadata(files, names=("red", "green", "blue"))
    return DS.label_columns(DS.file_columns(stats, root=f"{out}/processed/")).drop("image")


def write_metadata(spark: SparkSession, out: str, name: str) -> None:
    """Metadata is computed from the pixels once, stored, and summarised from there."""
    processed_metadata(spark, out).write.mode("overwrite").parquet(f"{out}/metadata/table")
    images = spark.read.parquet(f"{out}/metadata/table")
    SD.write_metadata_csv(images, f"{out}/metadata/csv")
    SD.write_metadata_json(images, f"{out}/metadata/json", name, "disease_classification")
    SD.write_class_distribution(images, f"{out}/metadata/class_distribution", name)
    SD.write_dataset_summary(images, f"{out}/metadata/dataset_summary", name)
    IM.pixel_summary(images).write.mode("overwrite").json(f"{out}/metadata/pixel_summary")
