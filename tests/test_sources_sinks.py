"""File forms, stores, ledger and the end-to-end jobs."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlake.operators import fields as FL, images as IM
from fieldlake.plans import pipelines
from fieldlake.schemas import IMAGE_METADATA
from fieldlake.session import work_path
from fieldlake.sinks import dataset as SD, stores as ST, tables as TS
from fieldlake.sources import domain as V, files as FS, tables as TB


def png(pixels: np.ndarray) -> bytes:
    """A plain RGB PNG file of a height x width x 3 array."""
    height, width, _ = pixels.shape

    def part(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    lines = b"".join(b"\0" + row.tobytes() for row in pixels.astype(np.uint8))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")


def reading(sensor, stamp, **more):
    return {"sensor_id": sensor, "field_id": "F1", "sensor_type": "soil", "timestamp": stamp,
            "location": {"lat": 1.0, "lon": 2.0}, "readings": {"moisture": 40.5, "temperature": 20},
            "weather_context": {"timestamp": "2024-12-25T12:00:00+00:00", "rainfall": 0, "is_raining": False}, **more}


def test_json_archive_forms(spark, tmp_path):
    """Array files, _id present or absent, rainfall as int and float, both time spellings."""
    day = tmp_path / "ml_training" / "20241225"
    day.mkdir(parents=True)
    wet = reading("S3", "2024-12-25 12:00:00.123456+00:00")
    wet["weather_context"]["rainfall"] = 2.5
    (day / "data_1.json").write_text(json.dumps([reading("S1", "2024-12-25 12:00:00+00:00", _id="x"),
                                                 reading("S2", "2024-12-25 15:00:00+00:00")], indent=2))
    (day / "data_2.json").write_text(json.dumps([wet], indent=2))
    df = FS.readings_json(spark, str(tmp_path))
    assert "_id" not in df.columns
    rows = {r["sensor_id"]: r for r in df.collect()}
    assert len(rows) == 3 and {str(r["ingest_date"]) for r in rows.values()} == {"2024-12-25"}
    assert rows["S1"]["weather_context"]["rainfall"] == 0.0 and rows["S3"]["weather_context"]["rainfall"] == 2.5
    assert rows["S3"]["timestamp"].microsecond == 123456 and rows["S1"]["timestamp"].hour == 12
    assert rows["S1"]["readings"]["humidity"] is None


@pytest.fixture
def image_tree(tmp_path):
    rng = np.random.default_rng(3)
    for label in ("Tomato_healthy", "Potato___Early_blight"):
        folder = tmp_path / "raw" / "set" / label
        folder.mkdir(parents=True)
        for i in range(10):
            (folder / f"{i}.png").write_bytes(png(rng.integers(0, 256, (12, 10, 3))))
    (tmp_path / "raw" / "set" / "Tomato_healthy" / "broken.jpg").write_bytes(b"no picture")
    (tmp_path / "raw" / "set" / "Tomato_healthy" / "notes.txt").write_bytes(b"text")
    hidden = tmp_path / "raw" / "set" / ".cache"
    hidden.mkdir()
    (hidden / "1.png").write_bytes(png(np.zeros((2, 2, 3))))
    return tmp_path


def test_decoded_pixels_are_bgr_and_bad_files_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(np.array([[[255, 0, 7]]])))
    (tmp_path / "b.png").write_bytes(b"junk")
    images = FS.decoded_images(spark, str(tmp_path))
    assert tuple(IM.corrupt_count(images).first()) == (2, 1)
    good = IM.valid_images(images)
    assert [bytes(r[0]) for r in good.select("image.data").collect()] == [bytes([7, 0, 255])]
    assert [bytes(r[0]) for r in IM.to_rgb(good).select("rgb").collect()] == [bytes([255, 0, 7])]
    with pytest.raises(Exception, match="cannot decode"):
        IM.valid_images(images, skip_corrupted=False).collect()


def test_image_preparation_end_to_end(spark, image_tree):
    out = str(image_tree / "out")
    pipelines.prepare_images(spark, str(image_tree / "raw"), out, "leaves", size=(8, 8))
    table = spark.read.parquet(f"{out}/processed")
    manifest = spark.read.parquet(f"{out}/manifest")
    assert manifest.count() == 21  # the broken file is split too, and lost when decoding
    splits = {r[0]: r[1] for r in manifest.join(
        table.select(F.col("image_id").alias("path")).distinct(), "path").groupBy("split").count().collect()}
    assert table.count() == sum(splits.values()) + 3 * splits["train"]
    assert {tuple(r) for r in table.select("image.height", "image.width", F.length("image.data")).distinct().collect()} == {
        (8, 8, 192)}
    meta = FS.metadata_csv(spark, f"{out}/metadata/csv")
    assert meta.count() == table.count() and {r[0] for r in meta.select("plant_type").distinct().collect()} == {
        "Tomato", "Potato"}
    summary = json.loads(spark.read.text(f"{out}/metadata/dataset_summary/summary").first()[0])
    assert summary["overview"]["num_classes"] == 2 and summary["image_properties"]["avg_width"] == 8


def test_empty_image_tree_is_refused(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "x.txt").write_text("no image")
    with pytest.raises(ValueError, match="no images"):
        pipelines.prepare_images(spark, str(tmp_path / "raw"), str(tmp_path / "out"), "leaves")


def test_metadata_csv_is_globally_ordered(spark, tmp_path):
    rows = [(f"f{i:03d}", s, c) for i in range(50) for s in ("train", "val") for c in ("A", "B")]
    df = spark.createDataFrame(rows, "filename string, split string, class_label string")
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in IMAGE_METADATA.fields if f.name not in df.columns})
    SD.write_metadata_csv(df.repartition(5), str(tmp_path / "csv"))
    place = [IMAGE_METADATA.names.index(c) for c in ("split", "class_label", "filename")]
    files = sorted((tmp_path / "csv").glob("part-*"))
    lines = [line.split(",") for f in files for line in f.read_text().splitlines()[1:]]
    order = [tuple(r[p] for p in place) for r in lines]
    assert len(order) == 200 and order == sorted(order)


def test_fallback_keeps_the_rows(spark, tmp_path):
    df = spark.range(5)
    good, bad = str(tmp_path / "cold"), "nostore://x/y"
    assert ST.append_with_fallback(df, good, str(tmp_path / "fb")) == good
    assert ST.append_with_fallback(df, bad, str(tmp_path / "fb")) == str(tmp_path / "fb")
    assert spark.read.parquet(str(tmp_path / "fb")).count() == 5


def test_failed_write_is_logged_as_failed_and_nothing_for_no_rows(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.range(3).withColumn("data_type", F.lit("historical"))
    with pytest.raises(Exception):
        ST.append_logged(rows, ["historical"], "nostore://x/y", log, F.current_date())
    counts = ST.append_logged(rows, ["historical", "ml_training"], str(tmp_path / "cold"), log, F.current_date())
    assert counts == {"historical": 3, "ml_training": 0}
    got = spark.read.parquet(log).select("type", "record_count", "status").collect()
    assert sorted(tuple(r) for r in got) == [("historical", 0, "failed"), ("historical", 3, "stored")]


def test_ledger_states(spark, tmp_path):
    path = str(tmp_path / "runs")
    with TS.ledgered(spark, path, "good") as run:
        run.records = 7
    with pytest.raises(ZeroDivisionError):
        with TS.ledgered(spark, path, "bad"):
            1 / 0
    latest = {r["job_name"]: r for r in TS.latest_runs(spark.read.parquet(path)).collect()}
    assert latest["good"]["status"] == "completed" and latest["good"]["records_processed"] == 7
    assert latest["bad"]["status"] == "failed" and "division" in latest["bad"]["error_message"]


def test_relational_round_trip_keeps_decimals(spark, small):
    base = work_path(spark, "rel")
    V.fields(spark, small).select(
        F.col("field_id").cast("string"), "name", F.col("lat").cast("decimal(10,7)").alias("location_lat"),
        F.col("lon").cast("decimal(10,7)").alias("location_lon"), F.col("area_hectares").cast("decimal(10,2)"),
        "soil_type", F.current_timestamp().alias("created_at")).write.parquet(f"{base}/fields")
    df = TB.relational(spark, base, "fields")
    assert dict(df.dtypes)["location_lat"] == "decimal(10,7)" and df.count() == V.fields(spark, small).count()


def test_history_job_and_its_permission(spark, small, tmp_path):
    users = FL.with_permissions(V.users(spark, small))
    readings, fields = V.readings(spark, small), V.fields(spark, small)
    with pytest.raises(PermissionError):
        pipelines.history(readings, fields, users, 1, str(tmp_path / "none"))  # a farmer
    out = str(tmp_path / "out")
    pipelines.history(readings, fields, users, 0, out)
    active = readings.join(fields.filter("active"), "field_id", "left_semi").count()
    assert spark.read.parquet(f"{out}/cold").count() == active
    log = spark.read.parquet(f"{out}/data_generation_logs").collect()
    assert [(r["type"], r["record_count"], r["status"]) for r in log] == [("ml_training", active, "stored")]
    records = spark.read.parquet(f"{out}/disease_records").count()
    assert records == spark.read.parquet(f"{out}/alerts").count()
    assert spark.read.parquet(f"{out}/analytics_summary").agg(F.sum("disease_count")).first()[0] == records
    run = TS.latest_runs(spark.read.parquet(f"{out}/batch_jobs")).collect()
    assert [(r["status"], r["records_processed"]) for r in run] == [("completed", active)]
