"""Edge results: odd file names, null classes, repeated runs, doubled fields, rejects."""


import pytest
from pyspark.sql import functions as F

from fieldlake.functions import weather as W
from fieldlake.operators import dataset as DS, fields as FL, quality as Q
from fieldlake.plans import pipelines as P
from fieldlake.schemas import WEATHER_PAYLOAD
from fieldlake.sinks import stores as ST, tables as TS
from fieldlake.sources import domain as V, files as FS


def png(path, value):
    """A tiny valid gray PNG without any image library."""
    import struct
    import zlib

    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + bytes([value] * 4) for _ in range(4))
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 4, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def test_images_with_odd_names(spark, tmp_path):
    raw = tmp_path / "raw set"
    for label, n in (("Tomato healthy", 10), ("A+B 100% [x]", 4), ("Potato___Late_blight", 3)):
        for i in range(n):
            png(raw / label / f"leaf {i} +%20 ({i}).png", 10 * i)
    png(raw / "stray.png", 1)
    paths = DS.raw_images(FS.image_files(spark, str(raw)), str(raw))
    pixels = DS.raw_images(FS.decoded_images(spark, str(raw)), str(raw))
    assert {r.path for r in paths.collect()} == {r.path for r in pixels.select("path").collect()}
    assert {r.class_label for r in paths.collect()} == {"Tomato healthy", "A+B 100% [x]", "Potato___Late_blight"}
    P.prepare_images(spark, str(raw), str(tmp_path / "out"), "leaves", size=(4, 4), copies=1)
    manifest = spark.read.parquet(f"{tmp_path}/out/manifest").groupBy("class_label", "split").count().collect()
    done = spark.read.parquet(f"{tmp_path}/out/processed").filter("name NOT LIKE '%_aug_%'").groupBy("class_label", "split").count().collect()
    assert sorted(map(tuple, manifest)) == sorted(map(tuple, done)) and sum(r[2] for r in done) == 17


def test_attempts_add_up_to_the_files_on_disk(spark, tmp_path):
    """scanned = originals + corrupted, copies of training images only; the same figures stand beside the manifest."""
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    for i in range(20):
        png(raw / "A" / f"{i}.png", i)
    for i in range(4):
        (raw / "A" / f"bad{i}.jpg").write_bytes(b"no image")
    (raw / "A" / "notes.txt").write_text("x")
    P.prepare_images(spark, str(raw), out, "leaves", size=(4, 4), copies=2)
    log = spark.read.parquet(f"{out}/attempts")
    stats = DS.processing_stats(log).first()
    train = spark.read.parquet(f"{out}/processed").filter("split = 'train' AND copy = 0").count()
    assert (stats.n_scanned, stats.n_originals, stats.n_corrupted, stats.n_skipped) == (24, 20, 4, 0)
    assert stats.n_copies == 2 * train and stats.n_processed == 20 + 2 * train
    assert {r.path.rsplit("/", 1)[1] for r in log.filter("outcome = 'corrupted'").collect()} == {f"bad{i}.jpg" for i in range(4)}
    info = spark.read.json(f"{out}/manifest_info").first()
    assert (info.total_images, info.num_classes, info.statistics.n_corrupted) == (24, 1, 4)
    # a copy that is lost is skipped, its original is not corrupted
    done = spark.read.parquet(f"{out}/processed").select(F.col("image_id").alias("path"), "copy").filter("NOT (copy = 1 AND path LIKE '%/3.png')")
    again = DS.processing_stats(DS.attempt_log(log.select("path", "copy"), done)).first()
    lost = spark.read.parquet(f"{out}/processed").filter("copy = 1 AND image_id LIKE '%/3.png'").count()
    assert again.n_skipped == lost and again.n_corrupted == 4


def test_metadata_has_every_column(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    for i in range(6):
        png(raw / "Tomato_healthy" / f"{i}.png", 40 * i)
    P.prepare_images(spark, str(raw), out, "leaves", size=(4, 4), copies=0)
    rows = FS.metadata_csv(spark, f"{out}/metadata/csv").collect()
    assert len(rows) == 6 and len(rows[0]) == 26
    for r in rows:
        value = 40 * int(r.filename.split(".")[0])
        assert (r.width, r.height, r.channels, r.mode, r.format) == (4, 4, 3, "RGB", "JPEG")
        assert (r.pixel_min, r.pixel_max, r.pixel_mean, r.pixel_std) == (value, value, value, 0)
        assert [r[f"{c}_{m}"] for c in ("red", "green", "blue") for m in ("mean", "std")] == [value, 0] * 3
        assert r.absolute_path.endswith(r.filepath) and r.filepath == f"{r.split}/Tomato_healthy/{r.filename}" and r.modified_at is not None
    summary = spark.read.json(f"{out}/metadata/dataset_summary/summary").first()
    assert summary.classes == ["Tomato_healthy"] and summary.plant_types.asDict() == {"Tomato": 6} and summary.pixel_statistics.overall_std == 0


def test_every_value_of_a_vector_is_a_pixel(spark, tmp_path):
    """Vectors of any length make pictures that hold them all, filled up with zeros."""
    rows = [(i, [(1 + j) / 512 for j in range(n)], 0) for i, n in enumerate((1, 2, 7, 63, 64, 100))]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    for shape, channels in (("gray", 1), ("colour", 3)):
        for r in V.pixel_images(spark, str(tmp_path), shape).collect():
            data, n = r.image.data, len(rows[r.image_id][1])
            assert len(data) == r.image.height * r.image.width * channels
            assert list(data[:n]) == [1 + j for j in range(n)] and not any(data[n:])


def test_images_without_class_keep_their_split(spark):
    images = spark.createDataFrame([(i, None if i < 20 else "A") for i in range(60)], "image_id long, class_label string")
    rows = DS.stratified_split(images).collect()
    assert len(rows) == 60
    sizes = {s: sum(r.split == s for r in rows if r.class_label is None) for s in ("train", "val", "test")}
    assert sizes == {"train": 14, "val": 3, "test": 3}


def test_history_may_be_repeated(spark, small, tmp_path):
    readings, fields, users = V.readings(spark, small), V.fields(spark, small), FL.with_permissions(V.users(spark, small))
    tables = ("disease_records", "alerts", "analytics_summary", "recommendations")

    def state():
        return {t: sorted(tuple(v for k, v in r.asDict().items() if k not in ("created_at",)) for r in spark.read.parquet(f"{tmp_path}/{t}").collect()) for t in tables}

    admin = users.filter("role = 'ADMIN'").first().user_id
    P.history(readings, fields, users, admin, str(tmp_path))
    first = state()
    assert first["disease_records"] and first["analytics_summary"]
    P.history(readings, fields, users, admin, str(tmp_path))
    assert {t: len(r) for t, r in state().items()} == {t: len(r) for t, r in first.items()}
    owner = fields.filter("active").first().user_id
    P.history(readings, fields, users, admin, str(tmp_path), owner=owner)
    assert {t: len(r) for t, r in state().items()} == {t: len(r) for t, r in first.items()}


def test_a_field_listed_twice_does_not_double_rows(spark):
    fields = spark.createDataFrame([(1, 7), (1, 7), (2, 8)], "field_id long, user_id long")
    users = spark.createDataFrame([(7, ["view_own_data"]), (9, ["view_all_data"]), (5, [])], "user_id long, permissions array<string>")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "field_id long, v string")
    see = lambda u: sorted(r.v for r in FL.rows_for_user(rows, fields, users, u).collect())
    assert (see(7), see(9), see(5), see(4)) == (["a"], ["a", "b", "c"], [], [])


def test_answers_that_are_no_weather_are_left_out(spark):
    texts = ["oops", '{"cod": 401}', '{"main": {"temp": 1.0}, "wind": {"speed": 2.0}, "clouds": {"all": 3}}']
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", F.from_json("t", WEATHER_PAYLOAD))
    assert [r.t for r in rows.filter(W.is_weather(F.col("p"))).collect()] == texts[2:]


def test_rules_for_absent_columns_fail(spark):
    with pytest.raises(ValueError, match="ph"):
        Q.out_of_range(spark.createDataFrame([(1, 2.0)], "event_id long, moisture double"), [("moisture", 0.0, 1.0), ("ph", 5.0, 8.0)], "event_id")


def test_nested_readings_hold_their_own_kind(spark, small):
    nested = ST.nested_readings(V.readings(spark, small))
    mixed = nested.filter((F.col("sensor_type") == "soil") & F.col("readings.humidity").isNotNull() | (F.col("sensor_type") == "atmospheric") & F.col("readings.moisture").isNotNull())
    assert mixed.count() == 0 and nested.filter("readings.temperature IS NULL").count() == 0


def test_error_text_is_kept_whole(spark, tmp_path):
    with pytest.raises(RuntimeError), TS.ledgered(spark, str(tmp_path / "jobs"), "x"):
        raise RuntimeError("e" * 5000)
    assert max(len(r.error_message or "") for r in spark.read.parquet(str(tmp_path / "jobs")).collect()) == 5000
