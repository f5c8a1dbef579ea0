"""Operators on small hand-made tables, against plain Python where that is clearer."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from math import ceil

import pytest
from pyspark.sql import functions as F

from fieldlake.operators import dataset as DS, disease as D, fields as FL, ordered, quality as Q, summary as S, timeline as TL
from fieldlake.sinks import tables as TS

T0 = datetime(2024, 1, 1)


def rain_table(spark, rows):
    return spark.createDataFrame(rows, "event_id long, sensor_id long, timestamp timestamp, rainfall double")


def brute_spells(rows):
    spells = []
    by_sensor = defaultdict(list)
    for event, sensor, ts, rain in rows:
        by_sensor[sensor].append((ts, event, rain))
    for sensor, seen in by_sensor.items():
        current = None
        for ts, _, rain in sorted(seen):
            if rain and rain > 0:
                if current is None:
                    current = [sensor, ts, ts, 0, 0.0]
                    spells.append(current)
                current[2] = ts
                current[3] += 1
                current[4] = max(current[4], rain)
            else:
                current = None
    return sorted(tuple(s) for s in spells)


@pytest.mark.parametrize("rows_per_chunk", [20, 300, 1_000_000])
def test_rain_spells_equal_brute_force_with_a_hot_sensor(spark, rows_per_chunk):
    """One sensor holds most rows; runs cross chunk borders and midnight; some rain is missing."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        sensor = 1 if rng.random() < 0.6 else rng.randint(2, 9)
        ts = T0 + timedelta(minutes=rng.randint(0, 3 * 24 * 60))
        rows.append((i, sensor, ts, rng.choice([0.0, 0.0, 1.5, 2.25, 7.0, None])))
    got = TL.rain_spells(rain_table(spark, rows), rows_per_chunk=rows_per_chunk).select(
        "sensor_id", "spell_start", "spell_end", "n_readings", "peak_rainfall").collect()
    assert sorted(tuple(r) for r in got) == brute_spells(rows)


def test_rain_spell_over_midnight_and_one_dry_slot(spark):
    hours = [(22, 1.0), (23, 2.0), (24, 4.0), (25, 0.0), (26, 3.0)]
    rows = [(i, 1, T0 + timedelta(hours=h), r) for i, (h, r) in enumerate(hours)]
    got = TL.rain_spells(rain_table(spark, rows)).orderBy("spell_start").select("n_readings", "total_rainfall").collect()
    assert [tuple(r) for r in got] == [(3, 7.0), (1, 3.0)]


@pytest.mark.parametrize("digits", [1, 3])
def test_split_sizes_are_exact_and_membership_repeats(spark, digits):
    sizes = {"one": 1, "two": 2, "three": 3, "four": 4, "seven": 7, "ten": 10, "hundred": 100, "hot": 3000}
    rows = [(f"{name}-{i}", name) for name, n in sizes.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "image_id string, class_label string")
    split = DS.stratified_split(df, chunk_digits=digits).collect()
    counts = Counter((r["class_label"], r["split"]) for r in split)
    assert len(split) == len(rows)
    for name, n in sizes.items():
        held = 0 if n == 1 else ceil(0.3 * n)
        test = ceil(held / 2)
        assert [counts[name, s] for s in ("train", "val", "test")] == [n - held, held - test, test], name
    again = DS.stratified_split(df.repartition(7)).collect()
    assert {r["image_id"]: r["split"] for r in split} == {r["image_id"]: r["split"] for r in again}


def test_copies_only_for_training(spark):
    df = spark.createDataFrame([("a", "train"), ("b", "val"), ("c", "test")], "image_id string, split string")
    got = DS.with_copies(df).groupBy("image_id").agg(F.sort_array(F.collect_list("suffix"))).collect()
    assert {r[0]: r[1] for r in got} == {"a": ["", "_aug_1", "_aug_2", "_aug_3"], "b": [""], "c": [""]}


def test_augmentation_draws_stay_in_range(spark):
    df = spark.range(500).select("id", F.lit("train").alias("split"))
    rows = DS.augmentation_draws(DS.with_copies(df), "id").collect()
    copies = [r for r in rows if r["copy"] > 0]
    assert all(-15 <= r["angle"] <= 15 and 0.8 <= r["factor"] <= 1.2 and not r["upend"] for r in copies)
    assert 0.4 < sum(r["mirror"] for r in copies) / len(copies) < 0.6
    assert all(r["angle"] is None and r["factor"] == 1.0 for r in rows if r["copy"] == 0)


def readings(spark, rows):
    return spark.createDataFrame(
        rows, "field_id long, slot timestamp, sensor_type string, temperature double, humidity double, "
              "rainfall double, moisture double")


def test_course_has_one_start_and_counts_days(spark):
    noon = datetime(2024, 1, 1, 12)
    rows = [(1, noon + timedelta(days=d), "soil", 26.0, 90.0, 3.0, 60.0) for d in (0, 1, 4)]
    rows += [(1, noon + timedelta(days=2), "soil", 0.0, 0.0, 0.0, 0.0)]
    fields = spark.createDataFrame([(1, "pepper", 40.0, True, "North")],
                                   "field_id long, crop_type string, lat double, active boolean, name string")
    got = D.detections(readings(spark, rows), fields).orderBy("slot").select("status", "days_active", "severity").collect()
    assert [tuple(r) for r in got] == [
        ("new_infection", 0, 1.0), ("active_infection", 1, 1.0), ("active_infection", 4, 1.0)]


def test_no_soil_sensor_no_check(spark):
    noon = datetime(2024, 1, 1, 12)
    df = readings(spark, [(1, noon, "atmospheric", 26.0, 90.0, 3.0, None), (2, noon, "soil", 26.0, 90.0, 3.0, 60.0)])
    assert [r["field_id"] for r in D.field_conditions(df).collect()] == [2]


def test_inactive_fields_and_mixed_crops_find_nothing(spark):
    noon = datetime(2024, 1, 1, 12)
    df = readings(spark, [(i, noon, "soil", 26.0, 90.0, 3.0, 60.0) for i in (1, 2, 3)])
    fields = spark.createDataFrame(
        [(1, "pepper", 40.0, False, "a"), (2, "mixed", 40.0, True, "b"), (3, "Pepper", 40.0, True, "c")],
        "field_id long, crop_type string, lat double, active boolean, name string")
    records = D.disease_records(df, fields)
    assert [(r["field_id"], r["season"], r["climate_zone"]) for r in records.collect()] == [(3, "winter", "temperate")]
    assert D.alerts(records, fields).collect()[0]["message"] == "bell Bacterial spot risk detected in c"


def test_dedupe_keeps_the_lowest_id(spark):
    df = spark.createDataFrame([(3, 1, T0), (1, 1, T0), (2, 2, T0)], "event_id long, sensor_id long, timestamp timestamp")
    assert sorted(r["event_id"] for r in TL.dedupe(df).collect()) == [1, 2]


def test_missing_slots_of_one_day(spark):
    df = spark.createDataFrame([(1, T0 + timedelta(hours=h)) for h in (0, 4, 13)], "sensor_id long, timestamp timestamp")
    got = sorted(r["slot"].hour for r in TL.missing_slots(df).collect())
    assert got == [6, 9, 15, 18, 21]


def test_retention_border(spark):
    df = spark.createDataFrame([(T0,), (T0 - timedelta(days=30),), (T0 - timedelta(days=30, seconds=1),)],
                               "timestamp timestamp")
    assert TL.within_retention(df, "2024-01-01 00:00:00").count() == 2


USERS = "user_id string, name string, role string, version long"


def test_upsert_new_changed_unchanged_and_two_versions(spark):
    old = spark.createDataFrame([("a", "A", "ADMIN", 9), ("b", "B", "FARMER", 1)], USERS)
    new = spark.createDataFrame([("b", "B2", "ADMIN", 2), ("b", "B3", "RESEARCHER", 3), ("c", "C", "FARMER", 1)], USERS)
    got = TS.upsert(TS.checked_users(old), TS.checked_users(new), "user_id", "version")
    assert {r["user_id"]: (r["name"], len(r["permissions"])) for r in got.collect()} == {
        "a": ("A", 5), "b": ("B3", 3), "c": ("C", 3)}


def test_unknown_role_fails(spark):
    with pytest.raises(Exception, match="invalid role: GUEST"):
        TS.checked_users(spark.createDataFrame([("x", "X", "GUEST", 1)], USERS)).collect()


def test_insert_if_absent_keeps_first_of_equal_keys(spark):
    old = spark.createDataFrame([("a",), ("a",)], "k string")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1)], "k string, n int")
    assert [tuple(r) for r in TS.absent_rows(new, old, "k", "n").collect()] == [("b", 1)]


def test_permissions_and_visibility(spark):
    users = FL.with_permissions(spark.createDataFrame(
        [("adm", "ADMIN"), ("alice", "FARMER"), ("bob", "RESEARCHER")], "user_id string, role string"))
    asked = spark.createDataFrame([("adm",), ("alice",), ("nobody",)], "user_id string")
    got = FL.permission_check(asked, users, "run_simulation").collect()
    assert {r["user_id"]: r["allowed"] for r in got} == {"adm": True, "alice": False, "nobody": False}
    fields = spark.createDataFrame([(1, "alice"), (2, "adm")], "field_id long, user_id string")
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "field_id long, v string")
    seen = {u: sorted(r["v"] for r in FL.rows_for_user(rows, fields, users, u).collect())
            for u in ("adm", "alice", "bob", "nobody")}
    assert seen == {"adm": ["x", "y", "z"], "alice": ["x"], "bob": ["x", "y", "z"], "nobody": []}


def test_sensor_layout_and_field_defaults(spark):
    fields = spark.createDataFrame([("F1", None, None, None, None)],
                                   "field_id string, area_hectares double, crop_type string, soil_type string, active boolean")
    assert sorted(r["sensor_id"] for r in FL.expected_sensors(fields).collect()) == [
        "ATM_F1_001", *[f"SOIL_F1_00{i}" for i in range(1, 6)]]
    assert tuple(FL.with_field_defaults(fields).collect()[0]) == ("F1", 1.0, "mixed", "loam", True)


def test_quality_checks(spark):
    rows = spark.createDataFrame([(1, 14.0, 7.0), (2, 15.0, 8.1), (3, None, 5.5)], "event_id long, moisture double, ph double")
    bad = Q.out_of_range(rows, [("moisture", 15.0, 95.0), ("ph", 5.5, 8.0)], "event_id").collect()
    assert sorted(tuple(r) for r in bad) == [(1, "moisture", 14.0), (2, "ph", 8.1)]
    assert [tuple(r) for r in Q.null_counts(rows, ["moisture", "ph"]).collect()] == [("moisture", 1), ("ph", 0)]
    keys = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert {r["k"] for r in Q.key_violations(keys, ["k"]).collect()} == {"a", None}
    images = spark.createDataFrame([("x/A/1.jpg", "A"), ("x/A/1.png", "A"), ("y/A/2.jpg", "A")], "path string, class_label string")
    assert [tuple(r) for r in Q.name_clashes(images).collect()] == [("A", "1", 2)]
    assert [tuple(r) for r in Q.split_classes(images).collect()] == [("A", 2)]


def test_path_rules_of_the_two_image_trees(spark):
    paths = ["raw/A/1.JPG", "raw/A/2.txt", "raw/.hidden/3.jpg", "raw/B/C/4.tiff", "raw/B/5.jpeg.bak"]
    raw = DS.raw_images(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert {(r["filename"], r["class_label"]) for r in raw} == {("1.JPG", "A"), ("4.tiff", "C")}
    paths = ["out/train/A/1.jpg", "out/train/A/2.JPG", "out/extra/A/3.jpg", "out/val/B/4.png", "out/test/B/5.jpeg"]
    done = DS.processed_images(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert {(r["filename"], r["split"]) for r in done} == {("1.jpg", "train"), ("4.png", "val")}


def test_counts_are_zero_filled(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,)], "field_id long")
    records = spark.createDataFrame([(1,)], "field_id long")
    got = S.counts_by_field(rows, records).orderBy("field_id").collect()
    assert [tuple(r) for r in got] == [(1, 2, 1), (2, 1, 0)]


def test_hot_keys_are_cut_by_counts(spark):
    """A stray time stretches the span, one sensor and the null one hold most rows, one hour more than a chunk."""
    hot = [(i, 1, T0 + timedelta(seconds=7 * i)) for i in range(3000)] + [(9000, 1, T0 - timedelta(days=9000)), (9001, 1, None)]
    none = [(10_000 + i, None, T0 + timedelta(minutes=i)) for i in range(1000)]
    rest = [(20_000 + i, 2 + i % 50, T0 + timedelta(hours=i % 40)) for i in range(2000)]
    rows = spark.createDataFrame([(i, s, t, float(i % 3)) for i, s, t in hot + none + rest], "event_id long, sensor_id long, timestamp timestamp, rainfall double")
    wanted = 100
    spans = ordered.hot_spans(rows, "sensor_id", "timestamp", wanted)
    placed = ordered.with_time_chunk(rows, spans, "sensor_id", "timestamp")
    assert placed.count() == rows.count() and placed.columns == [*rows.columns, "_chunk"]
    per = placed.groupBy("sensor_id", "_chunk").agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).collect()
    assert max(r.n for r in per) <= 2 * wanted
    assert {r["_chunk"] for r in per if (r.sensor_id or 0) > 1} == {0}
    for sensor in (1, None):
        own = sorted((r for r in per if r.sensor_id == sensor), key=lambda r: r["_chunk"])
        assert len(own) >= 10 and all(x.b < y.a for x, y in zip(own, own[1:]))
    key = lambda r: tuple((v is not None, v) for v in r)
    cut, whole = (sorted(map(tuple, TL.rain_spells(rows, n).collect()), key=key) for n in (wanted, 10**9))
    assert cut == whole and len(whole) > 1000


def test_rainfall_keeps_its_decimals(spark):
    rows = spark.createDataFrame([(i, 1, T0 + timedelta(hours=i), 0.0004) for i in range(3)], "event_id long, sensor_id long, timestamp timestamp, rainfall double")
    assert [r.total_rainfall for r in TL.rain_spells(rows).collect()] == [0.0012]
