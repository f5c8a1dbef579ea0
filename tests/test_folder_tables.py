"""Tables switched by one version file: what is read, what is written, where a run may stop."""

import pytest
from pyspark.sql import functions as F

from fieldlake.operators import fields as FL
from fieldlake.plans import pipelines as P
from fieldlake.schemas import USERS
from fieldlake.sinks import stores as ST, tables as TS
from fieldlake.sinks.folders import Conflict, FolderTable, KeyedTable
from fieldlake.sources import domain as V

ROWS = "k long, v string"


def keyed(spark, path, parts=8):
    return KeyedTable(spark, str(path), spark.createDataFrame([], ROWS).schema, ["k"], parts)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def content(table):
    return sorted((tuple(r) for r in table.rows().collect()), key=str)


@pytest.fixture
def filled(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    table.add(frame(spark, *[(i, "old") for i in range(100)], (None, "old")), ("w", 0))
    return table


def test_a_batch_is_applied_once(spark, filled):
    before = content(filled)
    assert len(before) == 101
    assert not filled.add(frame(spark, (5, "again")), ("w", 0)) and content(filled) == before
    assert filled.add(frame(spark, (500, "new")), ("w", 1)) and len(content(filled)) == 102
    assert filled.add(frame(spark, (501, "new")), ("other", 0))


def test_replacing_one_key_touches_its_bucket_alone(spark, filled):
    before = set(filled.version().live)
    filled.replace(frame(spark, (7, "a"), (7, "b")), frame(spark, (7, None)))
    after = set(filled.version().live)
    assert len(before - after) == len(after - before) == 1
    assert [r for r in content(filled) if r[0] == 7] == [(7, "a"), (7, "b")] and len(content(filled)) == 102
    filled.replace(frame(spark), frame(spark, (None, None), (8, None), (12345, None)))  # to nothing, null keys too
    assert len(content(filled)) == 100 and not [r for r in content(filled) if r[0] in (8, None)]


def test_untouched_buckets_are_not_read(spark, filled):
    plans = []

    def look(old):
        plans.append(old.inputFiles())
        return old

    filled.rewrite(filled._placed(frame(spark, (7, None))), look)
    assert len({f.split("bucket=")[1].split("/")[0] for f in plans[0]}) == 1


def test_a_stop_at_any_point_leaves_the_old_or_the_new_table(spark, filled, monkeypatch):
    old = content(filled)
    change = lambda: filled.replace(frame(spark, (7, "x")), frame(spark, (7, None)))
    for name in ("_write", "_commit"):
        with monkeypatch.context() as m:
            m.setattr(FolderTable, name, lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                change()
        assert content(filled) == old
    # a version file cut short counts for nothing, and its number is not used again
    half = f"{filled.path}/_versions/{filled.version().number + 1:012d}.json"
    with open(half, "w") as f:
        f.write('{"live": ["buck')
    assert content(filled) == old
    change()
    assert (7, "x") in content(filled) and len(content(filled)) == len(old)


def test_two_writers_don_t_overwrite_each_other(spark, filled):
    def meanwhile(old):
        keyed(spark, filled.path).add(frame(spark, (900, "other")))
        return old

    with pytest.raises(Conflict):
        filled.rewrite(filled._placed(frame(spark, (7, None))), meanwhile)
    assert len(content(filled)) == 102


def test_rows_may_not_leave_the_touched_buckets(spark, filled):
    with pytest.raises(ValueError, match="touched"):
        filled.replace(frame(spark, *[(i, "stray") for i in range(50)]), frame(spark, (7, None)))
    assert len(content(filled)) == 101


def test_compaction_and_vacuum_keep_the_content(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, data_type string, ingest_date date").schema
    cold = ST.cold_store(spark, str(tmp_path / "cold"), schema)
    for n in range(6):
        cold.append(spark.range(n * 10, n * 10 + 10).select("id", F.lit("a b/c").alias("data_type"), F.expr("date_add(DATE'2024-01-01', int(id % 3))").alias("ingest_date")))
    assert len(cold.version().live) == 18 and cold.compact(most=4) == 3
    assert len(cold.version().live) == 3 and cold.read().select("id").distinct().count() == cold.read().count() == 60
    one = cold.read().filter("ingest_date = DATE'2024-01-02' AND data_type = 'a b/c'")
    assert one.count() == 20 and "PartitionFilters: [isnotnull(ingest_date" in one._jdf.queryExecution().simpleString()
    assert cold.vacuum(keep=1) == 18 and cold.read().count() == 60
    assert spark.read.parquet(cold.path).count() == 60


def test_users_are_stored_and_the_latest_version_wins(spark, tmp_path):
    users = KeyedTable(spark, str(tmp_path / "users"), USERS, ["user_id"], 4)
    make = lambda *rows: spark.createDataFrame([(i, n, r, v) for i, n, r, v in rows], "user_id long, name string, role string, version long").withColumn(
        "created_at", F.timestamp_seconds("version"))
    TS.upsert_users(users, make((1, "a", "FARMER", 1), (2, "b", "ADMIN", 1)), "version")
    TS.upsert_users(users, make((1, "a2", "ADMIN", 5), (1, "a1", "FARMER", 3), (3, "c", "RESEARCHER", 2)), "version", ("s", 0))
    assert not TS.upsert_users(users, make((1, "late", "ADMIN", 9)), "version", ("s", 0))
    rows = {r.user_id: r for r in users.rows().collect()}
    assert {i: (r.name, r.role, r.created_at.second, len(r.permissions)) for i, r in rows.items()} == {
        1: ("a2", "ADMIN", 5, 5), 2: ("b", "ADMIN", 1, 5), 3: ("c", "RESEARCHER", 2, 3)}
    with pytest.raises(Exception, match="invalid role"):
        TS.upsert_users(users, make((4, "x", "KING", 1)), "version")
    assert users.rows().count() == 3


def test_failed_writes_wait_and_are_replayed_once(spark, tmp_path):
    rows = spark.range(10).select("id", F.lit("ml_training").alias("data_type"), F.lit("2024-01-01").cast("date").alias("ingest_date"))
    good = ST.cold_store(spark, str(tmp_path / "cold"), rows.schema)
    side = ST.SideStore(spark, str(tmp_path / "side"), good.schema)
    bad = ST.cold_store(spark, "nostore://x/cold", rows.schema)
    for _ in range(2):  # the batch comes again: it waits already
        assert ST.append_or_keep(rows, bad, side, ("s", 0)) == "fallback"
    assert ST.append_or_keep(rows.withColumn("id", F.col("id") + 10), bad, side, ("s", 1)) == "fallback"
    assert side.waiting() == [0, 1]
    entry = side.table.read().filter("entry = 0").drop("entry")
    good.append(entry, ("replay", 0))  # a replay that stopped before it took its entry out
    assert ST.append_or_keep(rows.withColumn("id", F.col("id") + 20), good, side, ("s", 2)) == "stored"
    assert side.waiting() == [] and sorted(r.id for r in good.read().collect()) == list(range(30))
    log, counts = str(tmp_path / "log"), []
    plain = rows.drop("ingest_date")
    for path in ("nostore://x/cold", str(tmp_path / "cold2")):
        counts.append(ST.append_logged(plain, ["ml_training"], path, log, F.lit("2024-01-01").cast("date"), str(tmp_path / "side2")))
    assert counts == [{"ml_training": 10}] * 2
    assert sorted((r.status, r.record_count) for r in spark.read.parquet(log).collect()) == [("fallback", 10), ("stored", 10)]
    assert ST.cold_store(spark, str(tmp_path / "cold2"), rows.schema).read().count() == 20


def test_history_holds_weather_and_labels_and_goes_on_between_runs(spark, small, tmp_path):
    readings, fields, users = V.readings(spark, small), V.fields(spark, small), FL.with_permissions(V.users(spark, small))
    admin = users.filter("role = 'ADMIN'").first().user_id
    half, whole = str(tmp_path / "half"), str(tmp_path / "whole")
    P.history(readings, fields, users, admin, whole)
    P.history(readings, fields, users, admin, half, until="2024-01-15", days=400)
    first = {(r.field_id, r.disease): r.started for r in spark.read.parquet(f"{half}/first_detections").collect()}
    P.history(readings.filter("timestamp > '2024-01-15'"), fields, users, admin, half)
    records = lambda out: {(r.field_id, r.detection_date): (r.disease, r.status, r.severity) for r in spark.read.parquet(f"{out}/disease_records").collect()}
    later, all_ = records(half), records(whole)
    assert first and later and later == {k: v for k, v in all_.items() if k[1].day >= 15}
    cold = spark.read.parquet(f"{whole}/cold")
    assert cold.filter("weather_context.temperature IS NULL OR weather_context.season IS NULL OR label IS NULL").count() == 0
    spread = cold.groupBy("field_id", F.date_trunc("hour", "timestamp")).agg(F.count_distinct("weather_context").alias("n")).agg(F.max("n")).first()[0]
    assert spread == 1
    days = {(str(f), d.date()) for f, d in all_}
    ill = {(r.field_id, r.d) for r in cold.filter("label <> 'healthy'").select("field_id", F.to_date("timestamp").alias("d")).distinct().collect()}
    assert ill == days
    few = str(tmp_path / "few")
    P.history(readings, fields, users, admin, few, days=3, include_diseases=False)
    stamps = spark.read.parquet(f"{few}/cold").agg(F.min("timestamp"), F.max("timestamp")).first()
    assert (stamps[1] - stamps[0]).days < 3


def test_fields_are_registered_once_with_their_sensors(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    make = lambda *ids: spark.createDataFrame([(i, 1, f"f{i}", 10.0 + i, 20.0) for i in ids], "field_id long, user_id long, name string, lat double, lon double")
    assert P.register_fields(make(1, 2), out) == 2 and P.register_fields(make(2, 3), out) == 1
    add = KeyedTable.add
    monkeypatch.setattr(KeyedTable, "add", lambda self, rows, mark=None: 1 / 0 if self.path.endswith("fields") else add(self, rows, mark))
    with pytest.raises(ZeroDivisionError):
        P.register_fields(make(4), out)  # stops between sensors and fields
    monkeypatch.undo()
    assert P.register_fields(make(4), out) == 1
    fields = spark.read.parquet(f"{out}/fields").collect()
    sensors = spark.read.parquet(f"{out}/sensors").collect()
    assert sorted(f.field_id for f in fields) == [1, 2, 3, 4] and {(f.area_hectares, f.crop_type, f.soil_type, f.active) for f in fields} == {(1.0, "mixed", "loam", True)}
    assert len(sensors) == 24 == len({s.sensor_id for s in sensors})
    assert all(abs(s.lat - 10 - s.field_id) <= 0.01 and abs(s.lon - 20) <= 0.01 for s in sensors)
    assert all((s.lat, s.lon) == (10.0 + s.field_id, 20.0) for s in sensors if s.sensor_type == "atmospheric")


def test_live_jobs_write_results_and_go_on(spark, small, tmp_path):
    from fieldlake.operators import disease as D, timeline as TL
    from fieldlake.sources import streams as SR

    folder, out = tmp_path / "tables", str(tmp_path / "out")
    events, fields = V.table(spark, small, "events"), V.fields(spark, small)
    events.filter("event_id % 2 = 0").coalesce(1).write.parquet(str(folder / "events.parquet"))
    jobs = ("store", "trend", "rain", "infections")
    P.live(SR.readings_stream(spark, str(folder)), fields, out, jobs=jobs)
    events.filter("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(str(folder / "events.parquet"))
    P.live(SR.readings_stream(spark, str(folder)), fields, out, jobs=jobs)
    own = P.readings_of(V.readings(spark, small), fields)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(spark.read.parquet(f"{out}/trend/result")) == rows(TL.hourly_trend(own))
    names = ["field_id", "disease", "slot", "days_active", "status", "severity"]
    assert rows(spark.read.parquet(f"{out}/infections/result").select(names)) == rows(D.detections(own, fields).select(names))
    assert spark.read.parquet(f"{out}/cold").count() == own.count() == spark.read.parquet(f"{out}/hot").count()
    assert spark.read.parquet(f"{out}/rain/result").agg(F.sum("n_readings")).first()[0] == own.filter("rainfall > 0").count()


def test_newest_lists_take_filters(spark, small):
    from fieldlake.operators import disease as D

    records = D.disease_records(V.readings(spark, small), V.fields(spark, small))
    one = records.first()
    assert {r.field_id for r in D.newest_diseases(records, 50, field_id=one.field_id).collect()} == {one.field_id}
    assert all(r.severity >= 0.8 for r in D.newest_diseases(records, 50, least_severity=0.8).collect())
    alerts = D.alerts(records, V.fields(spark, small))
    got = D.newest_alerts(alerts, 5, status="new_infection").collect()
    assert {r.status for r in got} == {"new_infection"} and [r.created_at for r in got] == sorted((r.created_at for r in got), reverse=True)
