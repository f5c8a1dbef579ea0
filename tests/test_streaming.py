"""Streams give the rows of their batch form; repeated batches change nothing."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fieldlake.operators import disease as D, timeline as TL
from fieldlake.operators.infections import FirstDetections
from fieldlake.session import work_path
from fieldlake.sinks import stores as ST
from fieldlake.sinks.folders import FolderTable
from fieldlake.sources import domain as V, streams as SR
from fieldlake.streaming import increments, jobs as J

T0 = datetime(2024, 1, 1)


def events_in_files(spark, small, path, days_per_file=5):
    """The events as one file per few days, written in time order."""
    events = V.table(spark, small, "events")
    for first in range(1, 31, days_per_file):
        day = F.dayofmonth("ts")
        events.filter(day.between(first, first + days_per_file - 1)).coalesce(1).write.mode("append").parquet(path)
    return path


def stream_of(spark, small, path, max_files=1):
    schema = V.table(spark, small, "events").schema
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).option("latestFirst", False).parquet(path)
    return V.readings_from_events(raw)


def test_a_folder_of_files_is_read_as_a_table_stream(spark, small, tmp_path):
    events_in_files(spark, small, str(tmp_path / "events.parquet"))
    rows = J.drain_to_table(SR.readings_stream(spark, str(tmp_path), max_files=2), "folder")
    assert rows.count() == V.readings(spark, small).count()


INFECTION = ["field_id", "disease", "slot", "risk", "days_active", "status", "severity"]


def in_reverse(spark, small, path, files=5):
    """The events as files of some days each, the latest days first."""
    events = V.table(spark, small, "events")
    days = 31 // files + 1
    for n, first in enumerate(range(1 + days * (files - 1), 0, -days)):
        part = events.filter(F.dayofmonth("ts").between(first, first + days - 1)).coalesce(1)
        part.write.mode("append").parquet(path)
    return path


def rows_of(df, columns=None):
    return sorted(tuple(r) for r in (df.select(columns) if columns else df).collect())


@pytest.mark.parametrize("order", [events_in_files, in_reverse])
def test_infections_over_many_batches_equal_the_batch_form(spark, small, tmp_path, order):
    """The last hours are complete too, and files in reverse order of time lose nothing."""
    path, fields = order(spark, small, str(tmp_path / "in")), V.fields(spark, small)
    got = J.Infections(spark, str(tmp_path / "out"), fields).drain(stream_of(spark, small, path)).settle()
    wanted = rows_of(D.detections(V.readings(spark, small), fields), INFECTION)
    assert len(wanted) > 10 and any(r[5] == "active_infection" for r in wanted)
    assert rows_of(got.result(), INFECTION) == wanted


def test_a_restarted_stream_and_a_second_history_share_the_first_detections(spark, small, tmp_path):
    """A stream stopped half-way goes on; what it found is known to a batch job over later days alone."""
    fields, readings = V.fields(spark, small), V.readings(spark, small)
    path, base = str(tmp_path / "in"), str(tmp_path / "out")
    events = V.table(spark, small, "events")
    middle = F.dayofmonth("ts") <= 15
    events.filter(middle).coalesce(1).write.parquet(path)
    first = J.Infections(spark, base, fields).drain(stream_of(spark, small, path)).settle()
    before = {(r.field_id, r.disease): r.started for r in first.started.rows().collect()}
    events.filter(~middle).coalesce(1).write.mode("append").parquet(path)
    again = J.Infections(spark, base, fields).drain(stream_of(spark, small, path)).settle()
    wanted = rows_of(D.detections(readings, fields), INFECTION)
    assert rows_of(again.result(), INFECTION) == wanted
    after = {(r.field_id, r.disease): r.started for r in again.started.rows().collect()}
    assert before.items() <= after.items() and len(after) > len(before)
    later = D.detections(readings.filter(F.dayofmonth("timestamp") > 15), fields, again.started.rows())
    assert rows_of(later, INFECTION) == [r for r in wanted if r[2].day > 15]
    version = again.started.table.version().number
    again.settle()
    assert again.started.table.version().number == version  # nothing new, nothing written


def test_first_detections_take_the_earliest_and_each_batch_once(spark, tmp_path):
    table = FirstDetections(spark, str(tmp_path / "first"), parts=4)
    found = lambda *rows: spark.createDataFrame([(f, d, T0 + timedelta(hours=h)) for f, d, h in rows], "field_id long, disease string, slot timestamp")
    assert table.rows().count() == 0
    table.merge(found((1, "a", 5), (1, "a", 3), (2, "b", 9), (None, "c", 1)), mark=("s", 0))
    assert not table.merge(found((1, "a", 1)), mark=("s", 0))  # that batch is in
    table.merge(found((1, "a", 4), (2, "b", 2), (3, "c", 1)), mark=("s", 1))
    rows = {(r.field_id, r.disease): (r.started - T0).seconds // 3600 for r in table.rows().collect()}
    assert {k: v for k, v in rows.items() if k[0] is not None} == {(1, "a"): 3, (2, "b"): 2, (3, "c"): 1}


@pytest.mark.parametrize("order", [events_in_files, in_reverse])
def test_trend_over_many_batches_equals_the_batch_form(spark, small, tmp_path, order):
    path = order(spark, small, str(tmp_path / "in"))
    trend = J.trend(spark, str(tmp_path / "out")).drain(stream_of(spark, small, path))
    readings = V.readings(spark, small)
    wanted = TL.hourly_trend(readings)
    assert rows_of(J.trend_rows(trend.result())) == rows_of(wanted)
    mark = trend.watermark().replace(tzinfo=None)
    assert mark == readings.agg(F.max("timestamp")).first()[0] - timedelta(hours=1)
    closed = trend.closed("window_start").count()
    assert 0 < closed <= wanted.count()


def test_late_rows_are_kept_as_they_came(spark, small, tmp_path):
    path = in_reverse(spark, small, str(tmp_path / "in"))
    trend = J.trend(spark, str(tmp_path / "out")).drain(stream_of(spark, small, path))
    readings = V.readings(spark, small)
    late = trend.late(spark, readings.schema).read()
    first_file = late.select("batch_id").distinct().collect()
    assert 0 not in {r.batch_id for r in first_file} and len(first_file) == 4
    on_time = readings.filter(F.dayofmonth("timestamp") > 28).select("event_id")
    assert late.count() == late.select("event_id").distinct().count() == readings.count() - on_time.count()


def test_a_repeated_batch_changes_nothing(spark, small, tmp_path):
    trend, readings = J.trend(spark, str(tmp_path / "out")), V.readings(spark, small)
    for _ in range(2):
        trend.take(readings, 0)
    trend.take(readings.filter("event_id < 0"), 1)  # a batch without rows
    assert rows_of(J.trend_rows(trend.result())) == rows_of(TL.hourly_trend(readings))


def test_many_parts_of_a_day_are_merged(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(increments, "FOLD_AFTER", 3)
    readings, day = V.readings(spark, small), F.to_date("timestamp") == "2024-01-05"
    readings = readings.filter(day)
    trend, sessions = J.trend(spark, str(tmp_path / "t")), J.rain_sessions(spark, str(tmp_path / "s"))
    for n in range(6):
        for job in (trend, sessions):
            job.take(readings.filter(F.col("event_id") % 6 == n), n)
    assert len(trend.parts.version().live) <= 4
    assert rows_of(J.trend_rows(trend.result())) == rows_of(TL.hourly_trend(readings))
    whole = J.rain_sessions(spark, str(tmp_path / "w"))
    whole.take(readings, 0)
    assert rows_of(sessions.result()) == rows_of(whole.result())


def test_hot_and_cold_hold_every_row_once_and_a_repeat_changes_nothing(spark, small, tmp_path):
    path = events_in_files(spark, small, str(tmp_path / "in"))
    n = V.readings(spark, small).count()
    for _ in range(2):  # the second run finds its checkpoint and no new input
        hot, cold = J.hot_and_cold(stream_of(spark, small, path), str(tmp_path / "out"))
        assert spark.read.parquet(hot).count() == n
        assert spark.read.parquet(cold).select("event_id").distinct().count() == n
    assert len(spark.read.parquet(hot).select("batch_id").distinct().collect()) == 6


def test_a_broken_cold_path_ends_with_no_row_lost_or_doubled(spark, small, tmp_path, monkeypatch):
    path, n = events_in_files(spark, small, str(tmp_path / "in")), V.readings(spark, small).count()
    write, broken = FolderTable._write, []

    def failing(self, rows, watch=lambda rows: rows):
        if self.path.endswith("/cold") and len(broken) < 3:
            broken.append(1)
            raise OSError("store is away")
        return write(self, rows, watch)

    monkeypatch.setattr(FolderTable, "_write", failing)
    hot, cold = J.hot_and_cold(stream_of(spark, small, path), str(tmp_path / "out"))
    assert len(broken) == 3
    table = ST.cold_store(spark, cold, V.readings(spark, small).schema).read()
    assert table.count() == n == table.select("event_id").distinct().count() == spark.read.parquet(hot).count()
    assert set(table.columns) >= {"data_type", "ingest_date"}


def test_an_archive_flush_that_broke_off_is_made_again(spark, small, tmp_path, monkeypatch):
    path, n = events_in_files(spark, small, str(tmp_path / "in")), V.readings(spark, small).count()
    out, commit, stops = str(tmp_path / "out"), FolderTable._commit, [1]

    def stopping(self, *args):
        if stops and self.path.endswith("/archive"):
            stops.pop()
            raise RuntimeError("stopped after writing, before the commit")
        return commit(self, *args)

    monkeypatch.setattr(FolderTable, "_commit", stopping)
    with pytest.raises(BaseException):
        J.threshold_archive(stream_of(spark, small, path), out, threshold=300)
    assert not stops
    archive = J.threshold_archive(stream_of(spark, small, path), out, threshold=300)
    schema = V.readings(spark, small).schema.add("flush_id", "long")
    rows = ST.cold_store(spark, archive, schema).read()
    assert rows.count() == n == rows.select("event_id").distinct().count()
    assert not list((tmp_path / "out" / "waiting").glob("batch_id=*"))


def test_archive_flushes_at_the_threshold_and_loses_nothing(spark, small, tmp_path):
    path = events_in_files(spark, small, str(tmp_path / "in"))
    archive = J.threshold_archive(stream_of(spark, small, path), str(tmp_path / "out"), threshold=300)
    rows = spark.read.parquet(archive)
    sizes = [r["count"] for r in rows.groupBy("flush_id").count().orderBy("flush_id").collect()]
    assert sum(sizes) == V.readings(spark, small).count() == rows.select("event_id").distinct().count()
    assert all(s >= 300 for s in sizes[:-1])
    # new input after a restart: only the new rows are archived
    extra = V.table(spark, small, "events").limit(50).withColumn("event_id", F.col("event_id") + 1_000_000)
    extra.coalesce(1).write.mode("append").parquet(path)
    J.threshold_archive(stream_of(spark, small, path), str(tmp_path / "out"), threshold=300)
    again = spark.read.parquet(archive)
    assert again.count() == sum(sizes) + 50 == again.select("event_id").distinct().count()


def test_rain_sessions_of_scattered_batches_meet(spark, tmp_path):
    """Rows of one session in several batches, in any order, are one session."""
    hours = [0, 30, 11, 41, 22, 100, 52]
    rows = [(i, 1, T0 + timedelta(hours=h), 0.0005) for i, h in enumerate(hours)]
    df = spark.createDataFrame(rows, "event_id long, sensor_id long, timestamp timestamp, rainfall double")
    job = J.rain_sessions(spark, str(tmp_path / "out"))
    for i in range(len(rows)):
        job.take(df.filter(F.col("event_id") == i), i)
    got = J.session_rows(job.result()).orderBy("session_start").collect()
    assert [(r.n_readings, r.total_rainfall) for r in got] == [(6, 0.003), (1, 0.0005)]


def test_dedupe_in_reverse_order_loses_no_row(spark, small, tmp_path):
    path = in_reverse(spark, small, str(tmp_path / "in"))
    events = V.table(spark, small, "events")
    events.filter("event_id % 7 = 0").coalesce(1).write.mode("append").parquet(path)
    readings = V.readings(spark, small)
    rows = J.deduped(spark, str(tmp_path / "out"), readings.schema).drain(stream_of(spark, small, path)).result()
    assert rows_of(rows, ["event_id"]) == rows_of(readings, ["event_id"])


def test_rain_sessions_and_spells_differ_at_a_dry_reading(spark, tmp_path):
    """An island ends at a dry reading, a session only at a gap in time."""
    rows = [(i, 1, T0 + timedelta(hours=h), r) for i, (h, r) in enumerate([(0, 1.0), (1, 0.0), (2, 2.0), (30, 4.0)])]
    rows.append((9, 2, T0 + timedelta(days=9), 1.0))  # moves the watermark
    df = spark.createDataFrame(rows, "event_id long, sensor_id long, timestamp timestamp, rainfall double")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    sessions = J.session_rows(J.rain_sessions(spark, str(tmp_path / "out")).drain(stream).result())
    found = sessions.filter("sensor_id = 1").orderBy("session_start").collect()
    assert [(r["n_readings"], r["total_rainfall"]) for r in found] == [(2, 3.0), (1, 4.0)]
    assert sessions.count() == 3  # the last one is there too
    spells = TL.rain_spells(df).filter("sensor_id = 1").collect()
    assert sorted(r["total_rainfall"] for r in spells) == [1.0, 6.0]


def test_dedupe_stream_over_batches(spark, small, tmp_path):
    path = str(tmp_path / "in")
    events = V.table(spark, small, "events")
    events.coalesce(1).write.parquet(path)
    events.filter("event_id % 7 = 0").coalesce(1).write.mode("append").parquet(path)
    stream = stream_of(spark, small, path, max_files=10)
    readings = V.readings_from_events(events)
    rows = J.deduped(spark, str(tmp_path / "out"), readings.schema).drain(stream).result()
    assert rows.count() == events.count() == rows.select("event_id").distinct().count()
    assert work_path(spark, "x") != work_path(spark, "x")
