"""Streaming jobs. Each runs to the end of what is available, or on and on, and leaves a table.

Rules for all of them: event time is ``timestamp``; the watermark is one hour unless
said otherwise; checkpoint and tables lie under one folder, and a job started again on
that folder goes on where it stopped; every batch is written under its batch id, so a
repeated batch changes nothing. Rows behind the watermark count all the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from fieldlake import constants as K
from fieldlake.operators import disease as D
from fieldlake.operators.infections import FirstDetections
from fieldlake.session import file_system, path_exists, work_path
from fieldlake.sinks import stores as ST
from fieldlake.streaming.increments import Increments


def drain_to_table(stream: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Run a stateless stream over all available input into a Parquet table and read it back.

    With ``base`` a later call goes on there; without, the table is a new one.
    """
    spark = stream.sparkSession
    base = base or work_path(spark, name)
    (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start(f"{base}/table").awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


def start_batches(stream: DataFrame, base: str, write: Callable[[DataFrame, int], None],
                  interval: int | None = None) -> StreamingQuery:
    """Run ``write`` on every batch: over what is available, or every ``interval`` seconds until stopped."""
    trigger = {"processingTime": f"{interval} seconds"} if interval else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
        .trigger(**trigger).start()
    )


def start_hot_and_cold(stream: DataFrame, base: str, interval: int | None = None) -> StreamingQuery:
    """Every micro-batch to the hot table, and from there to the cold archive.

    The archive is made from the batch as the hot table holds it, so both hold the
    same rows and the input is worked out once. When the cold store fails, the batch
    waits in the side store and is replayed with a later batch.
    """
    spark, hot = stream.sparkSession, f"{base}/hot"
    cold = ST.cold_store(spark, f"{base}/cold", stream.schema)
    side = ST.SideStore(spark, f"{base}/fallback", cold.schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{hot}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        rows = spark.read.schema(batch.schema).parquet(folder)
        ST.append_or_keep(rows.withColumns({"data_type": F.lit("realtime_archive"), "ingest_date": F.to_date("timestamp")}),
                          cold, side, ("stream", batch_id))
        if batch_id % 16 == 15:
            cold.compact()

    return start_batches(stream, base, write, interval)


def hot_and_cold(stream: DataFrame, base: str, interval: int | None = None) -> tuple[str, str]:
    """``start_hot_and_cold`` until it ends; the hot and the cold folder. What still waits in the side store is replayed."""
    start_hot_and_cold(stream, base, interval).awaitTermination()
    replay_cold(stream.sparkSession, base, stream.schema)
    return f"{base}/hot", f"{base}/cold"


def replay_cold(spark: SparkSession, base: str, schema: T.StructType) -> int:
    """Move the batches that the cold store refused from the side store into it."""
    cold = ST.cold_store(spark, f"{base}/cold", schema)
    return ST.SideStore(spark, f"{base}/fallback", cold.schema).replay(cold)


def threshold_archive(stream: DataFrame, base: str, threshold: int = K.ARCHIVE_THRESHOLD) -> str:
    """Archive batches once at least ``threshold`` rows wait, and the rest at the end.

    Waiting rows lie in a table, one folder per batch, and are counted as they are
    written. A flush moves them to the cold layout in one commit that carries the last
    batch, so a flush that broke off is made again and none is made twice; flushed
    folders are deleted. Nothing waits in memory, so nothing is lost on a stop.
    """
    spark = stream.sparkSession
    waiting, stored = f"{base}/waiting", T.StructType([*stream.schema.fields, T.StructField("flush_id", T.LongType())])
    archive = ST.cold_store(spark, f"{base}/archive", stored)
    files, to_path = file_system(spark, waiting)

    def batches() -> list[int]:
        if not path_exists(spark, waiting):
            return []
        return sorted(int(s.getPath().getName().removeprefix("batch_id=")) for s in files.listStatus(to_path(waiting)))

    def rows_of(ids: list[int]) -> DataFrame:
        return spark.read.schema(stream.schema).parquet(*[f"{waiting}/batch_id={i}" for i in ids])

    def flush(ids: list[int]) -> None:
        last = ids[-1]
        archive.append(rows_of(ids).withColumns({
            "flush_id": F.lit(last).cast("long"), "data_type": F.lit("realtime_archive"), "ingest_date": F.to_date("timestamp")}), ("flush", last))
        for i in ids:
            files.delete(to_path(f"{waiting}/batch_id={i}"), True)
        counts.clear()

    def reached() -> int:
        return archive.version().marks.get("flush", -1)

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= reached():
            return
        seen = Observation()
        batch.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{waiting}/batch_id={batch_id}")
        counts[batch_id] = seen.get["n"]
        if sum(counts.values()) >= threshold:
            flush(sorted(counts))

    for i in batches():  # of a flush that broke off after its commit
        if i <= reached():
            files.delete(to_path(f"{waiting}/batch_id={i}"), True)
    counts = {i: rows_of([i]).count() for i in batches()}
    start_batches(stream, base, write).awaitTermination()
    if counts:
        flush(sorted(counts))
    return archive.path


def _columns(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


def trend(spark: SparkSession, base: str) -> Increments:
    """Hourly means per sensor kind: counts and sums per window, which add up in any order."""

    def partial(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.date_trunc("hour", "timestamp").alias("window_start"), "sensor_type").agg(
            F.count(F.lit(1)).alias("n"), F.sum("temperature").alias("t"), F.count("temperature").alias("nt"),
            F.sum("moisture").alias("m"), F.count("moisture").alias("nm"))

    def merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy("window_start", "sensor_type").agg(*[F.sum(c).alias(c) for c in ("n", "t", "nt", "m", "nm")])

    return Increments(spark, base, partial, merge, _columns(
        "window_start timestamp, sensor_type string, n long, t double, nt long, m double, nm long"), "window_start")


def trend_rows(parts: DataFrame) -> DataFrame:
    """The columns of ``hourly_trend`` from merged parts."""
    return parts.select(
        "window_start", "sensor_type", F.col("n").alias("n_readings"),
        F.when(F.col("nt") > 0, F.col("t") / F.col("nt")).alias("avg_temperature"),
        F.when(F.col("nm") > 0, F.col("m") / F.col("nm")).alias("avg_moisture"))


def rain_sessions(spark: SparkSession, base: str, gap: str = "12 hours") -> Increments:
    """Wet readings of a sensor with less than ``gap`` between them, as one session.

    A batch leaves its own sessions; sessions of several batches that overlap are one.
    """

    def partial(rows: DataFrame) -> DataFrame:
        wet = rows.filter(F.col("rainfall") > 0)
        return wet.groupBy("sensor_id", F.session_window("timestamp", gap).alias("s")).agg(
            F.count(F.lit(1)).alias("n_readings"), F.sum(F.col("rainfall").cast(K.RAIN_SUM)).cast("decimal(38,9)").alias("total"),
            F.max("rainfall").alias("peak_rainfall")).select(
            "sensor_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n_readings", "total", "peak_rainfall")

    def merge(parts: DataFrame) -> DataFrame:
        before = Window.partitionBy("sensor_id").orderBy("session_start", "session_end")
        reach = F.max("session_end").over(before.rowsBetween(Window.unboundedPreceding, -1))
        begun = parts.withColumn("_new", F.when(F.col("session_start") < reach, 0).otherwise(1))
        numbered = begun.withColumn("_session", F.sum("_new").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        return numbered.groupBy("sensor_id", "_session").agg(
            F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("n_readings").alias("n_readings"),
            F.sum("total").cast("decimal(38,9)").alias("total"), F.max("peak_rainfall").alias("peak_rainfall")).drop("_session")

    return Increments(spark, base, partial, merge, _columns(
        "sensor_id long, session_start timestamp, session_end timestamp, n_readings long, total decimal(38,9), peak_rainfall double"), "session_start")


def session_rows(parts: DataFrame) -> DataFrame:
    return parts.select("sensor_id", "session_start", "session_end", "n_readings", F.col("total").cast("double").alias("total_rainfall"), "peak_rainfall")


def deduped(spark: SparkSession, base: str, schema: T.StructType, keys: tuple[str, ...] = ("sensor_id", "timestamp"), tie: str = "event_id") -> Increments:
    """The first row of each key, for good: a batch adds the rows whose key its days don't hold yet."""

    def first(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(tie)
        return rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1).drop("_n")

    def partial(rows: DataFrame) -> DataFrame:
        days = [r[0] for r in unwatched[0].select(F.to_date("timestamp")).distinct().collect()]  # of one batch
        held = store.parts.read().filter(F.col("_day").isin(days) | F.col("_day").isNull()).select(*[F.col(k).alias(f"_{k}") for k in keys])
        return first(rows).join(held, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_anti")

    unwatched: list[DataFrame] = []
    store = Increments(spark, base, partial, first, schema, "timestamp")
    take = store.take

    def remember(batch: DataFrame, batch_id: int) -> None:
        unwatched[:] = [batch]
        take(batch, batch_id)

    store.take = remember
    return store


class Infections:
    """Infections of a stream: hourly field conditions that add up in any order, and the stored first detections.

    The state is the table of first detections, shared with the batch jobs; the stream
    is a source of its own there, and ``settle`` brings it up to date.
    """

    def __init__(self, spark: SparkSession, base: str, fields: DataFrame, started: FirstDetections | None = None):
        self.fields, self.source = fields, f"stream {base}"
        self.started = started or FirstDetections(spark, f"{base}/first_detections")
        self.hours = Increments(spark, base, self._partial, self._merge, _columns(
            "field_id long, slot timestamp, temperature double, humidity double, rainfall double, m double, nm long, soil long"), "slot")

    @staticmethod
    def _partial(rows: DataFrame) -> DataFrame:
        soil = F.col("sensor_type") == "soil"
        return rows.groupBy("field_id", F.date_trunc("hour", "timestamp").alias("slot")).agg(
            *[F.max(c).alias(c) for c in ("temperature", "humidity", "rainfall")],
            F.sum(F.when(soil, F.col("moisture"))).alias("m"), F.count(F.when(soil, F.col("moisture"))).alias("nm"), F.count_if(soil).alias("soil"))

    @staticmethod
    def _merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy("field_id", "slot").agg(
            *[F.max(c).alias(c) for c in ("temperature", "humidity", "rainfall")], *[F.sum(c).alias(c) for c in ("m", "nm", "soil")])

    def _selected(self, hours: DataFrame) -> DataFrame:
        known = hours.filter(F.col("soil") > 0).withColumn("soil_moisture", F.when(F.col("nm") > 0, F.col("m") / F.col("nm")))
        return D.best_rules(D.with_crop(known.drop("m", "nm", "soil"), self.fields))

    def start(self, stream: DataFrame, interval: int | None = None) -> StreamingQuery:
        return self.hours.start(stream, interval)

    def drain(self, stream: DataFrame) -> Infections:
        self.hours.drain(stream)
        return self

    def settle(self, closed_only: bool = False) -> Infections:
        """Bring the first detections up to date; from closed hours alone while input may still come."""
        hours = self.hours.result()
        if closed_only:
            mark = self.hours.watermark()
            hours = hours.filter(F.lit(False) if mark is None else F.col("slot") + F.expr("INTERVAL 1 HOUR") <= F.lit(mark))
        self.started.replace(self._selected(hours), self.source)
        return self

    def result(self) -> DataFrame:
        """Status, days and severity of every field-hour seen, open hours included; infections
        that other jobs know of go on from there."""
        return D.infection_progress(self._selected(self.hours.result()), started=self.started.rows(without=self.source))


def alert_stream(records: DataFrame, fields: DataFrame) -> DataFrame:
    """Alerts for newly stored disease records: stream joined with the static fields."""
    return D.alerts(records, fields)
