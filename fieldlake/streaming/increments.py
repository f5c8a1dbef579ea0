"""Streams whose results are complete: no late row is lost, no open window stays behind.

Each micro-batch is reduced to partial results that can be merged in any order
(counts, sums, extremes per window, sessions), and these are committed to a table
under the batch id. A window's value is the merge of its parts, so rows may come in
any order and rows behind the watermark still count; they are also kept as they
came in a side table. Windows that end before the watermark are closed; once
a bounded input has been drained the rest is complete too.

Nothing is kept in memory between batches: a stream started again on the same folder
goes on where it stopped, and a repeated batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from fieldlake.sinks.folders import FolderTable

Reduce = Callable[[DataFrame], DataFrame]

#: Every so many batches the days with more parts than that are merged.
FOLD_AFTER = 16


class Increments:
    """Partial results of a stream under ``base``, bucketed by the day of ``day``.

    ``partial`` reduces the rows of a batch, ``merge`` partial results of one or more
    batches to the same columns.
    """

    def __init__(self, spark: SparkSession, base: str, partial: Reduce, merge: Reduce, schema: T.StructType, day: str,
                 time: str = "timestamp", delay: timedelta = timedelta(hours=1)):
        self.base, self.partial, self.merge, self.day, self.time, self.delay = base.rstrip("/"), partial, merge, day, time, delay
        self.columns = schema.names
        dated = T.StructType([*schema.fields, T.StructField("_day", T.DateType())])
        self.parts = FolderTable(spark, f"{self.base}/parts", dated, ["_day"])

    def _dated(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.columns, F.to_date(self.day).alias("_day"))

    def watermark(self) -> datetime | None:
        """What the stream has seen, less the delay."""
        high = self.parts.version().marks.get("high")
        return None if high is None else datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=high) - self.delay

    def late(self, spark: SparkSession, schema: T.StructType) -> FolderTable:
        """The rows that came behind the watermark, by batch."""
        return FolderTable(spark, f"{self.base}/late", T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]), ["batch_id"])

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: late rows to the side table, partial results to the parts."""
        spark, mark = batch.sparkSession, self.watermark()
        behind = F.lit(False) if mark is None else F.col(self.time) < F.lit(mark)
        figures = [F.unix_micros(F.max(F.col(self.time).cast("timestamp"))).alias("high"), F.count_if(behind).alias("late")]
        seen, late = Observation(), self.late(spark, batch.schema)

        def notes() -> dict[str, int]:
            try:
                found = seen.get
            except Exception:  # an empty result is planned away, and its observation with it
                found = batch.agg(*figures).first().asDict()
            if found["late"]:
                late.append(batch.filter(behind).withColumn("batch_id", F.lit(batch_id)), ("stream", batch_id))
            highs = [h for h in (found["high"], self.parts.version().marks.get("high")) if h is not None]
            return {"high": max(highs)} if highs else {}

        self.parts.append(self._dated(self.partial(batch.observe(seen, *figures))), ("stream", batch_id), notes=notes)
        if batch_id % FOLD_AFTER == FOLD_AFTER - 1:
            self.parts.compact(FOLD_AFTER, lambda rows: self._dated(self.merge(rows.drop("_day"))))

    def start(self, stream: DataFrame, interval: int | None = None) -> StreamingQuery:
        """Work off what is available, or go on every ``interval`` seconds."""
        trigger = {"processingTime": f"{interval} seconds"} if interval else {"availableNow": True}
        return (stream.writeStream.foreachBatch(self.take).option("checkpointLocation", f"{self.base}/checkpoint").trigger(**trigger).start())

    def drain(self, stream: DataFrame) -> Increments:
        self.start(stream).awaitTermination()
        return self

    def result(self) -> DataFrame:
        """The merged results of everything seen, open windows included."""
        return self.merge(self.parts.read().drop("_day"))

    def closed(self, end: str) -> DataFrame:
        """Merged results whose ``end`` the watermark has passed: only late rows can still change them."""
        mark = self.watermark()
        return self.result().filter(F.lit(False) if mark is None else F.col(end) <= F.lit(mark))
