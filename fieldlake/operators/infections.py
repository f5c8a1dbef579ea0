"""Since when a field has a disease: state that outlives a run.

The table holds the earliest detection of each (field, disease) by every source.
History jobs share one source and merge minima, in any order and more than once. A
stream is a source of its own: it works out its detections anew from all it has seen,
so a detection that later rows have undone goes. Readers take the earliest of all
sources. Only the buckets of keys that change are written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldlake.schemas import FIRST_DETECTIONS
from fieldlake.session import stored
from fieldlake.sinks.folders import KeyedTable, Mark

KEYS = ["field_id", "disease"]
HISTORY = "history"


class FirstDetections:
    def __init__(self, spark: SparkSession, path: str, parts: int = 16):
        self.table = KeyedTable(spark, path, FIRST_DETECTIONS, KEYS, parts)

    def rows(self, without: str | None = None) -> DataFrame:
        """field_id, disease, started; of all sources but one when given."""
        held = self.table.rows()
        if without is not None:
            held = held.filter(F.col("source") != without)
        return held.groupBy(*KEYS).agg(F.min("started").alias("started"))

    def _of(self, source: str) -> DataFrame:
        return self.table.rows().filter(F.col("source") == source).select(*KEYS, F.col("started").alias("_known"))

    def merge(self, found: DataFrame, time: str = "slot", source: str = HISTORY, mark: Mark | None = None) -> bool:
        """Take in detections (field_id, disease, time) beside the earlier ones of the source. A batch that is in already changes nothing."""
        if self.table.applied(mark):
            return False
        first = found.groupBy(*KEYS).agg(F.min(time).alias("started"))
        fresh = first.join(self._of(source), KEYS, "left").filter(F.col("_known").isNull() | (F.col("started") < F.col("_known")))
        return self._put(fresh.drop("_known"), source, mark)

    def replace(self, found: DataFrame, source: str, time: str = "slot") -> bool:
        """All detections of a source, in place of those it had."""
        first = found.groupBy(*KEYS).agg(F.min(time).alias("started"))
        changed = first.join(self._of(source), KEYS, "full").filter(~F.col("started").eqNullSafe(F.col("_known")))
        return self._put(changed.drop("_known"), source, None)

    def _put(self, changes: DataFrame, source: str, mark: Mark | None) -> bool:
        changes = stored(changes.select(*KEYS, "started", F.lit(source).alias("source")), "first-detections")

        def combine(old: DataFrame, new: DataFrame) -> DataFrame:
            names = new.select(*[F.col(k).alias(f"_{k}") for k in KEYS], F.col("source").alias("_source"))
            same = F.col("source") == F.col("_source")
            for k in KEYS:
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            return old.join(names, same, "left_anti").unionByName(new.filter(F.col("started").isNotNull()))

        return False if changes.isEmpty() and mark is None else self.table.merge(changes, combine, mark)
