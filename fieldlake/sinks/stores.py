"""Hot and cold stores, routing, fallback with replay, and the generation log."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from fieldlake import schemas
from fieldlake.sinks.folders import FolderTable, Mark

COLD_TYPES = ["historical", "ml_training"]
COLD_BUCKETS = [T.StructField("data_type", T.StringType()), T.StructField("ingest_date", T.DateType())]
LOG_SCHEMA = "type string, record_count long, timestamp timestamp, status string"


def append_hot(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def cold_store(spark: SparkSession, path: str, schema: T.StructType) -> FolderTable:
    """The one cold layout, data_type=/ingest_date=, of batch jobs, streams and the archive.

    Readers prune by type and day; small files of a day are merged by ``compact``.
    """
    names = [b.name for b in COLD_BUCKETS]
    return FolderTable(spark, path, T.StructType([*(f for f in schema.fields if f.name not in names), *COLD_BUCKETS]), names)


def append_cold(rows: DataFrame, path: str, ingest_date, seen: Observation | None = None, kinds=(), mark: Mark | None = None) -> None:
    """Append to the cold layout.

    Rows of the given types are counted in the writing stage, where a retried task counts once.
    """
    dated = rows.withColumn("ingest_date", ingest_date)
    cold_store(rows.sparkSession, path, dated.schema).append(dated, mark, _counting(seen, kinds))


def _counting(seen: Observation | None, kinds) -> Callable[[DataFrame], DataFrame]:
    if seen is None:
        return lambda rows: rows
    return lambda rows: rows.observe(seen, *[F.count_if(F.col("data_type") == kind).alias(kind) for kind in kinds])


class SideStore:
    """Rows whose write failed, kept until they are replayed into their table.

    Each failed write is a numbered entry. An entry is kept once per batch of its
    writer; a replay carries the entry's number as its mark, so rows are neither lost
    nor doubled wherever a run stops.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.schema = schema
        self.table = FolderTable(spark, path, T.StructType([*schema.fields, T.StructField("entry", T.LongType())]), ["entry"])

    def waiting(self) -> list[int]:
        return sorted({int(f.split("/")[0].removeprefix("entry=")) for f in self.table.version().live})

    def keep(self, rows: DataFrame, mark: Mark | None = None) -> None:
        entry = self.table.version().marks.get("entries", -1) + 1
        self.table.append(rows.select(*self.schema.names).withColumn("entry", F.lit(entry).cast("long")), mark, notes=lambda: {"entries": entry})

    def kept(self, mark: Mark | None) -> bool:
        return self.table.applied(mark)

    def replay(self, target: FolderTable) -> int:
        """Move all entries to their table, oldest first; returns how many."""
        entries = self.waiting()
        for entry in entries:
            target.append(self.table.read().filter(F.col("entry") == entry).drop("entry"), ("replay", entry))
            self.table.drop([[str(entry)]])
        return len(entries)


def append_or_keep(rows: DataFrame, target: FolderTable, side: SideStore, mark: Mark | None = None,
                   watch: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> str:
    """Append to a table; when that store fails, keep the rows in the side store. Returns ``stored`` or ``fallback``.

    Entries that wait are replayed first, so a store that is back holds all rows again.
    """
    if side.kept(mark):
        return "fallback"
    try:
        if side.waiting():
            side.replay(target)
        target.append(rows, mark, watch)
        return "stored"
    except Exception as error:  # the store may fail in any way; the rows must not be lost
        print(f"store failed ({type(error).__name__}), rows are kept in {side.table.path}")
        side.keep(rows, mark)
        return "fallback"


def append_with_fallback(rows: DataFrame, path: str, fallback: str) -> str:
    """Append to a plain folder; when that store fails, append to the fallback. Returns the path used."""
    try:
        rows.write.mode("append").parquet(path)
        return path
    except Exception as error:  # the store may fail in any way; the rows must not be lost
        print(f"cold store failed ({type(error).__name__}), writing to fallback")
        rows.write.mode("append").parquet(fallback)
        return fallback


def _log(spark, path: str, kind: str, count: int, status: str) -> None:
    entry = [(kind, count, datetime.now(timezone.utc), status)]
    spark.createDataFrame(entry, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def append_logged(rows: DataFrame, kinds: list[str], path: str, log_path: str, ingest_date, fallback: str | None = None,
                  mark: Mark | None = None) -> dict[str, int]:
    """Cold append plus one log row per type with the true outcome; returns the counts.

    The counts are taken while writing, so the rows are not read twice. A type
    without rows is not logged. With ``fallback`` rows that the store refuses are kept
    there, logged as ``fallback``, and replayed by a later append.
    """
    seen, spark, status = Observation(), rows.sparkSession, "stored"
    try:
        if fallback is None:
            append_cold(rows, path, ingest_date, seen, kinds, mark)
        else:
            dated = rows.withColumn("ingest_date", ingest_date)
            target = cold_store(spark, path, dated.schema)
            side = SideStore(spark, fallback, target.schema)
            if side.kept(mark) or _reachable(target) and target.applied(mark):
                return {kind: 0 for kind in kinds}
            status = append_or_keep(dated, target, side, mark, _counting(seen, kinds))
            if status == "fallback":
                entry = side.table.read().filter(F.col("entry") == side.waiting()[-1])
                counts = {r[0]: r[1] for r in entry.groupBy("data_type").count().collect()}
                counts = {kind: counts.get(kind, 0) for kind in kinds}
    except Exception:
        for kind in kinds:
            _log(spark, log_path, kind, 0, "failed")
        raise
    counts = seen.get if status == "stored" else counts
    for kind in kinds:
        if counts[kind]:
            _log(spark, log_path, kind, counts[kind], status)
    return counts


def _reachable(table: FolderTable) -> bool:
    try:
        table.version()
        return True
    except Exception:
        return False


def route(rows: DataFrame, hot: str, cold: str, log_path: str, ingest_date, fallback: str | None = None) -> None:
    """Send rows by ``data_type``: realtime to the hot store and its cold archive,
    historical and ml_training to the cold store with a log row, others nowhere.

    Every row is worked out once: the archive is made from the rows as the hot store
    holds them, the rest from the input, whose type filter reaches the scan.
    """
    kind, spark = F.col("data_type"), rows.sparkSession
    hot_table = FolderTable(spark, hot, T.StructType([*rows.schema.fields, T.StructField("ingest_date", T.DateType())]), ["ingest_date"])
    live = hot_table.append(rows.filter(kind == "realtime").withColumn("ingest_date", ingest_date))
    archive = hot_table.load(live).drop("ingest_date").withColumn("data_type", F.lit("realtime_archive"))
    kept = rows.filter(kind.isin(COLD_TYPES)).select(*archive.columns)
    append_logged(kept.unionByName(archive), COLD_TYPES, cold, log_path, ingest_date, fallback)


def nested_readings(flat: DataFrame, weather: dict[str, str] | None = None, keep=()) -> DataFrame:
    """Flat readings in the nested archive form (fields of other sensor kinds are null), with further columns to keep.

    ``weather`` names the columns of the weather context where they differ from its fields.
    """
    names = set(flat.columns)

    def pick(schema, renames={}, kinds={}):
        def one(f):
            name = renames.get(f.name, f.name)
            value = F.col(name) if name in names else F.lit(None)
            return F.when(F.col("sensor_type") == kinds[f.name], value) if f.name in kinds else value

        return F.struct(*[one(f).cast(f.dataType).alias(f.name) for f in schema.fields])

    order = [f.name for f in schemas.READINGS.fields]
    kind_of = {n: "soil" if n in order[:7] else "atmospheric" for n in order if n != "temperature"}

    return flat.select(
        "event_id", F.col("sensor_id").cast("string"), F.col("field_id").cast("string"), "sensor_type", "timestamp",
        pick(schemas.LOCATION).alias("location"),
        pick(schemas.READINGS, {"cloud_coverage": "clouds"}, kind_of).alias("readings"),
        pick(schemas.WEATHER, {"wind_direction": "none", "clouds": "none"} | (weather or {})).alias("weather_context"), *keep,
    )


def write_json_archive(nested: DataFrame, path: str, rows_per_file: int = 50_000) -> None:
    """Archive files of the older form: one indented JSON array per file and date folder.

    Arrays hold consecutive ids, at most ``rows_per_file`` of them, so no group
    grows with the table.
    """
    record = F.struct(*[c for c in nested.columns if c != "event_id"])
    arrays = (
        nested.select(F.date_format("timestamp", "yyyyMMdd").alias("day"),
                      F.floor(F.col("event_id") / rows_per_file).alias("batch"), record.alias("r"))
        .groupBy("day", "batch").agg(F.collect_list("r").alias("rows"))
        .select("day", F.to_json("rows", {"pretty": "true", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"}).alias("value"))
    )
    arrays.write.option("maxRecordsPerFile", 1).partitionBy("day").option("compression", "none").text(path)
