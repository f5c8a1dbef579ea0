"""Upsert, insert-if-absent and the job ledger."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fieldlake import constants as K, schemas
from fieldlake.session import stored
from fieldlake.sinks.folders import KeyedTable, Mark


def upsert(old: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """New rows replace old ones of the same key; of several new ones the last version wins.

    The partial row limit keeps one row per key and task before the shuffle.
    """
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    order = Window.partitionBy(key).orderBy(F.col("_age").desc(), F.col(version).desc())
    return both.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1).drop("_n", "_age")


def checked_users(users: DataFrame) -> DataFrame:
    """Users with the permissions of their role; an unknown role fails the job."""
    pairs = [item for role, allowed in K.ROLE_PERMISSIONS.items()
             for item in (F.lit(role), F.array(*[F.lit(p) for p in allowed]))]
    allowed = F.try_element_at(F.create_map(*pairs), F.col("role"))
    unknown = F.raise_error(F.concat(F.lit("invalid role: "), F.coalesce("role", F.lit("null"))))
    return users.withColumn("permissions", F.coalesce(allowed, unknown.cast("array<string>")))


def absent_rows(new: DataFrame, old: DataFrame, key: str, tie: str) -> DataFrame:
    """New rows whose key is not stored yet; of equal new keys the first stays."""
    order = Window.partitionBy(key).orderBy(tie)
    first = new.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1).drop("_n")
    return first.join(old.select(key).distinct(), key, "left_anti")


def replace_rows(new: DataFrame, path: str, key: str, keys: DataFrame, parts: int = 64) -> KeyedTable:
    """Replace the rows of a stored table whose key is among ``keys``; the others stay.

    Only the buckets of those keys are read and written, and one version file switches to
    the new folders: a run that stops at any point leaves the old rows or the new ones.
    """
    table = KeyedTable(new.sparkSession, path, new.schema, [key], parts)
    table.replace(new, keys)
    return table


def upsert_users(table: KeyedTable, new: DataFrame, version: str, mark: Mark | None = None) -> bool:
    """Take users (without permissions) into the stored table; of one user the latest version wins,
    stored or new, so that batches may come in any order."""
    fresh = stored(checked_users(new), "users")

    def combine(old: DataFrame, changes: DataFrame) -> DataFrame:
        both = old.withColumn("_age", F.lit(0)).unionByName(changes.select(*old.columns).withColumn("_age", F.lit(1)))
        order = Window.partitionBy("user_id").orderBy(F.col(version).desc(), F.col("_age").desc())
        return both.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1).drop("_n", "_age")

    return table.merge(fresh, combine, mark)


class JobRun:
    """Handle given to the body of ``ledgered``; holds the row count to record."""

    records: int | None = None


def _entry(spark: SparkSession, path: str, **values) -> None:
    schema = schemas.RELATIONAL["batch_jobs"]
    row = tuple(values.get(f.name) for f in schema.fields)
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


@contextmanager
def ledgered(spark: SparkSession, path: str, job_name: str):
    """Record a run: a ``running`` row at the start, a final row at the end."""
    job_id, start, run = uuid.uuid4().hex, datetime.now(timezone.utc), JobRun()
    common = dict(job_id=job_id, job_name=job_name, start_time=start)
    _entry(spark, path, **common, status="running", created_at=start)
    status, message = "completed", None
    try:
        yield run
    except Exception as error:
        status, message = "failed", str(error)
        raise
    finally:
        end = datetime.now(timezone.utc)
        _entry(spark, path, **common, end_time=end, status=status, records_processed=run.records,
               error_message=message, created_at=end)


def latest_runs(ledger: DataFrame) -> DataFrame:
    """The latest state of each run: a final row beats the running row."""
    order = Window.partitionBy("job_id").orderBy(F.col("end_time").isNotNull().desc(), F.col("created_at").desc())
    return ledger.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1).drop("_n")
