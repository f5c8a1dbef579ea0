"""The query registry."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from fieldlake.session import configure

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {}
CHECKS: dict[str, str] = {}

MODULES = ["scans", "sinks", "scalars", "quality", "joins", "aggregates", "windows", "pixels", "streams"]


def query(key: str, sql: str | None = None) -> Callable[[Job], Job]:
    """Register a job under its key, with the SQL that must give the same rows."""

    def add(job: Job) -> Job:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return job(configure(spark), folder)

        JOBS[key] = run
        if sql is not None:
            CHECKS[key] = sql
        return job

    return add


def load() -> tuple[dict[str, Job], dict[str, str]]:
    for module in MODULES:
        import_module(f"fieldlake.plans.{module}")
    return JOBS, CHECKS
