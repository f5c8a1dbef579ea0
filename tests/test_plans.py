"""Shapes of physical plans that scale depends on."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from fieldlake.sinks import tables as TS
from fieldlake.plans import registry


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def plan(spark, small, key):
    return plan_of(queries()[key](spark, small))


BATCH = ["infection_progress", "join_readings_weather", "join_fields_sensors", "permission_check", "semi_authorised",
         "stratified_split", "rain_spells", "dedupe_readings", "field_counts", "daily_field_summary", "dq_foreign_key",
         "dq_missing_slots", "join_labels_training", "dataset_summary", "colour_histogram", "rows_visible_to_user"]


@pytest.mark.parametrize("key", BATCH)
def test_no_cross_join_no_row_at_a_time_python(spark, small, key):
    text = plan(spark, small, key)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_rule_join_is_the_only_nested_loop_and_twelve_rows_wide(spark, small):
    assert plan(spark, small, "join_conditions_rules").count("BroadcastNestedLoopJoin") == 1


def test_flagship_needs_two_shuffles_and_one_column_of_fields(spark, small):
    text = plan_of(entry(spark))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
    assert "partial_avg" in text
    assert "FileScan parquet [c_custkey#" in text and "c_name" not in text


def test_row_limits_run_before_the_shuffle(spark, small):
    for key in ("dedupe_readings", "latest_per_sensor"):
        assert re.search(r"WindowGroupLimit .* Partial", plan(spark, small, key)), key
    users = spark.read.parquet(f"{small}/customer.parquet").selectExpr("c_custkey AS user_id", "c_name AS name", "c_custkey AS version")
    assert re.search(r"WindowGroupLimit .* Partial", plan_of(TS.upsert(users, users, "user_id", "version")))


def test_split_labels_rows_without_a_shuffle(spark, small):
    text = plan(spark, small, "stratified_split")
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_top_k_does_not_sort_the_table(spark, small):
    assert "TakeOrderedAndProject" in plan(spark, small, "latest_n_readings")


def test_filters_reach_the_scan(spark, small):
    assert "PushedFilters: [IsNotNull(n_nationkey), EqualTo(n_nationkey,7)]" in plan(spark, small, "scan_user")


def test_every_check_has_its_job():
    jobs, checks = registry.load()
    assert set(jobs) <= set(queries()) and set(checks) <= set(oracle_sql()) <= set(queries())
    assert set(jobs) == set(checks)


def test_queries_load_without_a_session():
    """The registry builds no column at import time, so it can be listed before Spark starts."""
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent)
