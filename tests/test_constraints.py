"""Declared constraints: every rule, repeated and missing keys, one scan per table."""

import re

import pytest
from pyspark.sql import functions as F

from fieldlake import schemas
from fieldlake.functions import weather as W
from fieldlake.operators import constraints as C
from fieldlake.plans import quality
from fieldlake.sources import domain as V

ROWS = "k string, name string, n double"


def found(spark, rows, rules):
    return sorted(tuple(r) for r in C.violations(spark.createDataFrame(rows, ROWS), rules).collect())


def test_each_rule_and_the_key(spark):
    rules = C.Constraints(("k",), ("name",), {"k": 3, "name": 4}, (("n", 0.0, 9.0),))
    rows = [("a", "ok", 1.0), ("b", None, -1.0), ("b", "long one", 10.0), (None, "x", None), (None, "y", 3.0), ("four", "four", 9.0), ("c", "five5", float("nan"))]
    assert found(spark, rows, rules) == [
        ("b", "k", "primary_key", 2), ("b", "n", "range", 2), ("b", "name", "length", 1), ("b", "name", "not_null", 1), ("c", "n", "range", 1),
        ("c", "name", "length", 1), ("four", "k", "length", 1), ("null", "k", "not_null", 2)]
    assert found(spark, [], rules) == [] and found(spark, [("a", "ok", 1.0)], rules) == []


def test_keys_of_several_columns(spark):
    rules = C.Constraints(("k", "name"))
    rows = [("a", "x", 0.0), ("a", "x", 1.0), ("a", "y", 0.0), ("a", None, 0.0), ("a", None, 0.0)]
    assert found(spark, rows, rules) == [("a|null", "name", "not_null", 2), ("a|x", "k,name", "primary_key", 2)]


def test_rules_without_a_column_fail(spark):
    with pytest.raises(ValueError, match="other"):
        C.violations(spark.createDataFrame([], ROWS), C.Constraints(("k",), ("other",)))


def test_every_declared_table_has_rules_for_columns_it_has():
    assert set(schemas.RELATIONAL) == set(schemas.TEXT_LENGTHS) == set(schemas.PRIMARY_KEYS) == set(schemas.REQUIRED)
    for name, schema in schemas.RELATIONAL.items():
        assert C.declared(name).columns() <= set(schema.names)


def test_one_scan_per_table_and_one_shuffle(spark, small, tmp_path):
    tables = {}
    for name, rows in V.relational_tables(spark, small).items():
        rows.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.schema(schemas.RELATIONAL[name]).parquet(str(tmp_path / name))
    plan = C.declared_violations(tables)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan parquet", plan)) == 4 and len(re.findall(r"Exchange hashpartitioning", plan)) == 4
    assert quality.flawed_tables(spark, small).keys() == tables.keys()


def test_an_answer_is_parsed_once(spark, small):
    from fieldlake.plans.scans import weather_payload_normalise

    plan = weather_payload_normalise(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    rows = spark.createDataFrame([("{}",), (None,), ('{"main": {"temp": 1}, "wind": {}, "clouds": {}}',)], "t string")
    assert W.normalised_payloads(rows, "t", schemas.WEATHER_PAYLOAD).select(F.col("p.main.temp")).collect() == [(1.0,)]


def test_a_task_holds_a_bounded_number_of_keys(spark, small):
    """More rows are more tasks, whatever the width of the shuffle; nothing is held before keys are dealt."""
    rows = spark.range(2_000_000).select(F.col("id").cast("string").alias("k"), F.lit("long one").alias("name"))
    found = C.violations(rows, C.Constraints(("k",), (), {"name": 4}))
    per = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per) == 2_000_000 and max(per) < 300_000
    for held in (found, V.relational_tables(spark, small)["analytics_summary"]):
        below = held._jdf.queryExecution().executedPlan().toString().split("REPARTITION_BY_NUM")[1]
        assert "HashAggregate" not in below
