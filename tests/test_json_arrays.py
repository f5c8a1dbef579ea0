"""Large JSON arrays in byte ranges: any layout, hostile strings, records across borders."""

import json
import random

import pytest
from pyspark.sql import functions as F

from fieldlake.sources import json_arrays as JA

ODD = ['}', '{', '},{', '}, {', '"', '\\', '\\"', '[{"a": "}"}]', '\n}\n', 'plain', '', '{{{{', '}}}}', '\\\\"}', 'é}ü{']


@pytest.fixture
def small_ranges(spark):
    """Byte ranges far smaller than a record's neighbours, so that every border is met."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for k, v in old.items():
        spark.conf.set(k, v.removesuffix("b"))


def odd_records(n, seed=1):
    rng = random.Random(seed)
    pick = lambda: "".join(rng.choices(ODD, k=rng.randrange(4)))
    return [{"n": i, "text": pick(), pick() or "key": {"in": [pick(), {"deep": pick()}], "empty": {}}, "list": [{}, {"x": pick()}]} for i in range(n)]


def read(spark, path):
    return sorted((json.loads(r.text) for r in JA.records(spark, str(path)).collect()), key=lambda r: r["n"])


@pytest.mark.parametrize("indent", [None, 2, "pretty"])
def test_arrays_in_any_layout(spark, small_ranges, tmp_path, indent):
    """Every record comes back as it was, whatever its strings hold, from one file and from many."""
    rows = odd_records(150)
    text = json.dumps(rows, indent=None if indent == "pretty" else indent, ensure_ascii=False)
    if indent == "pretty":  # records joined on one line
        text = "[ " + ", ".join(json.dumps(r, indent=1) for r in rows) + " ]"
    (tmp_path / "a.json").write_text(text)
    ranges = spark.read.option("lineSep", "}").text(str(tmp_path)).select("_metadata.file_block_start").distinct().count()
    assert ranges > 10
    assert read(spark, tmp_path) == rows


def test_many_files_long_records_and_rests(spark, small_ranges, tmp_path):
    """A record longer than many ranges, single objects, empty arrays and files, a file that breaks off."""
    rows = odd_records(30) + [{"n": 1000, "text": "}{\"" * 3000}] + [{**r, "n": r["n"] + 2000} for r in odd_records(30, 2)]
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text(json.dumps({"n": 5000, "text": "}"}))
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text("")
    (tmp_path / "e.json").write_text(json.dumps([{"n": 6000}, {"n": 6001, "text": "abc"}])[:-8])
    (tmp_path / "f.json").write_text("\n".join(json.dumps({"n": 7000 + i}) for i in range(3)))
    (tmp_path / "g.txt").write_text("[{}]")
    assert [r["n"] for r in read(spark, tmp_path)] == [r["n"] for r in rows] + [5000, 6000, 7000, 7001, 7002]
    assert [r for r in read(spark, tmp_path) if r["n"] < 5000] == rows


def test_files_in_blocks(spark, small_ranges, tmp_path, monkeypatch):
    monkeypatch.setattr(JA, "BLOCK_RANGES", 10)
    want = []
    for f in range(5):
        rows = [{**r, "n": r["n"] + 100 * f} for r in odd_records(40, f)]
        (tmp_path / f"{f}.json").write_text(json.dumps(rows, indent=2))
        want += rows
    assert read(spark, tmp_path) == want


def test_a_large_array_is_read_by_many_tasks(spark, tmp_path):
    record = json.dumps({"sensor_id": "S{1}", "readings": {"moisture": 1.5, "note": "}" * 40}})
    (tmp_path / "big.json").write_text("[" + ",".join([record] * 250_000) + "]")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        rows = JA.records(spark, str(tmp_path))
        per = rows.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in per) == 250_000 and len(per) >= 20
        assert max(r["count"] for r in per) < 25_000
        assert rows.select("text").distinct().count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old.removesuffix("b"))


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_files_of_one_range_are_cut_in_one_pass(spark, tmp_path, batch):
    """Nothing is summed up for them, whatever batches their pieces come in; one file breaks off, one has a rest."""
    want = [{**r, "n": r["n"] + 1000 * f} for f in range(3) for r in odd_records(60, f)]
    for f in range(3):
        (tmp_path / f"{f}.json").write_text(json.dumps([r for r in want if r["n"] // 1000 == f], ensure_ascii=False, indent=f or None) + "\n")
    (tmp_path / "off.json").write_text(json.dumps([{"n": 9000, "text": "\\\\}"}, {"n": 9001, "in": {}}])[:-2])
    (tmp_path / "rest.json").write_text('{"n": 9500} {"n": 9501, "text": "}')
    (tmp_path / "empty.json").write_text("")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        assert read(spark, tmp_path) == [*want, {"n": 9000, "text": "\\\\}"}, {"n": 9500}]
        plan = JA.records(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "Window" not in plan
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
        spark.conf.unset("spark.sql.files.minPartitionNum")
