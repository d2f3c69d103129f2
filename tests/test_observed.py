"""Checks that ride on the caller's own write."""

import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import veritable as v
from tests.helpers import plan, scan_count

RULES = [
    {"id": "set", "type": "not_null", "column": "x"},
    {"id": "small", "type": "min_max", "column": "x", "max": 5},
    {"id": "even", "type": "sql_expression", "expression": "x % 2 = 0"},
]


@pytest.fixture
def data(spark, tmp_path):
    spark.range(20).select(F.expr("nullif(id, 3)").alias("x"), F.lit("t").alias("t")).write.parquet(str(tmp_path / "data"))
    return v.read_table(spark, str(tmp_path / "data"), "parquet")


def facts(results):
    return [(r["rule_id"], r["total_records"], r["failed_records"], r["passed_records"], r["status"]) for r in results.collect()]


def test_the_write_yields_the_results(spark, data, tmp_path):
    suite = v.CheckSuite("data", RULES)
    watch = v.Watch(suite, data)
    v.write_table(watch.rows, str(tmp_path / "out"))
    results = watch.results()
    assert facts(results) == facts(suite.evaluate(data))
    assert results.columns == v.RESULT_SCHEMA.fieldNames() and results.first()["run_id"] == suite.run_id
    assert scan_count(results) == 0 and v.read_table(spark, str(tmp_path / "out"), "parquet").count() == 20


def test_write_and_counts_share_one_scan(data):
    watch = v.Watch(v.CheckSuite("data", RULES), data)
    assert scan_count(watch.rows) == 1 and "CollectMetrics" in plan(watch.rows) and "Exchange" not in plan(watch.rows)


def test_an_empty_write(spark, data, tmp_path):
    watch = v.Watch(v.CheckSuite("data", RULES), data.where("x > 100"))
    v.write_table(watch.rows, str(tmp_path / "out"))
    assert [f[1:] for f in facts(watch.results())] == [(0, 0, 0, "PASS")] * 3


def test_rules_of_the_whole_dataset_are_refused(data):
    with pytest.raises(ValueError, match="once"):
        v.Watch(v.CheckSuite("data", [{"id": "once", "type": "unique", "column": "x"}]), data)


def test_a_task_that_fails_and_runs_again_counts_once(tmp_path):
    script = f"""
        from pyspark import TaskContext
        from pyspark.sql import SparkSession
        import veritable as v

        spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").config("spark.log.level", "OFF").getOrCreate())

        def flaky(batches):
            seen = 0
            for batch in batches:
                seen += batch.num_rows
                yield batch
            if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2 == 0:
                raise RuntimeError("lost after all rows went by")

        df = spark.range(0, 1000, 1, 6)
        watch = v.Watch(v.CheckSuite("data", [{{"id": "low", "type": "min_max", "column": "id", "max": 599}}]), df)
        watch.rows.mapInArrow(flaky, "id long").write.parquet({str(tmp_path / "out")!r})
        row = watch.results().first()
        print("COUNTS", row["total_records"], row["failed_records"])
        spark.stop()
    """
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], cwd=root, capture_output=True, text=True, timeout=240)
    assert "COUNTS 1000 400" in done.stdout, done.stderr[-2000:]
