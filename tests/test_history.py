"""Results over several runs: order, top, latest, summary, gate."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

import veritable as v
from tests.helpers import plan

DAY1 = dt.datetime(2024, 1, 1, 8, 0, 0, 250123, tzinfo=dt.timezone.utc)
DAY2 = DAY1 + dt.timedelta(days=1)


def store(spark, path, fmt="parquet", partition_by=("run_date",)):
    numbers = spark.createDataFrame([(1,), (2,), (None,)], "x INT")
    present = {"id": "present", "type": "not_null", "column": "x", "description": 'say "no",\nthen go'}
    ranged = {"id": "ranged", "type": "min_max", "column": "x", "max": 9, "severity": "warning"}
    anything = {"id": "anything", "type": "sql_expression", "expression": "true"}
    runs = [
        ("r1", DAY1, "numbers", [present, ranged, anything]),
        ("r3", DAY2, "numbers", [ranged, anything]),
        ("r2", DAY2, "others", [anything]),
    ]
    for run_id, when, dataset, rules in runs:
        results = v.evaluate(numbers, dataset, rules, run_id, when)
        v.write_table(results, path, fmt, partition_by=partition_by)


ORDER = [
    ("r3", "FAIL", "ranged"),
    ("r2", "PASS", "anything"),
    ("r3", "PASS", "anything"),
    ("r1", "FAIL", "present"),
    ("r1", "FAIL", "ranged"),
    ("r1", "PASS", "anything"),
]


def keys(df):
    return [(r["run_id"], r["status"], r["rule_id"]) for r in df.collect()]


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("history") / "t")
    store(spark, path)
    return v.read_history(spark, path)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
@pytest.mark.parametrize("partition_by", [("run_date",), None])
def test_read_back_is_what_was_written(spark, tmp_path, fmt, partition_by):
    path = str(tmp_path / "t")
    store(spark, path, fmt, partition_by)
    history = v.read_history(spark, path, fmt)
    assert [(f.name, f.dataType) for f in history.schema] == [(f.name, f.dataType) for f in v.RESULT_SCHEMA]
    assert keys(history) == ORDER
    rows = {(r["run_id"], r["rule_id"]): r for r in history.collect()}
    assert rows["r1", "present"]["description"] == 'say "no",\nthen go'
    assert rows["r1", "ranged"]["description"] == ""
    assert rows["r1", "anything"]["column_name"] is None
    assert rows["r1", "ranged"]["run_date"] == "2024-01-01"
    assert rows["r1", "ranged"]["pass_rate"] == 2 / 3
    moments = history.selectExpr("unix_micros(run_timestamp) AS t").distinct().orderBy("t").collect()
    assert [r["t"] for r in moments] == [int(d.timestamp()) * 1_000_000 + 250123 for d in (DAY1, DAY2)]


def test_only_one_dataset(spark, tmp_path):
    path = str(tmp_path / "t")
    store(spark, path)
    assert keys(v.read_history(spark, path, dataset="others")) == [("r2", "PASS", "anything")]
    assert v.read_history(spark, path, dataset="nope").count() == 0


def test_top(history):
    assert keys(v.top_history(history, 2)) == ORDER[:2]
    assert keys(v.top_history(history)) == ORDER


def test_latest_run_follows_the_history_order(history):
    # Two runs share the newest timestamp: the one with a failure comes first.
    assert keys(v.latest_run(history)) == [ORDER[0], ORDER[2]]


def test_latest_run_of_nothing(spark, history):
    nothing = spark.createDataFrame([], v.RESULT_SCHEMA)
    assert v.latest_run(nothing).count() == 0
    assert v.latest_run(history.filter("run_id = 'none'")).count() == 0


def test_missing_path_is_sparks_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        v.read_history(spark, str(tmp_path / "absent"))


def test_run_summary(history):
    rows = {tuple(r) for r in v.run_summary(history).collect()}
    assert rows == {("r1", "numbers", 2, 3), ("r3", "numbers", 1, 2), ("r2", "others", 0, 1)}


def test_gate_blocks_on_errors_only(history):
    def gate(run):
        return tuple(v.severity_gate(history.filter(f"run_id = '{run}'")).first())

    assert gate("r1") == (1, True)
    # Its only failure is a warning.
    assert gate("r3") == (0, False)
    assert gate("r2") == (0, False)
    assert gate("none") == (0, False)


def test_reports_do_not_sort_twice(history):
    top = plan(v.top_history(history, 3))
    assert "TakeOrderedAndProject" in top
    assert "rangepartitioning" not in top
    assert "rangepartitioning" not in plan(v.run_summary(history))


def test_one_dataset_is_filtered_at_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    store(spark, path)
    assert "EqualTo(dataset,others)" in plan(v.read_history(spark, path, dataset="others"))


def test_latest_run_finds_its_row_in_one_pass(spark, history, tmp_path):
    v.write_table(history, str(tmp_path / "stored"), partition_by=["run_date"])
    latest = v.latest_run(v.read_history(spark, str(tmp_path / "stored")))
    assert keys(latest) == [ORDER[0], ORDER[2]]
    assert "PartitionFilters: [isnotnull(run_date" in plan(latest)
    # Once it has run, the plan shows the second use of the subquery as that.
    latest.collect()
    assert plan(latest).count("ReusedSubquery") >= 1
