"""A run is stored once, wherever the job before was killed."""

import datetime as dt
from collections import Counter

import pytest

import veritable as v
from tests.helpers import WHEN
from veritable.plans import commits
from veritable.sources.files import Folder

RULES = [
    {"id": "small", "type": "min_max", "column": "n", "max": 5},
    {"id": "odd", "type": "sql_expression", "expression": "n % 2 = 1"},
    {"id": "set", "type": "not_null", "column": "n"},
]


class Killed(Exception):
    pass


@pytest.fixture
def job(spark, tmp_path):
    def run(run_id="a", when=WHEN, rules=RULES, rows=10, dataset="numbers", **destination):
        source = tmp_path / f"source-{rows}"
        if not source.exists():
            spark.range(rows).withColumnRenamed("id", "n").write.parquet(str(source))
        target = {"path": str(tmp_path / "out"), **destination}
        return v.run_job(spark, dataset, {"path": str(source), "format": "parquet"}, target, rules, run_id, when)

    return run


def stored(spark, tmp_path, fmt="parquet"):
    return Counter((r["run_id"], r["dataset"], r["rule_id"]) for r in v.read_history(spark, str(tmp_path / "out"), fmt).collect())


def once(*runs, rules=RULES):
    return Counter((run_id, dataset, rule["id"]) for run_id, dataset in runs for rule in rules)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
@pytest.mark.parametrize("where", ["before writing", "before the rename", "between removing and renaming", "after the rename"])
def test_a_killed_and_repeated_job_leaves_one_row_per_rule(spark, tmp_path, job, monkeypatch, fmt, where):
    job("b", format=fmt)
    job("a", format=fmt, rules=RULES[:2])  # what the killed job is to replace
    with monkeypatch.context() as patch:
        if where == "before writing":
            patch.setattr(commits, "write_table", lambda *a, **k: (_ for _ in ()).throw(Killed))
        elif where == "before the rename":
            patch.setattr(commits, "_publish", lambda *a: (_ for _ in ()).throw(Killed))
        elif where == "between removing and renaming":
            patch.setattr(Folder, "move", lambda *a: (_ for _ in ()).throw(Killed))
        else:
            move = Folder.move

            def moved(*args):
                move(*args)
                raise Killed

            patch.setattr(Folder, "move", moved)
        with pytest.raises(Killed):
            job("a", format=fmt)
    assert max(stored(spark, tmp_path, fmt).values()) == 1
    again = job("a", format=fmt)
    assert [r["rule_id"] for r in again.collect()] == ["small", "odd", "set"]
    assert stored(spark, tmp_path, fmt) == once(("a", "numbers"), ("b", "numbers"))
    assert not (tmp_path / "out" / "_staging").exists()
    summary = v.run_summary(v.read_history(spark, str(tmp_path / "out"), fmt)).collect()
    assert sorted((r["run_id"], r["failed_rules"], r["total_rules"]) for r in summary) == [("a", 2, 3), ("b", 2, 3)]


def test_the_last_attempt_counts_also_on_another_day(spark, tmp_path, job):
    job(rows=10)
    job(rows=4, when=WHEN + dt.timedelta(days=1))
    rows = v.read_history(spark, str(tmp_path / "out")).collect()
    assert {(r["run_date"], r["total_records"]) for r in rows} == {("2024-03-02", 4)}
    assert len(rows) == 3


def test_datasets_of_one_run_id_are_runs_of_their_own(spark, tmp_path, job):
    job(dataset="numbers")
    job(dataset="figures")
    job(dataset="numbers")
    assert stored(spark, tmp_path) == once(("a", "numbers"), ("a", "figures"))


@pytest.mark.parametrize("partition_by", [None, (), ("run_date", "status"), ("dataset",), ("column_name",)])
def test_any_partitioning(spark, tmp_path, job, partition_by):
    for rows in (10, 3, 10, 3):  # fewer rows pass more rules: partitions come and go
        job(rows=rows, partition_by=partition_by)
    rows = v.read_history(spark, str(tmp_path / "out")).collect()
    assert sorted((r["rule_id"], r["total_records"], r["status"]) for r in rows) == [("odd", 3, "FAIL"), ("set", 3, "PASS"), ("small", 3, "PASS")]
    job("b", rows=3, partition_by=partition_by)
    assert stored(spark, tmp_path) == once(("a", "numbers"), ("b", "numbers"))


def test_rows_appended_by_other_means_are_left_alone(spark, tmp_path, job):
    df = spark.range(10).withColumnRenamed("id", "n")
    v.write_table(v.evaluate(df, "numbers", RULES, "old", WHEN), str(tmp_path / "out"), partition_by=["run_date"])
    job()
    job()
    assert stored(spark, tmp_path) == once(("a", "numbers"), ("old", "numbers"))


def test_names_of_runs_do_not_run_into_each_other():
    assert commits.run_name("ab", "c") != commits.run_name("a", "bc")
