"""Compacting a history: fewer files, the same rows, at every moment."""

import datetime as dt
from collections import Counter

import pytest

import veritable as v
from tests.helpers import WHEN, scan_count
from veritable.plans import compaction
from veritable.sources.files import Folder

RULES = [{"id": f"r{i}", "type": "min_max", "column": "n", "max": i} for i in range(3)]


def commit(spark, path, run_id, day=0, fmt="parquet", dataset="d", rows=5, partition_by=("run_date",)):
    results = v.evaluate(spark.range(rows).withColumnRenamed("id", "n"), dataset, RULES, run_id, WHEN + dt.timedelta(days=day))
    v.commit_run(results, path, dataset, run_id, fmt, partition_by)


def rows(spark, path, fmt="parquet"):
    return Counter((r["run_id"], r["dataset"], r["rule_id"], r["total_records"]) for r in v.read_history(spark, path, fmt).collect())


def files(path, kind="*"):
    return sorted(str(p.relative_to(path)) for p in path.glob(f"run_date=*/{kind}") if not p.name.startswith((".", "_")))


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_the_rows_stay_and_the_files_become_one_a_date(spark, tmp_path, fmt):
    path = str(tmp_path)
    for run, day in (("a", 0), ("b", 0), ("c", 1), ("d", 1), ("e", 2)):
        commit(spark, path, run, day, fmt)
    before = rows(spark, path, fmt)
    assert v.compact_history(spark, path, fmt) == 4
    assert rows(spark, path, fmt) == before
    commit(spark, path, "f", 1, fmt)
    after = rows(spark, path, fmt)
    assert len(after) == len(before) + 3
    assert v.compact_history(spark, path, fmt) == 2  # the compacted file of that day, and the new one
    assert v.compact_history(spark, path, fmt) == 0
    assert rows(spark, path, fmt) == after and len(files(tmp_path)) == 3
    assert not (tmp_path / "_staging").exists() or not any((tmp_path / "_staging").iterdir())


def test_a_run_repeated_after_compaction_counts_once(spark, tmp_path):
    path = str(tmp_path)
    for run, dataset in (("a", "d"), ("a", "other"), ("b", "d")):
        commit(spark, path, run, dataset=dataset)
    v.compact_history(spark, path)
    commit(spark, path, "a", rows=9)
    found = rows(spark, path)
    assert {(r[0], r[1], r[3]) for r in found} == {("a", "d", 9), ("a", "other", 5), ("b", "d", 5)} and max(found.values()) == 1
    commit(spark, path, "a", day=3, rows=7)
    v.compact_history(spark, path)
    commit(spark, path, "b")
    found = rows(spark, path)
    assert {(r[0], r[1], r[3]) for r in found} == {("a", "d", 7), ("a", "other", 5), ("b", "d", 5)} and max(found.values()) == 1


class Killed(Exception):
    pass


@pytest.mark.parametrize("after", range(5))
def test_readers_see_each_row_once_wherever_a_compaction_stops(spark, tmp_path, monkeypatch, after):
    path = str(tmp_path)
    for run, day in (("a", 0), ("b", 0), ("c", 1), ("d", 1)):
        commit(spark, path, run, day)
    expected = rows(spark, path)
    move, moves = Folder.move, []

    def moved(self, name, to):
        assert rows(spark, path) == expected  # also while it goes on
        if len(moves) == after:
            raise Killed
        moves.append(to)
        move(self, name, to)
        assert rows(spark, path) == expected

    with monkeypatch.context() as patch:
        patch.setattr(Folder, "move", moved)
        try:
            v.compact_history(spark, path)
        except Killed:
            pass
    assert rows(spark, path) == expected
    v.compact_history(spark, path)
    v.compact_history(spark, path)
    assert rows(spark, path) == expected


def test_a_reader_that_started_before_keeps_its_files(spark, tmp_path):
    path = str(tmp_path)
    for run in "abc":
        commit(spark, path, run)
    early = v.read_history(spark, path)
    v.compact_history(spark, path)
    assert early.count() == 9 and v.read_history(spark, path).count() == 9


def test_dates_that_are_not_over_are_left_alone(spark, tmp_path):
    path = str(tmp_path)
    for run, day in (("a", 0), ("b", 0), ("c", 1), ("d", 1)):
        commit(spark, path, run, day)
    assert v.compact_history(spark, path, before="2024-03-02") == 2
    assert len(files(tmp_path, "run-*")) == 4 and len(files(tmp_path, "compact-*")) == 1
    assert len(rows(spark, path)) == 12


@pytest.mark.parametrize("partition_by", [(), ("run_date", "status")])
def test_other_layouts(spark, tmp_path, partition_by):
    path = str(tmp_path)
    for run in "abc":
        commit(spark, path, run, partition_by=partition_by)
    before = rows(spark, path)
    assert v.compact_history(spark, path, partition_by=partition_by) >= 3
    assert rows(spark, path) == before
    commit(spark, path, "b", partition_by=partition_by)
    assert rows(spark, path) == before


def test_many_runs(spark, tmp_path):
    """Files written by hand stand for runs; one job makes one file of them."""
    path = str(tmp_path)
    results = v.evaluate(spark.range(3).withColumnRenamed("id", "n"), "d", RULES, "x", WHEN)
    many = spark.range(400).crossJoin(results.drop("run_id")).selectExpr("concat('run', id) AS run_id", "*").drop("id")
    v.write_table(many.select(*v.RESULT_SCHEMA.fieldNames()), path, partition_by=["run_date"], num_files=400)
    assert len(files(tmp_path)) > 100
    v.compact_history(spark, path)
    assert len(files(tmp_path, "compact-*")) == 1 and sum(rows(spark, path).values()) == 1200
    v.compact_history(spark, path)
    assert len(files(tmp_path)) == 1


def test_the_latest_run_reads_one_partition(spark, tmp_path):
    path = str(tmp_path)
    for run, day in (("a", 0), ("b", 2), ("c", 1)):
        commit(spark, path, run, day)
    for _ in range(2):
        latest = v.latest_stored_run(spark, path)
        assert {r["run_id"] for r in latest.collect()} == {"b"} and latest.count() == 3
        assert all("run_date=2024-03-03" in name for name in latest.inputFiles()) and scan_count(latest) >= 1
        commit(spark, path, "d", 0)
        v.compact_history(spark, path)
    assert v.latest_stored_run(spark, str(tmp_path / "nothing")).count() == 0
    assert compaction.read_manifest(Folder(spark, str(tmp_path / "nothing"))) is None
