"""Read, evaluate, write, read back."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

import veritable as v
from tests.helpers import WHEN, plan, scan_count

# Readings of weather stations; each rule below counts something else.
READINGS = """\
station,hour,celsius,humidity,sky,note
N1,0,4.5,81,clear,  padded
N1,1,3.9,84,clear,
N2,0,-2.0,,fog,x
N2,1,-61.5,70,fog,x
N2,2,1.0,140,storm,x
S4,0,22.5,35,clear,x
S4,1,23.0,31,haze,x
"""

RULES = [
    {"id": "sky_is_known", "type": "allowed_values", "column": "sky", "values": ["clear", "fog", "rain"]},
    {
        "id": "no_station_is_alone",
        "type": "custom_sql",
        "severity": "warning",
        "query": "SELECT station FROM readings GROUP BY station HAVING COUNT(*) < 3; -- one row per station",
    },
    {"id": "possible_heat", "type": "min_max", "column": "celsius", "min": -60, "max": 60},
    {"id": "station_code", "type": "regex", "column": "station", "pattern": "^N"},
    {"id": "dry_when_warm", "type": "sql_expression", "expression": "celsius < 20 OR humidity < 34"},
    {"id": "wet_enough", "type": "min_max", "column": "humidity", "max": 100, "severity": "warning"},
]
EXPECTED = [2, 2, 1, 2, 1, 2]


SCHEMA = "station STRING, hour INT, celsius DOUBLE, humidity INT, sky STRING, note STRING"


@pytest.fixture
def source(tmp_path):
    (tmp_path / "readings.csv").write_text(READINGS)
    return {"path": str(tmp_path / "readings.csv"), "schema": SCHEMA}


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_job(spark, source, tmp_path, fmt):
    destination = {"path": str(tmp_path / "out"), "format": fmt}
    results = v.run_job(spark, "readings", source, destination, RULES)
    rows = results.collect()
    assert [r["rule_id"] for r in rows] == [r["id"] for r in RULES]
    assert [r["failed_records"] for r in rows] == EXPECTED
    assert results.columns == v.RESULT_SCHEMA.fieldNames()
    assert v.read_history(spark, destination["path"], fmt).count() == len(RULES)
    assert len(list((tmp_path / "out").glob("run_date=*"))) == 1


def test_runs_accumulate_and_each_returns_its_own(spark, source, tmp_path):
    destination = {"path": str(tmp_path / "out")}
    first = v.run_job(spark, "readings", source, destination, RULES, "a", WHEN)
    second = v.run_job(spark, "readings", source, destination, RULES[:3], "b", WHEN + dt.timedelta(days=1))
    assert (first.count(), second.count()) == (6, 3)
    history = v.read_history(spark, destination["path"])
    assert history.count() == 9
    assert {r["run_id"] for r in v.latest_run(history).collect()} == {"b"}
    assert tuple(v.severity_gate(first).first()) == (4, True)


def test_results_are_read_back_not_evaluated_again(spark, source, tmp_path):
    results = v.run_job(spark, "readings", source, {"path": str(tmp_path / "out")}, RULES)
    assert scan_count(results) == 1
    shown = plan(results)
    assert "readings.csv" not in shown
    assert "PartitionFilters: [isnotnull(run_date" in shown


def test_overwrite_and_unpartitioned(spark, source, tmp_path):
    destination = {"path": str(tmp_path / "out"), "write_mode": "overwrite", "partition_by": None}
    for _ in range(2):
        assert v.run_job(spark, "readings", source, destination, RULES).count() == len(RULES)
    assert v.read_history(spark, destination["path"]).count() == len(RULES)


def test_ignore_mode_still_returns_results(spark, source, tmp_path):
    destination = {"path": str(tmp_path / "out"), "write_mode": "ignore"}
    for _ in range(2):
        assert v.run_job(spark, "readings", source, destination, RULES).count() == len(RULES)
    assert v.read_history(spark, destination["path"]).count() == len(RULES)


def test_one_bad_rule_writes_nothing(spark, source, tmp_path):
    bad = {"id": "bad", "type": "not_null", "column": "absent"}
    with pytest.raises(AnalysisException):
        v.run_job(spark, "readings", source, {"path": str(tmp_path / "out")}, [*RULES, bad])
    assert not (tmp_path / "out").exists()


def test_rules_are_required(spark, source, tmp_path):
    with pytest.raises(ValueError, match="at least one rule"):
        v.run_job(spark, "readings", source, {"path": str(tmp_path / "out")}, [])


def test_formats_are_checked_before_the_work(spark, source, tmp_path):
    with pytest.raises(ValueError, match="Unsupported format"):
        v.run_job(spark, "readings", source, {"path": str(tmp_path / "out"), "format": "orc"}, RULES)
    with pytest.raises(ValueError, match="Unsupported format"):
        v.run_job(spark, "readings", {**source, "format": "xml"}, {"path": str(tmp_path / "out")}, RULES)


def test_inferred_schema(spark, source, tmp_path):
    rows = v.run_job(spark, "readings", {"path": source["path"]}, {"path": str(tmp_path / "out")}, RULES).collect()
    assert [r["failed_records"] for r in rows] == EXPECTED


@pytest.mark.parametrize("later", [dt.timedelta(0), dt.timedelta(minutes=5)])
def test_a_retry_returns_one_row_per_rule(spark, source, tmp_path, later):
    destination = {"path": str(tmp_path / "out")}
    first = v.run_job(spark, "readings", source, destination, RULES, "same", WHEN)
    gate = tuple(v.severity_gate(first).first())
    again = v.run_job(spark, "readings", source, destination, RULES, "same", WHEN + later)
    assert [r["rule_id"] for r in again.collect()] == [r["id"] for r in RULES]
    assert tuple(v.severity_gate(again).first()) == gate
    assert v.read_history(spark, destination["path"]).count() == len(RULES)


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_text_survives_every_format(spark, source, tmp_path, fmt):
    described = [{**RULES[0], "description": text, "id": f"r{i}"} for i, text in enumerate(["  padded  ", "tab\t", 'a "q"', "two\nlines", ""])]
    destination = {"path": str(tmp_path / "out"), "format": fmt}
    stored = v.run_job(spark, "readings", source, destination, described, " run 1 ", WHEN).collect()
    assert [r["description"] for r in stored] == [r["description"] for r in described]
