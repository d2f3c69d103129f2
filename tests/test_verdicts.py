"""Which rules every row fails, from one scan; good and bad rows."""

import pytest

import veritable as v
from tests.helpers import plan, scan_count, verdicts

ROWS = [(1, "a", 5.0), (2, "b", None), (2, "a", 50.0), (None, None, -1.0), (None, "c", 7.0), (3, "zz", 9.0)]
RULES = [
    {"id": "key", "type": "unique", "column": "k"},
    {"id": "value", "type": "min_max", "column": "x", "min": 0, "max": 10},
    {"id": "text", "type": "regex", "column": "t", "pattern": "^.$"},
    {"id": "text_once", "type": "unique", "column": "t", "digest": True},
    {"id": "either", "type": "sql_expression", "expression": "k > 1 OR x < 8"},
    {"id": "not_below", "type": "sql_expression", "expression": "x >= (SELECT min(x) + 5 FROM data)"},
]


@pytest.fixture
def data(spark):
    return spark.createDataFrame(ROWS, "k int, t string, x double")


@pytest.mark.parametrize("stored", [False, True])
def test_verdicts(spark, data, tmp_path, stored):
    suite = v.CheckSuite("data", RULES)
    keys = str(tmp_path / "keys") if stored else None
    rows = suite.verdicts(data, keys).collect()
    assert sorted((str(r[:3]), r["failed_rules"]) for r in rows) == sorted(
        (str(row), failed)
        for row, failed in [
            ((1, "a", 5.0), ["text_once"]),
            ((2, "b", None), ["key", "value", "not_below"]),
            ((2, "a", 50.0), ["key", "value", "text_once"]),
            ((None, None, -1.0), ["key", "value", "text", "not_below"]),
            ((None, "c", 7.0), ["key"]),
            ((3, "zz", 9.0), ["text"]),
        ]
    )


def test_counts_equal_those_of_the_suite(spark, data):
    suite = v.CheckSuite("data", RULES)
    rows = suite.all_failing_rows(data).collect()
    counted = {rule["id"]: sum(rule["id"] in r["failed_rules"] for r in rows) for rule in RULES}
    assert counted == {rule_id: r["failed_records"] for rule_id, r in verdicts(data, RULES).items()}


def test_one_scan_for_all_row_level_rules(spark, data, tmp_path):
    data.write.parquet(str(tmp_path / "data"))
    stored = v.read_table(spark, str(tmp_path / "data"), "parquet")
    row_level = [rule for rule in RULES[:5] if rule["type"] != "unique"]
    shown = v.CheckSuite("data", row_level).all_failing_rows(stored)
    assert scan_count(shown) == 1 and "Exchange" not in plan(shown)
    assert scan_count(v.CheckSuite("data", RULES[:5]).verdicts(stored)) == 3


def test_split(spark, data, tmp_path):
    suite = v.CheckSuite("data", [*RULES[:3], {"id": "high", "type": "min_max", "column": "x", "max": 100}])
    good, bad = suite.split_rows(data, str(tmp_path / "split"))
    assert good.columns == data.columns and bad.columns == [*data.columns, "failed_rules"]
    assert [tuple(r) for r in good.collect()] == [(1, "a", 5.0)]
    assert good.count() + bad.count() == len(ROWS)
    assert scan_count(good) == scan_count(bad) == 1 and "data" not in plan(good).split("Location")[0]
    for empty, where in ((good, "k < 0"), (bad, "k = 1")):
        parts = suite.split_rows(data.where(where), str(tmp_path / f"split-{where}"))
        assert sorted(part.count() for part in parts) == ([0, 0] if where == "k < 0" else [0, 1])


def test_a_hot_value_and_repeated_rows(spark):
    df = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k").unionByName(spark.range(1).selectExpr("1L AS k"))
    failing = v.CheckSuite("d", [{"id": "once", "type": "unique", "column": "k"}]).all_failing_rows(df)
    assert failing.count() == 3002


def test_refusals(spark, data):
    with pytest.raises(ValueError, match="custom_sql"):
        v.CheckSuite("data", [{"id": "q", "type": "custom_sql", "query": "SELECT 1"}]).verdicts(data)
    with pytest.raises(ValueError, match="failed_rules"):
        v.CheckSuite("data", RULES[:1]).verdicts(data.withColumnRenamed("t", "failed_rules"))
    assert v.CheckSuite("data", []).verdicts(data).where("size(failed_rules) = 0").count() == len(ROWS)
