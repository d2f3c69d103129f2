"""A dear input is read once, and only for the columns that rules need."""

import pytest

import veritable as v
from tests.helpers import jobs_started, plan, verdicts
from veritable.plans.shared import needed_columns

RULES = [
    {"id": "set", "type": "not_null", "column": "a"},
    {"id": "once", "type": "unique", "column": "odd `name"},
    {"id": "more", "type": "sql_expression", "expression": "b > (SELECT avg(c) FROM data)"},
    {"id": "query", "type": "custom_sql", "query": "SELECT x.a FROM data x JOIN (SELECT DISTINCT d FROM data) y ON x.a = y.d"},
]


@pytest.fixture
def data(spark):
    return spark.range(30).selectExpr("id AS a", "id * 2 AS b", "id % 7 AS c", "id + 25 AS d", "id AS unused", "id % 4 AS `odd ``name`", "named_struct('f', id) AS s")


def rules():
    return [{**rule, "column": "`odd ``name`"} if rule["id"] == "once" else rule for rule in RULES]


@pytest.mark.parametrize(
    ("picked", "columns"),
    [(["set"], ["a"]), (["once"], ["odd `name"]), (["more"], ["b", "c"]), (["query"], ["a", "d"]), (["set", "more", "query"], ["a", "b", "c", "d"])],
)
def test_columns(spark, data, tmp_path, picked, columns):
    suite = v.CheckSuite("data", [rule for rule in rules() if rule["id"] in picked])
    assert needed_columns(data, suite.evaluate, str(tmp_path / "x")) == columns


def test_results_are_the_same(spark, data, tmp_path):
    shared = verdicts(data, rules(), shared_input=str(tmp_path / "x"))
    assert {k: r["failed_records"] for k, r in shared.items()} == {k: r["failed_records"] for k, r in verdicts(data, rules()).items()}
    nothing = verdicts(data.where("a < 0"), rules(), shared_input=str(tmp_path / "y"))
    assert all(r["total_records"] == 0 and r["status"] == "PASS" for r in nothing.values())


def test_the_input_is_read_once(spark, data, tmp_path):
    data.drop("s").write.csv(str(tmp_path / "dear"), header=True)
    read = v.read_table(spark, str(tmp_path / "dear"), "csv", "a int, b int, c int, d int, unused int")
    suite = v.CheckSuite("data", [rule for rule in rules() if rule["id"] != "once"])
    results = suite.evaluate(read, shared_input=str(tmp_path / "x"))
    assert "dear" not in plan(results) and "unused" not in plan(results)


def test_nothing_but_the_number_of_rows(spark, data, tmp_path):
    suite = v.CheckSuite("data", [{"id": "all", "type": "custom_sql", "query": "SELECT 1 FROM data"}])
    _, row = jobs_started(spark, lambda: suite.evaluate(data, shared_input=str(tmp_path / "x")).first())
    assert row["failed_records"] == 30
