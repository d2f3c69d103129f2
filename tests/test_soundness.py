"""Lines that cannot be read, and rules that raise."""

import pytest

import veritable as v
from tests.helpers import WHEN, plan, scan_count, verdicts

SCHEMA = "k int, x double, t string"
JSON = ['{"k": 1, "x": 1.5, "t": "a"}', '{"k": 2, "x": "much", "t": "b"}', '{"k": 3, "x"', "", '{"k": 4, "x": null, "t": null}', "{}", "no json"]
CSV = ["k,x,t", "1,1.5,a", "2,much,b", "3", "4,,", "5,2.5,c,more", '6,1.0,"q, r"']


@pytest.fixture
def lines(tmp_path):
    def write(fmt):
        (tmp_path / f"data.{fmt}").write_text("\n".join(JSON if fmt == "json" else CSV) + "\n")
        return str(tmp_path / f"data.{fmt}")

    return write


READABLE = {"id": "line", "type": "readable"}


@pytest.mark.parametrize(("fmt", "total", "bad"), [("json", 6, [JSON[1], JSON[2], JSON[6]]), ("csv", 6, [CSV[2], CSV[3], CSV[5]])])
def test_unreadable_lines_are_counted_and_returned(spark, lines, fmt, total, bad):
    df = v.read_table(spark, lines(fmt), fmt, SCHEMA, unreadable="__unreadable")
    row = verdicts(df, [READABLE])["line"]
    assert (row["total_records"], row["failed_records"]) == (total, len(bad))
    assert sorted(r["__unreadable"] for r in v.failing_rows(df, "data", READABLE).collect()) == sorted(bad)


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_one_scan_with_other_rules(spark, lines, fmt):
    df = v.read_table(spark, lines(fmt), fmt, SCHEMA, unreadable="__unreadable")
    rules = [READABLE, {"id": "set", "type": "not_null", "column": "k"}, {"id": "low", "type": "min_max", "column": "k", "max": 3}]
    results = v.evaluate(df, "data", rules)
    assert scan_count(results) == 1 and "ReadSchema: struct<k:int,x:double,t:string,__unreadable:string>" in plan(results)
    # A rule on one column alone finds what is wrong with the others as well.
    assert results.collect()[0]["failed_records"] == 3


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_without_a_schema(spark, lines, fmt):
    df = v.read_table(spark, lines(fmt), fmt, unreadable="bad")
    assert df.columns[-1] == "bad" and df.columns.count("bad") == 1
    expected = 2 if fmt == "json" else 2  # the number fits the text type that is inferred
    assert v.failing_rows(df, "data", {**READABLE, "column": "bad"}).count() == expected


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_in_a_job(spark, lines, tmp_path, fmt):
    if fmt == "parquet":
        spark.createDataFrame([(1, 1.0, "a")], SCHEMA).write.parquet(str(tmp_path / "table"))
        source = {"path": str(tmp_path / "table"), "format": fmt}
    else:
        source = {"path": lines(fmt), "format": fmt, "schema": SCHEMA}
    rows = v.run_job(spark, "data", source, {"path": str(tmp_path / "out")}, [READABLE], "a", WHEN).collect()
    assert [r["failed_records"] for r in rows] == [0 if fmt == "parquet" else 3]


RULES = [
    {"id": "fine", "type": "not_null", "column": "t"},
    {"id": "cast", "type": "sql_expression", "expression": "CAST(t AS INT) > 1", "description": "a number"},
    {"id": "once", "type": "unique", "column": "t"},
    {"id": "zero", "type": "sql_expression", "expression": "6 / k >= 2"},
    {"id": "gone", "type": "min_max", "column": "nowhere", "min": 1},
    {"id": "query", "type": "custom_sql", "query": "SELECT CAST(t AS INT) AS n FROM data WHERE CAST(t AS INT) > 1"},
]


def test_rules_that_raise_stand_alone(spark):
    df = spark.createDataFrame([(0, "1"), (2, "x"), (3, "2"), (4, None)], "k int, t string")
    suite = v.CheckSuite("data", RULES, "run", WHEN)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|nowhere|DIVIDE_BY_ZERO"):
        suite.evaluate(df).collect()
    results = suite.evaluate_isolated(df)
    assert results.schema == v.RESULT_SCHEMA
    found = {r["rule_id"]: (r["status"], r["failed_records"], r["description"]) for r in results.collect()}
    assert list(found) == [rule["id"] for rule in RULES]
    assert found == {
        "fine": ("FAIL", 1, ""),
        "cast": ("ERROR", 3, "a number [CAST_INVALID_INPUT]"),
        "once": ("PASS", 0, ""),
        "zero": ("ERROR", 2, "[DIVIDE_BY_ZERO]"),
        "gone": ("ERROR", 4, "[UNRESOLVED_COLUMN.WITH_SUGGESTION]"),
        "query": ("ERROR", 1, "[CAST_INVALID_INPUT]"),
    }
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_without_errors_nothing_changes(spark):
    df = spark.createDataFrame([(1, "1"), (2, "2")], "k int, t string")
    suite = v.CheckSuite("data", [rule for rule in RULES if rule["id"] != "gone"], "run", WHEN)
    assert suite.evaluate_isolated(df).collect() == suite.evaluate(df).collect()
    assert v.CheckSuite("data", []).evaluate_isolated(df).count() == 0
