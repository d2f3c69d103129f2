"""Whole suites: results schema, order, totals, empty input, laziness."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

import veritable as v
from tests.helpers import WHEN, jobs_started, scan_count, verdicts

# Readings of weather stations.
ONCE = {"id": "one_reading", "type": "unique", "column": "station", "severity": "warning"}
QUERIES = [
    {"id": "wet_but_clear", "type": "custom_sql", "query": "SELECT * FROM data WHERE rain > 0 AND sky = 'clear'"},
    {
        "id": "lonely_sky",
        "type": "custom_sql",
        "severity": "info",
        "query": "SELECT sky FROM data GROUP BY sky HAVING COUNT(*) = 1",
    },
]
RULES = [
    {"id": "dew", "type": "sql_expression", "expression": "dew <= celsius", "description": "dew point"},
    QUERIES[0],
    {"id": "not_too_cold", "type": "min_max", "column": "celsius", "min": -60},
    ONCE,
    {"id": "some_rain", "type": "not_null", "column": "rain"},
    {"id": "station_code", "type": "regex", "column": "station", "pattern": "^[A-Z]{3}$", "severity": "warning"},
    {"id": "rain_limit", "type": "min_max", "column": "rain", "max": 400},
    {"id": "sky", "type": "allowed_values", "column": "sky", "values": ["clear", "cloudy", "fog"]},
    {"id": "wind", "type": "sql_expression", "expression": "station <> 'XXX'"},
    QUERIES[1],
]
SCHEMA = "station STRING, celsius DOUBLE, dew DOUBLE, rain BIGINT, sky STRING"


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [
        ("OSL", -4.5, -9.0, 0, "clear"),
        ("osl", -80.0, 1.0, 12, "cloudy"),
        ("BER", 17.0, None, None, "clear"),
        ("BER", 16.0, 16.5, 3, "clear"),
        ("BER", None, 2.0, 900, "hail"),
        ("XXX", 30.5, 30.5, 5, None),
        (None, 8.0, 7.0, 1, "fog"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_counts_by_hand(dirty):
    rows = verdicts(dirty, RULES)
    assert {key: row["failed_records"] for key, row in rows.items()} == {
        "dew": 4,
        "wet_but_clear": 1,
        "not_too_cold": 2,
        "one_reading": 3,
        "some_rain": 1,
        "station_code": 2,
        "rain_limit": 2,
        "sky": 2,
        "wind": 2,
        "lonely_sky": 4,
    }
    for row in rows.values():
        assert row["total_records"] == 7
        assert row["passed_records"] == 7 - row["failed_records"]
        assert row["pass_rate"] == row["passed_records"] / 7
        assert row["status"] == "FAIL"


def test_rows_come_in_rule_order_with_their_metadata(dirty):
    rows = v.evaluate(dirty, "data", RULES).collect()
    assert [r["rule_id"] for r in rows] == [r["id"] for r in RULES]
    assert [r["rule_type"] for r in rows] == [r["type"] for r in RULES]
    assert [r["column_name"] for r in rows] == [r.get("column") for r in RULES]
    assert [r["severity"] for r in rows] == [r.get("severity", "error") for r in RULES]
    assert [r["description"] for r in rows] == [r.get("description", "") for r in RULES]
    reverse = v.evaluate(dirty, "data", RULES[::-1]).collect()
    assert [r["rule_id"] for r in reverse] == [r["id"] for r in RULES[::-1]]


@pytest.mark.parametrize("rules", [RULES, RULES[:1], [ONCE], QUERIES, [ONCE, *QUERIES], []])
def test_schema_is_fixed_whatever_the_rules(dirty, rules):
    results = v.evaluate(dirty, "data", rules)
    assert [(f.name, f.dataType) for f in results.schema] == [(f.name, f.dataType) for f in v.RESULT_SCHEMA]
    for got, wanted in zip(results.schema, v.RESULT_SCHEMA, strict=True):
        assert wanted.nullable or not got.nullable, got.name
    assert results.count() == len(rules)


@pytest.mark.parametrize("shared_scan", [False, True])
@pytest.mark.parametrize("rules", [RULES, [ONCE], QUERIES])
def test_empty_dataset_passes_everything(spark, rules, shared_scan):
    empty = spark.createDataFrame([], SCHEMA)
    for row in v.evaluate(empty, "data", rules, shared_scan=shared_scan).collect():
        assert (row["total_records"], row["failed_records"], row["passed_records"]) == (0, 0, 0)
        assert (row["pass_rate"], row["status"]) == (1.0, "PASS")


def test_query_over_other_data_does_not_fail_an_empty_dataset(spark):
    rule = {"id": "r", "type": "custom_sql", "query": "SELECT 1"}
    assert verdicts(spark.createDataFrame([], SCHEMA), [rule])["r"]["status"] == "PASS"


def test_clean_dataset(spark):
    rows = [(code, 11.0, 4.0, rain, sky) for code, rain, sky in zip("ABC BCD CDE DEF".split(), (0, 0, 9, 9), ("clear", "clear", "fog", "fog"))]
    statuses = {r["status"] for r in v.evaluate(spark.createDataFrame(rows, SCHEMA), "data", RULES).collect()}
    assert statuses == {"PASS"}


def test_run_identity_is_injectable(dirty):
    row = v.evaluate(dirty, "data", RULES[:1], "run-1", WHEN).first()
    assert (row["run_id"], row["run_date"], row["dataset"]) == ("run-1", "2024-03-01", "data")
    moment = v.evaluate(dirty, "data", RULES[:1], "run-1", WHEN).selectExpr("unix_micros(run_timestamp)")
    assert moment.first()[0] == int(WHEN.timestamp()) * 1_000_000 + 123456


def test_run_date_is_the_date_of_the_given_timestamp(dirty):
    late = dt.datetime(2024, 3, 1, 23, 30, tzinfo=dt.timezone(dt.timedelta(hours=-5)))
    assert v.evaluate(dirty, "data", RULES[:1], run_timestamp=late).first()["run_date"] == "2024-03-01"


def test_run_timestamp_is_an_instant_whatever_the_default_type(spark, dirty):
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")
    try:
        results = v.evaluate(dirty, "data", RULES[:1], run_timestamp=WHEN)
        assert results.schema["run_timestamp"].dataType.simpleString() == "timestamp"
        assert results.selectExpr("unix_seconds(run_timestamp)").first()[0] == int(WHEN.timestamp())
    finally:
        spark.conf.unset("spark.sql.timestampType")


def test_run_identity_is_generated_once_per_suite(dirty):
    suite = v.CheckSuite("data", RULES[:2])
    first, second = suite.evaluate(dirty).collect(), suite.evaluate(dirty).collect()
    assert len({r["run_id"] for r in first + second}) == 1
    assert len(suite.run_id) == 36
    assert suite.run_timestamp.utcoffset() == dt.timedelta(0)
    assert v.CheckSuite("data", RULES[:2]).run_id != suite.run_id


def test_nothing_runs_until_the_results_are_used(spark, dirty):
    started, results = jobs_started(spark, lambda: v.evaluate(dirty, "data", RULES))
    assert started == 0
    started, _ = jobs_started(spark, results.collect)
    assert started > 0


def test_row_rules_share_one_scan(spark, tmp_path, dirty):
    path = str(tmp_path / "t")
    v.write_table(dirty, path)
    data = v.read_table(spark, path, "parquet")
    row_rules = [r for r in RULES if r["type"] not in ("unique", "custom_sql")]
    assert scan_count(v.evaluate(data, "data", row_rules)) == 1
    # A unique rule brings its own total along.
    assert scan_count(v.evaluate(data, "data", [ONCE])) == 1
    assert scan_count(v.evaluate(data, "data", RULES)) == 2 + len(QUERIES)


def test_unique_rules_can_share_a_scan(spark, tmp_path, dirty):
    path = str(tmp_path / "t")
    v.write_table(dirty, path)
    data = v.read_table(spark, path, "parquet")
    uniques = [{"id": f"once_{c}", "type": "unique", "column": c} for c in data.columns]
    uniques.append({"id": "once_again", "type": "unique", "column": "sky"})
    mixed = [*uniques[:2], *RULES, *uniques[2:]]
    for rules, apart, together in ((uniques, 6, 1), (mixed, 10, 4)):
        separate, shared = (v.evaluate(data, "data", rules, "r", WHEN, shared_scan=s) for s in (False, True))
        assert (scan_count(separate), scan_count(shared)) == (apart, together)
        assert separate.collect() == shared.collect()


def test_more_unique_rules_than_one_scan_takes(dirty):
    rules = [{"id": f"u{i}", "type": "unique", "column": dirty.columns[i % 5]} for i in range(40)]
    separate, shared = (v.evaluate(dirty, "data", rules, "r", WHEN, shared_scan=s) for s in (False, True))
    assert separate.collect() == shared.collect()


def test_many_rules_at_once(dirty):
    rules = [{"id": f"r{i}", "type": "min_max", "column": "celsius", "min": i - 90} for i in range(150)]
    rows = v.evaluate(dirty, "data", rules).collect()
    measured = [-4.5, -80.0, 17.0, 16.0, None, 30.5, 8.0]
    expected = [sum(c is None or c < i - 90 for c in measured) for i in range(150)]
    assert [r["failed_records"] for r in rows] == expected


def test_suite_equals_its_rules_taken_one_by_one(dirty):
    together = verdicts(dirty, RULES)
    for rule in RULES:
        alone = verdicts(dirty, [rule])[rule["id"]]
        assert alone["failed_records"] == together[rule["id"]]["failed_records"]
        assert alone["total_records"] == together[rule["id"]]["total_records"]


def test_one_bad_rule_stops_the_run(dirty):
    bad = {"id": "bad", "type": "sql_expression", "expression": "CAST(station AS INT) = 1"}
    with pytest.raises(PySparkException):
        v.evaluate(dirty, "data", [RULES[0], bad]).collect()


def test_streams_are_refused(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="bounded"):
        v.evaluate(stream, "data", [{"id": "r", "type": "not_null", "column": "value"}])


def test_failing_rows_by_rule_id(dirty):
    suite = v.CheckSuite("data", RULES)
    for rule_id, row in verdicts(dirty, RULES).items():
        assert suite.failing_rows(dirty, rule_id).count() == row["failed_records"]
    with pytest.raises(ValueError, match="No rule 'nope'"):
        suite.failing_rows(dirty, "nope")


@pytest.mark.parametrize("name", ["a AS (SELECT 1), b", "two words", "", "a;b", "a.b", "`a", "select 1) --", "1"])
def test_names_that_are_no_identifier_are_refused(spark, name):
    with pytest.raises(Exception, match="name|PARSE"):
        v.evaluate(spark.range(1), name, [{"id": "r", "type": "not_null", "column": "id"}]).collect()


@pytest.mark.parametrize("name", ["orders", "`two words`", "`Été_2`", "_a2", "`a``b`"])
def test_names_that_are(spark, name):
    rule = {"id": "q", "type": "custom_sql", "query": f"SELECT * FROM {name}"}
    low = {"id": "low", "type": "sql_expression", "expression": "id < 5"}
    assert [r["failed_records"] for r in v.evaluate(spark.range(1), name, [low, rule]).collect()] == [0, 1]
