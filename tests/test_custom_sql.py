"""custom_sql: every returned row is a failure; views come and go cleanly."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import AnalysisException, ParseException

import veritable as v
from tests.helpers import failed, plan, verdicts


@pytest.fixture(scope="module")
def parcels(spark):
    rows = [(1, "x", "LOST"), (2, "y", "SENT"), (3, "x", "LOST"), (4, None, "KEPT"), (5, "z", "SENT")]
    return spark.createDataFrame(rows, "id INT, owner STRING, state STRING")


def sql(query, **extra):
    return {"type": "custom_sql", "query": query, **extra}


@pytest.mark.parametrize(
    ("query", "expected"),
    [
        ("SELECT * FROM data WHERE state = 'LOST'", 2),
        ("SELECT * FROM data WHERE id < 0", 0),
        (
            "SELECT * FROM data WHERE state = 'LOST' AND "
            "(SELECT COUNT(*) FROM data WHERE state = 'LOST') > 0.3 * (SELECT COUNT(*) FROM data)",
            2,
        ),
        (
            "SELECT * FROM data WHERE state = 'LOST' AND "
            "(SELECT COUNT(*) FROM data WHERE state = 'LOST') > 0.5 * (SELECT COUNT(*) FROM data)",
            0,
        ),
        ("SELECT owner FROM data GROUP BY owner HAVING COUNT(*) > 1", 1),
        ("SELECT a.id FROM data a JOIN data b ON a.owner = b.owner AND a.id > b.id", 1),
        ("SELECT * FROM data WHERE id > (SELECT AVG(id) FROM data)", 2),
        ("SELECT COUNT(*) FROM data", 1),
        ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY id) AS n FROM data) WHERE n > 1", 1),
        ("WITH lost AS (SELECT * FROM data WHERE state = 'LOST') SELECT * FROM lost", 2),
        ("SELECT id, id FROM data ORDER BY id LIMIT 3", 3),
        ("SELECT * FROM data WHERE id = 1;  ", 1),
        ("SELECT * FROM data WHERE state <> ';' ; ;\n", 5),
        ("SELECT * FROM data WHERE id = 1 -- only the first", 1),
        ("FROM data |> WHERE state = 'SENT'", 2),
        ("SELECT id FROM data EXCEPT SELECT id FROM data WHERE id < 4", 2),
    ],
)
def test_rows_returned_are_failures(parcels, query, expected):
    assert verdicts(parcels, [{"id": "r", **sql(query)}])["r"]["failed_records"] == expected


def test_many_queries_with_subqueries_of_their_own(parcels):
    # More than Spark has subquery threads: they must not wait for each other.
    rules = [
        {"id": f"r{i}", **sql(f"SELECT * FROM data WHERE id > {i} AND id <= (SELECT MAX(id) FROM data WHERE id > {i})")}
        for i in range(20)
    ]
    rows = verdicts(parcels, rules)
    assert [rows[f"r{i}"]["failed_records"] for i in range(20)] == [max(5 - i, 0) for i in range(20)]


def test_fan_out_goes_below_zero(parcels):
    query = "SELECT a.id FROM data a JOIN data b ON a.state = b.state"
    row = verdicts(parcels, [{"id": "r", **sql(query)}])["r"]
    assert (row["total_records"], row["failed_records"], row["passed_records"]) == (5, 9, -4)
    assert row["pass_rate"] == -0.8
    assert row["status"] == "FAIL"


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_reference_table_by_path(spark, parcels, tmp_path, fmt):
    path = str(tmp_path / fmt)
    v.write_table(spark.createDataFrame([("x",), ("y",)], "name STRING"), path, fmt)
    query = "SELECT d.* FROM data d LEFT ANTI JOIN owners o ON d.owner = o.name"
    rule = sql(query, reference_tables={"owners": {"path": path, "format": fmt}})
    # An unmatched owner, and a NULL one, which never matches.
    assert failed(parcels, rule) == 2
    assert not spark.catalog.tableExists("owners")


def test_reference_format_defaults_to_parquet(spark, parcels, tmp_path):
    path = str(tmp_path / "ref")
    v.write_table(spark.createDataFrame([(1,)], "k INT"), path)
    rule = sql("SELECT * FROM data JOIN ref ON id = k", reference_tables={"ref": {"path": path}})
    assert verdicts(parcels, [{"id": "r", **rule}])["r"]["failed_records"] == 1


def test_reference_aliases_do_not_reach_other_rules(spark, parcels, tmp_path):
    path = str(tmp_path / "ref")
    v.write_table(spark.createDataFrame([(1,)], "k INT"), path)
    rules = [
        {"id": "a", **sql("SELECT * FROM ref", reference_tables={"ref": {"path": path}})},
        {"id": "b", **sql("SELECT * FROM ref")},
    ]
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_NOT_FOUND"):
        verdicts(parcels, rules)


def test_alias_equal_to_the_dataset_name_holds_for_that_rule_only(spark, parcels, tmp_path):
    path = str(tmp_path / "ref")
    v.write_table(spark.createDataFrame([(1,)], "k INT"), path)
    rules = [
        {"id": "a", **sql("SELECT k FROM data", reference_tables={"data": {"path": path}})},
        {"id": "b", **sql("SELECT * FROM data")},
    ]
    rows = verdicts(parcels, rules)
    assert (rows["a"]["failed_records"], rows["b"]["failed_records"]) == (1, 5)


def test_dataset_view_is_dropped_and_an_existing_one_restored(spark, parcels):
    rule = {"id": "r", **sql("SELECT * FROM data")}
    v.evaluate(parcels, "data", [rule])
    assert not spark.catalog.tableExists("data")
    spark.range(2).createOrReplaceTempView("data")
    try:
        results = v.evaluate(parcels, "data", [rule])
        assert spark.table("data").count() == 2
        assert results.first()["failed_records"] == 5
        # A dataset derived from the very view it replaces for a while.
        derived = spark.table("data").filter("id > 0")
        assert verdicts(derived, [rule])["r"]["failed_records"] == 1
        assert spark.table("data").count() == 2
    finally:
        spark.catalog.dropTempView("data")


@pytest.mark.parametrize("registered", [False, True])
def test_cached_input_stays_cached_and_is_used(spark, parcels, registered):
    cached = parcels.filter("id > 1").cache()
    try:
        assert cached.count() == 4
        if registered:
            cached.createOrReplaceTempView("data")
        rule = {"id": "r", **sql("SELECT * FROM data WHERE state = 'SENT'")}
        for _ in range(2):
            results = v.evaluate(cached, "data", [rule])
            # Once for the total and once for the query.
            assert plan(results).count("InMemoryTableScan") >= 2
            assert results.first()["failed_records"] == 2
        assert spark.catalog.tableExists("data") is registered
    finally:
        cached.unpersist()
        spark.catalog.dropTempView("data")


def test_views_of_the_caller_are_left_alone(spark, parcels):
    rule = {"id": "r", **sql("SELECT * FROM Data")}
    spark.range(4).createOrReplaceTempView("base")
    spark.sql("CREATE OR REPLACE TEMP VIEW data AS SELECT * FROM base")
    spark.sql("CACHE TABLE data")
    try:
        assert verdicts(parcels, [rule])["r"]["failed_records"] == 5
        assert spark.catalog.isCached("data")
        spark.sql("UNCACHE TABLE data")
        # A view made of text goes on following its base.
        spark.range(9).createOrReplaceTempView("base")
        assert spark.table("data").count() == 9
    finally:
        spark.catalog.dropTempView("data")
        spark.catalog.dropTempView("base")


def test_no_view_is_left(spark, parcels):
    before = {t.name for t in spark.catalog.listTables()}
    verdicts(parcels, [{"id": "r", **sql("WITH data2 AS (SELECT * FROM data) SELECT * FROM data2 JOIN data USING (id)")}])
    assert {t.name for t in spark.catalog.listTables()} == before


def test_row_rule_with_a_subquery_over_the_dataset(spark, parcels):
    rule = {"type": "sql_expression", "expression": "id < (SELECT MAX(id) FROM data)"}
    assert failed(parcels, rule) == parcels.filter(f"id = {parcels.agg({'id': 'max'}).first()[0]}").count()
    assert not spark.catalog.tableExists("data")


def test_threads_do_not_see_each_others_views(spark):
    def run(size):
        rule = {"id": "r", **sql("SELECT * FROM data")}
        return [v.evaluate(spark.range(size), "data", [rule]).first()["failed_records"] for _ in range(3)]

    with ThreadPoolExecutor(6) as pool:
        assert list(pool.map(run, range(1, 7))) == [[size] * 3 for size in range(1, 7)]
    assert not spark.catalog.tableExists("data")


def test_views_are_cleaned_up_after_an_error(spark, parcels):
    with pytest.raises(AnalysisException):
        v.evaluate(parcels, "data", [{"id": "r", **sql("SELECT nope FROM data")}])
    assert not spark.catalog.tableExists("data")


@pytest.mark.parametrize("name", ["my-data", "a.b"])
def test_dataset_name_must_be_one_identifier(parcels, name):
    with pytest.raises(AnalysisException):
        v.evaluate(parcels, name, [{"id": "r", "type": "not_null", "column": "id"}])


@pytest.mark.parametrize("statement", ["DROP VIEW data", "CREATE VIEW v AS SELECT 1", "SET x = 1"])
def test_statements_are_refused(parcels, statement):
    with pytest.raises((ParseException, AnalysisException)):
        v.evaluate(parcels, "data", [{"id": "r", **sql(statement)}])


def test_session_udf_in_a_query(spark, parcels):
    spark.udf.register("is_odd", lambda x: x % 2 == 1, "boolean")
    assert failed(parcels, sql("SELECT * FROM data WHERE is_odd(id)")) == 3


def test_failing_rows_are_the_rows_of_the_query(parcels):
    query = "SELECT owner, COUNT(*) AS n FROM data GROUP BY owner HAVING COUNT(*) > 1"
    assert [tuple(r) for r in v.failing_rows(parcels, "data", {"id": "r", **sql(query)}).collect()] == [("x", 2)]


def test_empty_dataset_passes_although_the_query_returns_rows(parcels):
    empty = parcels.filter("id < 0")
    assert failed(empty, sql("SELECT * FROM data")) == 0
    assert verdicts(empty, [{"id": "r", **sql("SELECT 1")}])["r"]["failed_records"] == 0
    assert v.failing_rows(empty, "data", {"id": "r", **sql("SELECT 1")}).count() == 1


@pytest.mark.parametrize("end", [";", " ; ", "; -- note", "; /* note; */ ;\n", " -- note ;"])
def test_what_may_follow_the_last_word(spark, end):
    df = spark.range(5).withColumnRenamed("id", "n")
    query = "SELECT n, ';' AS `;` FROM data WHERE n > 2 AND ';--' <> \"a;\"" + end
    assert failed(df, {"type": "custom_sql", "query": query}) == 2
