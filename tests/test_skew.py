"""The registered joins on data where one key holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

import veritable as v
from gallery.queries import SINGLE_RULES
from tests.helpers import plan

ROWS = 120_000
SETTINGS = {
    "spark.sql.shuffle.partitions": "100",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def shuffled_joins(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, name, hot_key=0):
    """A third of the rows under one key, the others each under their own."""
    key = F.when(F.col("id") % 3 == 0, hot_key).otherwise(F.col("id")).alias(name)
    return spark.range(0, ROWS, 1, 8).select("id", key)


def split(df, dataset, query):
    """Failures, and whether the executed join was split."""
    rows = v.failing_rows(df, dataset, {"id": "r", "type": "custom_sql", "query": query})
    found = len(rows.collect())
    results = v.evaluate(df, dataset, [{"id": "r", "type": "custom_sql", "query": query}])
    assert results.first()["failed_records"] == found
    return found, "(skew=true)" in plan(rows)


def test_group_of_copies(spark, shuffled_joins):
    documents = hot(spark, "n").select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "n").alias("text"))
    found = split(documents, "documents", SINGLE_RULES["custom_sql_self_join"][1]["query"])
    assert found == (ROWS // 3 - 1, True)


@pytest.mark.parametrize("key", ["custom_sql_anti_join", "custom_sql_anti_join_pass", "custom_sql_reference_table"])
def test_anti_join_with_a_key_hot_on_both_sides(spark, shuffled_joins, key):
    dataset, rule = SINGLE_RULES[key]
    left, right = {
        "custom_sql_anti_join": ("o_orderkey", "l_orderkey"),
        "custom_sql_anti_join_pass": ("l_partkey", "p_partkey"),
        "custom_sql_reference_table": ("doc_id", "doc_id"),
    }[key]
    checked = hot(spark, left).withColumn("payload", F.sha2(F.col("id").cast("string"), 256))
    # The even keys, and NULL, which matches nothing.
    reference = hot(spark, right).filter(F.col("id") % 2 == 0).select(right)
    reference = reference.union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    reference.createOrReplaceTempView(rule["references"][0])
    try:
        odd = sum(1 for i in range(ROWS) if i % 3 and i % 2)
        with_null = checked.union(spark.sql(f"SELECT -1L AS id, CAST(NULL AS BIGINT) AS {left}, 'x' AS payload"))
        assert split(with_null, dataset, rule["query"]) == (odd + 1, True)
    finally:
        spark.catalog.dropTempView(rule["references"][0])


def test_join_with_a_key_hot_on_both_sides(spark, shuffled_joins):
    lines = hot(spark, "l_orderkey").withColumn("l_shipdate", F.lit("2024-01-05").cast("date"))
    orders = hot(spark, "o_orderkey").selectExpr("o_orderkey", "date_add(DATE '2024-01-01', CAST(id % 10 AS INT)) AS o_orderdate")
    orders.createOrReplaceTempView("orders")
    try:
        # Every line of the hot order once, not once per copy of the order.
        late = sum(1 for i in range(ROWS) if i % 3 == 0 or i % 10 > 4)
        query = SINGLE_RULES["custom_sql_reference_join"][1]["query"]
        assert split(lines, "lineitem", query) == (late, True)
    finally:
        spark.catalog.dropTempView("orders")
