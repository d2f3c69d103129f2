"""Queries of what goes beyond one evaluation: retries, verdicts of rows, stored states."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import veritable as v
from gallery import oracle as o
from gallery import queries as q
from gallery.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

DAY = dt.datetime(2024, 6, 1, 6, tzinfo=dt.timezone.utc)


# --- a run stored once --------------------------------------------------------


def job_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, the first of them three times under its run id; the last time an hour later."""
    path = scratch_path(spark, "retried")
    source = {"path": f"{sf_dir}/orders.parquet", "format": "parquet"}
    for run_id, hours, rules in (
        ("run-a", 0, q.ORDERS_SUITE[:3]), ("run-a", 0, q.ORDERS_SUITE[:4]), ("run-b", 2, q.ORDERS_SUITE[3:7]), ("run-a", 1, q.ORDERS_SUITE[:4]),
    ):
        v.run_job(spark, "orders", source, {"path": path}, rules, run_id, DAY + dt.timedelta(hours=hours))
    return q.with_epoch(v.read_history(spark, path))


def _job_retry_sql() -> str:
    def run(run_id: str, hour: int) -> str:
        when = f"2024-06-01 {hour:02d}:00:00"
        return f"'{run_id}' AS run_id, CAST(epoch(TIMESTAMP '{when}') AS BIGINT) AS run_epoch, '2024-06-01' AS run_date, "

    suite = o.orders_suite()
    return f"{o.results('orders', suite[:4], run('run-a', 7))} UNION ALL BY NAME {o.results('orders', suite[3:7], run('run-b', 8))}"


def history_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of two days, compacted after two; then the first is repeated, and all compacted again."""
    path = scratch_path(spark, "compacted")

    def commit(run: tuple) -> None:
        run_id, when, name, rules = run
        results = v.evaluate(q.table(spark, sf_dir, name), name, rules, run_id, when)
        v.commit_run(results, path, name, run_id, partition_by=["run_date"])

    for run in q.RUNS[1:]:
        commit(run)
    v.compact_history(spark, path)
    commit(q.RUNS[0])
    commit(q.RUNS[1])
    v.compact_history(spark, path)
    return q.with_epoch(v.read_history(spark, path))


# --- verdicts of rows ---------------------------------------------------------

ROW_SUITE = [rule for rule in q.DOCUMENTS_SUITE]


def failing_rows_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that fails a rule, with the rules it fails."""
    labelled = q.table(spark, sf_dir, "labelled")
    failing = v.CheckSuite("labelled", ROW_SUITE).all_failing_rows(labelled, scratch_path(spark, "keys"))
    return failing.withColumn("failed_rules", F.array_join("failed_rules", ","))


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad documents from one pass, put together again."""
    labelled = q.table(spark, sf_dir, "labelled")
    suite = v.CheckSuite("labelled", ROW_SUITE)
    good, bad = suite.split_rows(labelled, scratch_path(spark, "split"), scratch_path(spark, "keys"))
    both = good.withColumn("failed_rules", F.lit(None).cast("array<string>")).unionByName(bad)
    return both.withColumn("failed_rules", F.array_join("failed_rules", ","))


_MARKED = f"""
    SELECT *, concat_ws(',',
        CASE WHEN quality IS NULL THEN 'quality_present' END,
        CASE WHEN (quality BETWEEN 0 AND 1) IS NOT TRUE THEN 'quality_range' END,
        CASE WHEN (toxic IN (0)) IS NOT TRUE THEN 'toxic_no' END,
        CASE WHEN count(*) OVER (PARTITION BY text) > 1 THEN 'text_unique' END,
        CASE WHEN count(*) OVER (PARTITION BY toxic) > 1 THEN 'toxic_unique' END,
        CASE WHEN regexp_matches(lang, '^(de|en|es|fr)$') IS NOT TRUE THEN 'lang_known' END,
        CASE WHEN (quality = 1 OR toxic = 0) IS NOT TRUE THEN 'good_or_clean' END) AS failed_rules
    FROM {o.LABELLED}
"""

# --- stored states ------------------------------------------------------------


def unique_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders, in three slices as they were appended; the second one came twice."""
    orders = q.table(spark, sf_dir, "orders")
    rule = {"id": "customer_once", "type": "unique", "column": "o_custkey"}
    state = v.UniqueState(spark, scratch_path(spark, "unique-state"), "orders", rule, buckets=8)
    for part in (0, 1, 1, 2):
        state.merge(orders.where(F.col("o_orderkey") % 3 == part), f"slice {part}")
    return state.evaluate().drop(*q.RUN_COLUMNS)


def suite_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders laid out by status; after two changes, the partition that changed is evaluated again."""
    path, state_path = scratch_path(spark, "by-status"), scratch_path(spark, "suite-state")
    orders = q.table(spark, sf_dir, "orders")
    v.write_table(orders, path, partition_by=["o_orderstatus"])
    rules = [rule for rule in q.ORDERS_SUITE if rule["type"] not in ("unique", "custom_sql")]
    state = v.SuiteState(spark, state_path, "orders", rules, "o_orderstatus")
    stored = v.read_table(spark, path, "parquet", orders.schema)
    state.update(stored, ["F", "O", "P"])
    cheap = orders.where("o_orderstatus = 'O' AND o_totalprice < 200000").drop("o_orderstatus")
    v.write_table(cheap, f"{path}/o_orderstatus=O", mode="overwrite")
    state.update(v.read_table(spark, path, "parquet", orders.schema), ["O"])
    return state.evaluate().drop(*q.RUN_COLUMNS)


_CHANGED_ORDERS = "(SELECT * FROM orders WHERE o_orderstatus <> 'O' OR o_totalprice < 200000)"


def job_observed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are written anyway, checked by that write."""
    watch = v.Watch(v.CheckSuite("labelled", [r for r in ROW_SUITE if r["type"] != "unique"]), q.table(spark, sf_dir, "labelled"))
    v.write_table(watch.rows, scratch_path(spark, "watched"))
    return watch.results().drop(*q.RUN_COLUMNS)


# --- references ---------------------------------------------------------------


def rule_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer buys furniture or machines: a reference with gaps, by bitmap."""
    path = scratch_path(spark, "reference")
    v.write_table(q.table(spark, sf_dir, "customer").where("c_mktsegment IN ('FURNITURE', 'MACHINERY')").select("c_custkey"), path)
    rule = {"id": "known", "type": "foreign_key", "column": "o_custkey", "reference": {"path": path, "column": "c_custkey"}}
    return v.evaluate(q.table(spark, sf_dir, "orders"), "orders", [rule]).drop(*q.RUN_COLUMNS)


def rule_foreign_key_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text no document with a good label has: a text, by distinct values."""
    path = scratch_path(spark, "reference")
    v.write_table(q.table(spark, sf_dir, "labelled").where("quality = 1").select("text"), path)
    rule = {"id": "labelled", "type": "foreign_key", "column": "text", "reference": {"path": path, "column": "text"}}
    return v.evaluate(q.table(spark, sf_dir, "documents"), "documents", [rule]).drop(*q.RUN_COLUMNS)


def failing_rows_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"id": "labelled", "type": "foreign_key", "column": "doc_id", "reference": {"path": f"{sf_dir}/labels.parquet", "column": "doc_id"}}
    return v.failing_rows(q.table(spark, sf_dir, "documents"), "documents", rule)


_KNOWN = "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('FURNITURE', 'MACHINERY')"
_GOOD_TEXTS = f"SELECT text FROM {o.LABELLED} WHERE quality = 1"


# --- one read for all rules ---------------------------------------------------


def suite_shared_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite of the orders over CSV, which is parsed once."""
    path = scratch_path(spark, "shared-source")
    orders = q.table(spark, sf_dir, "orders")
    v.write_table(orders, path, "csv")
    read = v.read_table(spark, path, "csv", orders.schema)
    suite = v.CheckSuite("orders", q.ORDERS_SUITE)
    return suite.evaluate(read, shared_input=scratch_path(spark, "shared")).drop(*q.RUN_COLUMNS)


# --- input and rules that are not sound ---------------------------------------

_TOO_LONG = "n_chars < 5000"


def scan_json_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines, of which some are cut off and some have a text for a number."""
    documents, path = q.table(spark, sf_dir, "documents"), scratch_path(spark, "broken-json")
    line = F.to_json(F.struct(*documents.columns))
    cut = F.when(F.col("doc_id") % 10 == 3, F.expr("left(line, 40)"))
    wrong = F.when(F.col("doc_id") % 10 == 7, F.regexp_replace("line", '"n_chars":[0-9]+', '"n_chars":"many"'))
    documents.withColumn("line", line).select(F.coalesce(cut, wrong, F.col("line")).alias("value")).write.text(path)
    rules = [{"id": "line", "type": "readable"}, {"id": "length", "type": "sql_expression", "expression": _TOO_LONG}]
    read = v.read_table(spark, path, "json", documents.schema, unreadable="__unreadable")
    return v.evaluate(read, "documents", rules).drop(*q.RUN_COLUMNS)


def scan_csv_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as CSV, of which some lack columns and some have a text for a number."""
    customer, path = q.table(spark, sf_dir, "customer"), scratch_path(spark, "broken-csv")
    line = F.expr(
        "CASE c_custkey % 10 WHEN 3 THEN concat_ws(',', c_custkey, c_name) "
        "WHEN 7 THEN concat_ws(',', c_custkey, c_name, c_nationkey, 'much', c_mktsegment) "
        "ELSE concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment) END"
    )
    customer.select(line.alias("value")).write.text(path)
    rules = [{"id": "line", "type": "readable", "column": "bad"}, {"id": "balance", "type": "not_null", "column": "c_acctbal"}]
    read = v.read_table(spark, path, "csv", customer.schema, unreadable="bad", header="false")
    return v.evaluate(read, "customer", rules).drop(*q.RUN_COLUMNS)


def suite_with_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A suite of which one rule cannot be computed on some rows, and one not at all."""
    rules = [
        {"id": "price", "type": "min_max", "column": "o_totalprice", "min": 1000},
        {"id": "urgency", "type": "sql_expression", "expression": "CAST(left(o_orderpriority, 1 + o_orderkey % 2) AS INT) < 3"},
        {"id": "clerk", "type": "not_null", "column": "o_clerk", "description": "there is none"},
        {"id": "customer_once", "type": "unique", "column": "o_custkey"},
    ]
    return v.CheckSuite("orders", rules).evaluate_isolated(q.table(spark, sf_dir, "orders")).drop(*q.RUN_COLUMNS)


_URGENT = "o_orderkey % 2 = 0 AND CAST(left(o_orderpriority, 1) AS INTEGER) < 3"
_WITH_ERROR = o.results("orders", [
    ("price", "min_max", "o_totalprice", "error", "", o.count("orders"), o.invalid("orders", "o_totalprice >= 1000")),
    ("urgency", "sql_expression", None, "error", "[CAST_INVALID_INPUT]", o.count("orders"), o.invalid("orders", _URGENT)),
    ("clerk", "not_null", "o_clerk", "error", "there is none [UNRESOLVED_COLUMN.WITH_SUGGESTION]", o.count("orders"), o.count("orders")),
    ("customer_once", "unique", "o_custkey", "error", "", o.count("orders"), o.repeated("orders", "o_custkey")),
])


FEATURES: dict[str, tuple[Query, str]] = {
    "job_retry": (job_retry, _job_retry_sql()),
    "history_compacted": (history_compacted, o.history()),
    "failing_rows_suite": (failing_rows_suite, f"SELECT * FROM ({_MARKED}) WHERE failed_rules <> ''"),
    "unique_incremental": (
        unique_incremental,
        o.results("orders", [("customer_once", "unique", "o_custkey", "error", "", o.count("orders"), o.repeated("orders", "o_custkey"))]),
    ),
    "suite_incremental": (
        suite_incremental,
        o.results("orders", [row for row in o.orders_suite(_CHANGED_ORDERS) if row[1] not in ("unique", "custom_sql")]),
    ),
    "job_observed_write": (
        job_observed_write,
        o.results("labelled", [row for row in o.documents_suite() if row[1] != "unique"]),
    ),
    "rule_foreign_key": (
        rule_foreign_key,
        o.one_rule("known", "orders", "foreign_key", "o_custkey", o.count("orders", f"o_custkey NOT IN ({_KNOWN})")),
    ),
    "rule_foreign_key_text": (
        rule_foreign_key_text,
        o.one_rule("labelled", "documents", "foreign_key", "text", o.count("documents", f"text NOT IN ({_GOOD_TEXTS})")),
    ),
    "failing_rows_foreign_key": (
        failing_rows_foreign_key, "SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    ),
    "suite_shared_input": (suite_shared_input, o.results("orders", o.orders_suite())),
    "scan_json_corrupt": (
        scan_json_corrupt,
        o.results("documents", [
            ("line", "readable", None, "error", "", o.count("documents"), o.count("documents", "doc_id % 10 IN (3, 7)")),
            ("length", "sql_expression", None, "error", "", o.count("documents"),
             o.count("documents", "doc_id % 10 IN (3, 7) OR n_chars >= 5000")),
        ]),
    ),
    "scan_csv_corrupt": (
        scan_csv_corrupt,
        o.results("customer", [
            ("line", "readable", "bad", "error", "", o.count("customer"), o.count("customer", "c_custkey % 10 IN (3, 7)")),
            ("balance", "not_null", "c_acctbal", "error", "", o.count("customer"), o.count("customer", "c_custkey % 10 IN (3, 7)")),
        ]),
    ),
    "suite_with_error": (
        suite_with_error,
        f"SELECT * REPLACE (CASE WHEN rule_id IN ('urgency', 'clerk') THEN 'ERROR' ELSE status END AS status) FROM ({_WITH_ERROR})",
    ),
    "split_rows": (split_rows, f"SELECT * REPLACE (nullif(failed_rules, '') AS failed_rules) FROM ({_MARKED})"),
}


def feature_queries() -> dict[str, Query]:
    return {key: query for key, (query, _) in FEATURES.items()}


def feature_oracles() -> dict[str, str]:
    return {key: sql for key, (_, sql) in FEATURES.items()}
