"""One entry per operator: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import veritable as v
from gallery.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

RUN_COLUMNS = ("run_id", "run_timestamp", "run_date")

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "labelled":
        # The tables hold no NULL; unlabelled documents supply them.
        documents, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
        return documents.join(labels, "doc_id", "left")
    return v.read_table(spark, f"{sf_dir}/{name}.parquet", "parquet")


# --- single rules -------------------------------------------------------------

# In the joins, the other side is thinned out to one row per key before it is
# shuffled, so a hot key there costs nothing. It is then compared with <=>, which
# makes Spark shuffle both sides for the join itself; only such a join can be
# split by AQE where a key is hot on the side being checked. With = the shuffle
# of the aggregate would be taken over, and a hot key would stay in one task.
# Where the key is unique on the other side (part, labels, orders) there is nothing
# to thin out: a plain anti or semi join shuffles each side once and is split too.

# key: (table, rule)
SINGLE_RULES: dict[str, tuple[str, dict]] = {
    "rule_not_null_pass": ("orders", {"type": "not_null", "column": "o_orderkey"}),
    "rule_not_null_fail": ("labelled", {"type": "not_null", "column": "quality"}),
    "rule_unique_pass": ("orders", {"type": "unique", "column": "o_orderkey"}),
    "rule_unique_fail": ("documents", {"type": "unique", "column": "text"}),
    "rule_unique_digest": ("documents", {"type": "unique", "column": "text", "digest": True}),
    "rule_unique_nulls": ("labelled", {"type": "unique", "column": "quality"}),
    "rule_unique_heavy": ("orders", {"type": "unique", "column": "o_custkey"}),
    "rule_min_max_both": ("lineitem", {"type": "min_max", "column": "l_quantity", "min": 5, "max": 45}),
    "rule_min_max_min_only": ("customer", {"type": "min_max", "column": "c_acctbal", "min": 0}),
    "rule_min_max_max_only": ("lineitem", {"type": "min_max", "column": "l_discount", "max": 0.08}),
    "rule_min_max_integer": (
        "lineitem",
        {"type": "min_max", "column": "l_linenumber", "min": 2, "max": 6},
    ),
    "rule_min_max_null": ("labelled", {"type": "min_max", "column": "quality", "min": 0}),
    "rule_min_max_null_bound": (
        "orders",
        {"type": "min_max", "column": "o_totalprice", "min": 0, "max": None},
    ),
    "rule_allowed_values_pass": (
        "customer",
        {"type": "allowed_values", "column": "c_mktsegment", "values": SEGMENTS},
    ),
    "rule_allowed_values_fail": (
        "orders",
        {"type": "allowed_values", "column": "o_orderstatus", "values": ["F", "O"]},
    ),
    "rule_allowed_values_null": (
        "labelled",
        {"type": "allowed_values", "column": "quality", "values": [1]},
    ),
    "rule_regex_pass": ("customer", {"type": "regex", "column": "c_name", "pattern": "^Customer#[0-9]{9}$"}),
    "rule_regex_fail": ("pages", {"type": "regex", "column": "url", "pattern": "^https://"}),
    "rule_regex_prefix": ("orders", {"type": "regex", "column": "o_orderpriority", "pattern": "^[1-3]-"}),
    "rule_sql_expression_columns": (
        "lineitem",
        {"type": "sql_expression", "expression": "l_tax <= l_discount"},
    ),
    "rule_sql_expression_arith": (
        "lineitem",
        {"type": "sql_expression", "expression": "l_extendedprice * (1 - l_discount) <= 90000"},
    ),
    "rule_sql_expression_string": (
        "documents",
        {"type": "sql_expression", "expression": "length(text) = n_chars"},
    ),
    "rule_sql_expression_json": (
        "events",
        {"type": "sql_expression", "expression": "CAST(get_json_object(props, '$.k') AS INT) < 50"},
    ),
    "custom_sql_threshold_fail": (
        "customer",
        {
            "type": "custom_sql",
            "query": """
                SELECT c_custkey FROM customer
                WHERE c_acctbal < (SELECT AVG(c_acctbal) - 1.5 * STDDEV_POP(c_acctbal) FROM customer)
            """,
        },
    ),
    "custom_sql_threshold_pass": (
        "customer",
        {
            "type": "custom_sql",
            "query": """
                SELECT c_custkey FROM customer
                WHERE c_acctbal < (SELECT AVG(c_acctbal) - 4 * STDDEV_POP(c_acctbal) FROM customer)
            """,
        },
    ),
    "custom_sql_in_list": (
        "customer",
        {
            "type": "custom_sql",
            "query": """
                SELECT c_custkey, c_nationkey FROM customer
                WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey NOT IN (3, 7, 11)
            """,
        },
    ),
    "custom_sql_anti_join": (
        "orders",
        {
            "type": "custom_sql",
            "references": ["lineitem"],
            "query": """
                SELECT o.* FROM orders o
                LEFT ANTI JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL) l
                ON o.o_orderkey <=> l.l_orderkey
            """,
        },
    ),
    "custom_sql_anti_join_pass": (
        "lineitem",
        {
            "type": "custom_sql",
            "references": ["part"],
            "query": """
                SELECT l.* FROM lineitem l
                LEFT ANTI JOIN part p ON l.l_partkey = p.p_partkey
            """,
        },
    ),
    "custom_sql_reference_table": (
        "documents",
        {
            "type": "custom_sql",
            "references": ["labels"],
            "query": """
                SELECT d.* FROM documents d
                LEFT ANTI JOIN labels l ON d.doc_id = l.doc_id
            """,
        },
    ),
    "custom_sql_reference_join": (
        "lineitem",
        {
            "type": "custom_sql",
            "references": ["orders"],
            "query": """
                SELECT l.* FROM lineitem l
                LEFT SEMI JOIN orders o ON l.l_orderkey = o.o_orderkey AND l.l_shipdate < o.o_orderdate
            """,
        },
    ),
    "custom_sql_group_by_having": (
        "orders",
        {
            "type": "custom_sql",
            "query": "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 15",
        },
    ),
    "custom_sql_composite_key": (
        "lineitem",
        {
            "type": "custom_sql",
            "query": """
                SELECT l_orderkey, l_linenumber FROM lineitem
                GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
            """,
        },
    ),
    "custom_sql_self_join": (
        "documents",
        {
            "type": "custom_sql",
            # Every copy but the first: the other side of the self-join is one
            # row per repeated text, so a group is never paired with itself.
            # Both sides compute the digest first and shuffle that, not the text.
            "query": """
                SELECT d.doc_id, f.first_id
                FROM (SELECT doc_id, sha2(text, 256) AS digest FROM documents) d
                JOIN (
                    SELECT sha2(text, 256) AS digest, MIN(doc_id) AS first_id
                    FROM documents GROUP BY sha2(text, 256) HAVING COUNT(*) > 1
                ) f ON d.digest <=> f.digest AND d.doc_id > f.first_id
            """,
        },
    ),
    "custom_sql_subquery": (
        "events",
        {
            "type": "custom_sql",
            "query": "SELECT * FROM events WHERE value > 5 * (SELECT AVG(value) FROM events)",
        },
    ),
    "custom_sql_fanout": (
        "nation",
        {
            "type": "custom_sql",
            "references": ["customer"],
            "query": "SELECT c.c_custkey FROM nation n JOIN customer c ON n.n_nationkey = c.c_nationkey",
        },
    ),
}


def with_references(rule: dict, sf_dir: str) -> dict:
    """Spell out the named reference tables as paths."""
    names = rule.get("references")
    if not names:
        return rule
    spec = {key: value for key, value in rule.items() if key != "references"}
    spec["reference_tables"] = {name: {"path": f"{sf_dir}/{name}.parquet"} for name in names}
    return spec


def single_rule(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    name, rule = SINGLE_RULES[key]
    spec = {"id": key, **with_references(rule, sf_dir)}
    return v.evaluate(table(spark, sf_dir, name), name, [spec]).drop(*RUN_COLUMNS)


# --- suites -------------------------------------------------------------------

ORDERS_SUITE = [
    {"id": "order_key_present", "type": "not_null", "column": "o_orderkey", "description": "key is set"},
    {"id": "order_key_unique", "type": "unique", "column": "o_orderkey"},
    {"id": "customer_once", "type": "unique", "column": "o_custkey", "severity": "warning"},
    {"id": "price_range", "type": "min_max", "column": "o_totalprice", "min": 1000, "max": 400000},
    {"id": "status_known", "type": "allowed_values", "column": "o_orderstatus", "values": ["F", "O"]},
    {"id": "priority_format", "type": "regex", "column": "o_orderpriority", "pattern": "^[1-3]-"},
    {"id": "price_per_key", "type": "sql_expression", "expression": "o_totalprice >= o_custkey"},
    {
        "id": "busy_days",
        "type": "custom_sql",
        "severity": "warning",
        "description": "days with over twice the orders of the mean day",
        "query": """
            WITH days AS (SELECT o_orderdate, COUNT(*) AS n FROM orders GROUP BY o_orderdate)
            SELECT o_orderdate, n FROM days WHERE n > 2 * (SELECT AVG(n) FROM days)
        """,
    },
]

DOCUMENTS_SUITE = [
    {"id": "quality_present", "type": "not_null", "column": "quality"},
    {"id": "quality_range", "type": "min_max", "column": "quality", "min": 0, "max": 1},
    {"id": "toxic_no", "type": "allowed_values", "column": "toxic", "values": [0], "severity": "warning"},
    {"id": "text_unique", "type": "unique", "column": "text", "digest": True},
    {"id": "toxic_unique", "type": "unique", "column": "toxic", "severity": "warning"},
    {"id": "lang_known", "type": "regex", "column": "lang", "pattern": "^(de|en|es|fr)$"},
    {"id": "good_or_clean", "type": "sql_expression", "expression": "quality = 1 OR toxic = 0"},
]


def suite_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.evaluate(table(spark, sf_dir, "orders"), "orders", ORDERS_SUITE).drop(*RUN_COLUMNS)


def suite_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The input is a join, so the unique rules share one run of it.
    labelled = table(spark, sf_dir, "labelled")
    return v.evaluate(labelled, "labelled", DOCUMENTS_SUITE, shared_scan=True).drop(*RUN_COLUMNS)


def suite_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing = table(spark, sf_dir, "orders").filter("o_totalprice < 0")
    return v.evaluate(nothing, "orders", ORDERS_SUITE).drop(*RUN_COLUMNS)


def suite_custom_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    v.register_row_check(
        "starts_with",
        lambda rule: F.col(rule.column).startswith(rule.params["prefix"]),
        requires=("column", "prefix"),
    )
    rules = [
        {"id": "name_prefix", "type": "starts_with", "column": "c_name", "prefix": "Customer#"},
        {"id": "segment_prefix", "type": "starts_with", "column": "c_mktsegment", "prefix": "B"},
    ]
    return v.evaluate(table(spark, sf_dir, "customer"), "customer", rules).drop(*RUN_COLUMNS)


# --- failing rows -------------------------------------------------------------


def failing_rows_of(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    name, rule = SINGLE_RULES[key]
    spec = {"id": key, **with_references(rule, sf_dir)}
    keys_path = scratch_path(spark, "keys") if rule["type"] == "unique" else None
    failing = v.failing_rows(table(spark, sf_dir, name), name, spec, keys_path)
    # Whole rows; times as text, so that no time zone enters the comparison.
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c, kind in failing.dtypes if kind.startswith("timestamp")}
    return failing.withColumns(times) if times else failing


# --- sources and sinks --------------------------------------------------------


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "scan-csv")
    v.write_table(table(spark, sf_dir, "customer"), path, "csv", "overwrite")
    return v.read_table(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def scan_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "scan-csv")
    customer = table(spark, sf_dir, "customer")
    v.write_table(customer, path, "csv", "overwrite")
    return v.read_table(spark, path, schema=customer.schema)


def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "scan-json")
    v.write_table(table(spark, sf_dir, "documents"), path, "JSON", "overwrite")
    return v.read_table(spark, path, "json")


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.read_table(spark, f"{sf_dir}/documents.parquet", "Parquet")


# --- results history ----------------------------------------------------------

# run id, run timestamp, dataset, rules; the last two runs share a timestamp.
RUNS = [
    ("run-a", dt.datetime(2024, 5, 1, 6, tzinfo=dt.timezone.utc), "orders", ORDERS_SUITE[:4]),
    (
        "run-b",
        dt.datetime(2024, 5, 2, 6, tzinfo=dt.timezone.utc),
        "orders",
        ORDERS_SUITE[3:7],
    ),
    (
        "run-c",
        dt.datetime(2024, 5, 2, 6, tzinfo=dt.timezone.utc),
        "customer",
        [
            {"id": "balance", "type": "min_max", "column": "c_acctbal", "min": 0, "severity": "warning"},
            {"id": "name_format", "type": "regex", "column": "c_name", "pattern": "^Customer#"},
            {"id": "segment", "type": "allowed_values", "column": "c_mktsegment", "values": SEGMENTS[:4]},
        ],
    ),
]


def store_runs(
    spark: SparkSession,
    sf_dir: str,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: tuple[str, ...] = ("run_date",),
) -> str:
    path = scratch_path(spark, "history")
    for run_id, when, name, rules in RUNS:
        results = v.evaluate(table(spark, sf_dir, name), name, rules, run_id, when)
        v.write_table(results, path, fmt, mode, partition_by, num_files=1)
    return path


def with_epoch(results: DataFrame) -> DataFrame:
    """The run's instant as a number, so that no time zone enters the comparison."""
    return results.withColumn("run_epoch", F.unix_seconds("run_timestamp")).drop("run_timestamp")


def results_partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_epoch(v.read_history(spark, store_runs(spark, sf_dir)))


def results_csv_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_epoch(v.read_history(spark, store_runs(spark, sf_dir, "csv"), "csv"))


def results_json_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_epoch(v.read_history(spark, store_runs(spark, sf_dir, "json"), "json"))


def results_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = store_runs(spark, sf_dir, mode="overwrite", partition_by=())
    return with_epoch(v.read_history(spark, path))


def history_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = v.read_history(spark, store_runs(spark, sf_dir))
    return with_epoch(history.filter("status = 'FAIL' AND severity = 'error'"))


def history_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = v.read_history(spark, store_runs(spark, sf_dir), dataset="orders")
    # Positions come from the order in which the rows really arrive.
    arrived = history.withColumn("arrived", F.monotonically_increasing_id())
    same_instant = Window.partitionBy("run_timestamp").orderBy("arrived")
    positioned = arrived.withColumn("position", F.row_number().over(same_instant).cast("bigint"))
    return with_epoch(positioned).select("run_epoch", "position", "status", "rule_id", "run_id")


def history_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = v.read_history(spark, store_runs(spark, sf_dir))
    return with_epoch(v.top_history(history, 5)).select("run_epoch", "status", "rule_id", "run_id")


def history_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_epoch(v.latest_run(v.read_history(spark, store_runs(spark, sf_dir))))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.run_summary(v.read_history(spark, store_runs(spark, sf_dir)))


def severity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.severity_gate(v.evaluate(table(spark, sf_dir, "orders"), "orders", ORDERS_SUITE))


def job_read_evaluate_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = v.run_job(
        spark,
        "orders",
        {"path": f"{sf_dir}/orders.parquet", "format": "parquet"},
        {"path": scratch_path(spark, "job")},
        ORDERS_SUITE,
    )
    return stored.drop(*RUN_COLUMNS)


def job_csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "job-source")
    v.write_table(table(spark, sf_dir, "orders"), path, "csv")
    stored = v.run_job(spark, "orders", {"path": path}, {"path": scratch_path(spark, "job")}, ORDERS_SUITE)
    return stored.drop(*RUN_COLUMNS)


# key: single rule
FAILING_ROWS: dict[str, str] = {
    "failing_rows_row_level": "rule_min_max_both",
    "failing_rows_pushed_down": "rule_min_max_integer",
    "failing_rows_regex": "rule_regex_fail",
    "failing_rows_null_verdict": "rule_allowed_values_null",
    "failing_rows_unique": "rule_unique_fail",
    "failing_rows_unique_digest": "rule_unique_digest",
    "failing_rows_custom_sql": "custom_sql_anti_join",
}


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {key: partial(single_rule, key) for key in SINGLE_RULES}
    for key, rule_key in FAILING_ROWS.items():
        found[key] = partial(failing_rows_of, rule_key)
    for query in (
        suite_orders,
        suite_documents,
        suite_empty,
        suite_custom_rule,
        scan_csv,
        scan_csv_schema,
        scan_json,
        scan_parquet,
        results_partitioned_append,
        results_csv_append,
        results_json_append,
        results_overwrite,
        history_errors,
        history_ordered,
        history_top,
        history_latest_run,
        run_summary,
        severity_gate,
        job_read_evaluate_write,
        job_csv_source,
    ):
        found[query.__name__] = query
    return found
