"""The same results in DuckDB SQL, written from the rules' definitions."""

from __future__ import annotations

LABELLED = "(SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


def text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"


def results(dataset: str, rows: list[tuple], run: str = "") -> str:
    """One result row per (rule_id, type, column, severity, description, total, failed)."""
    facts = " UNION ALL ".join(
        f"SELECT {text(rule_id)} AS rule_id, {text(kind)} AS rule_type, {text(column)} AS column_name, "
        f"{text(severity)} AS severity, {text(description)} AS description, "
        f"CAST(({total}) AS BIGINT) AS total_records, "
        f"CAST(COALESCE(({failed}), 0) AS BIGINT) AS failed_records"
        for rule_id, kind, column, severity, description, total, failed in rows
    )
    return (
        f"SELECT {run}{text(dataset)} AS dataset, *, total_records - failed_records AS passed_records, "
        "CASE WHEN total_records = 0 THEN CAST(1 AS DOUBLE) "
        "ELSE (total_records - failed_records)::DOUBLE / total_records END AS pass_rate, "
        "CASE WHEN failed_records = 0 THEN 'PASS' ELSE 'FAIL' END AS status "
        f"FROM ({facts})"
    )


def count(source: str, where: str = "TRUE") -> str:
    return f"SELECT COUNT(*) FROM {source} WHERE {where}"


def invalid(source: str, valid: str) -> str:
    """Rows whose verdict is not TRUE, NULL verdicts included."""
    return count(source, f"({valid}) IS NOT TRUE")


def repeated(source: str, column: str) -> str:
    return (
        f"SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM {source} GROUP BY {column}) WHERE n > 1"
    )


def rows_of(query: str) -> str:
    return f"SELECT COUNT(*) FROM ({query})"


def one_rule(key: str, dataset: str, kind: str, column: str | None, failed: str) -> str:
    source = LABELLED if dataset == "labelled" else dataset
    return results(dataset, [(key, kind, column, "error", "", count(source), failed)])


SEGMENTS = "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"

BELOW_MEAN = "c_acctbal < (SELECT AVG(c_acctbal) - {} * STDDEV_POP(c_acctbal) FROM customer)"

# key: (dataset, rule type, column, number of failures)
SINGLE = {
    "rule_not_null_pass": ("orders", "not_null", "o_orderkey", count("orders", "o_orderkey IS NULL")),
    "rule_not_null_fail": ("labelled", "not_null", "quality", count(LABELLED, "quality IS NULL")),
    "rule_unique_pass": ("orders", "unique", "o_orderkey", repeated("orders", "o_orderkey")),
    "rule_unique_fail": ("documents", "unique", "text", repeated("documents", "text")),
    "rule_unique_digest": ("documents", "unique", "text", repeated("documents", "text")),
    "rule_unique_nulls": ("labelled", "unique", "quality", repeated(LABELLED, "quality")),
    "rule_unique_heavy": ("orders", "unique", "o_custkey", repeated("orders", "o_custkey")),
    "rule_min_max_both": (
        "lineitem",
        "min_max",
        "l_quantity",
        invalid("lineitem", "l_quantity BETWEEN 5 AND 45"),
    ),
    "rule_min_max_min_only": ("customer", "min_max", "c_acctbal", invalid("customer", "c_acctbal >= 0")),
    "rule_min_max_max_only": (
        "lineitem",
        "min_max",
        "l_discount",
        invalid("lineitem", "l_discount <= CAST(0.08 AS DOUBLE)"),
    ),
    "rule_min_max_integer": (
        "lineitem",
        "min_max",
        "l_linenumber",
        invalid("lineitem", "l_linenumber BETWEEN 2 AND 6"),
    ),
    "rule_min_max_null": ("labelled", "min_max", "quality", invalid(LABELLED, "quality >= 0")),
    "rule_min_max_null_bound": (
        "orders",
        "min_max",
        "o_totalprice",
        invalid("orders", "o_totalprice >= 0 AND o_totalprice <= NULL"),
    ),
    "rule_allowed_values_pass": (
        "customer",
        "allowed_values",
        "c_mktsegment",
        invalid("customer", f"c_mktsegment IN {SEGMENTS}"),
    ),
    "rule_allowed_values_fail": (
        "orders",
        "allowed_values",
        "o_orderstatus",
        invalid("orders", "o_orderstatus IN ('F', 'O')"),
    ),
    "rule_allowed_values_null": ("labelled", "allowed_values", "quality", invalid(LABELLED, "quality IN (1)")),
    "rule_regex_pass": (
        "customer",
        "regex",
        "c_name",
        invalid("customer", "regexp_matches(c_name, '^Customer#[0-9]{9}$')"),
    ),
    "rule_regex_fail": ("pages", "regex", "url", invalid("pages", "regexp_matches(url, '^https://')")),
    "rule_regex_prefix": (
        "orders",
        "regex",
        "o_orderpriority",
        invalid("orders", "regexp_matches(o_orderpriority, '^[1-3]-')"),
    ),
    "rule_sql_expression_columns": (
        "lineitem",
        "sql_expression",
        None,
        invalid("lineitem", "l_tax <= l_discount"),
    ),
    "rule_sql_expression_arith": (
        "lineitem",
        "sql_expression",
        None,
        invalid("lineitem", "l_extendedprice * (1 - l_discount) <= 90000"),
    ),
    "rule_sql_expression_string": (
        "documents",
        "sql_expression",
        None,
        invalid("documents", "length(text) = n_chars"),
    ),
    "rule_sql_expression_json": (
        "events",
        "sql_expression",
        None,
        invalid("events", "CAST(json_extract_string(props, '$.k') AS INTEGER) < 50"),
    ),
    "custom_sql_threshold_fail": (
        "customer",
        "custom_sql",
        None,
        count("customer", BELOW_MEAN.format("1.5")),
    ),
    "custom_sql_threshold_pass": (
        "customer",
        "custom_sql",
        None,
        count("customer", BELOW_MEAN.format("4")),
    ),
    "custom_sql_in_list": (
        "customer",
        "custom_sql",
        None,
        count(
            "customer",
            "c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey NOT IN (3, 7, 11)",
        ),
    ),
    "custom_sql_anti_join": (
        "orders",
        "custom_sql",
        None,
        count("orders", "NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"),
    ),
    "custom_sql_anti_join_pass": (
        "lineitem",
        "custom_sql",
        None,
        count("lineitem", "NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)"),
    ),
    "custom_sql_reference_table": (
        "documents",
        "custom_sql",
        None,
        count("documents d", "NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"),
    ),
    "custom_sql_reference_join": (
        "lineitem",
        "custom_sql",
        None,
        count("lineitem JOIN orders ON l_orderkey = o_orderkey", "l_shipdate < o_orderdate"),
    ),
    "custom_sql_group_by_having": (
        "orders",
        "custom_sql",
        None,
        rows_of("SELECT o_custkey FROM orders GROUP BY o_custkey HAVING COUNT(*) > 15"),
    ),
    "custom_sql_composite_key": (
        "lineitem",
        "custom_sql",
        None,
        rows_of("SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"),
    ),
    "custom_sql_self_join": (
        "documents",
        "custom_sql",
        None,
        "SELECT SUM(n - 1) FROM (SELECT COUNT(*) AS n FROM documents GROUP BY text)",
    ),
    "custom_sql_subquery": (
        "events",
        "custom_sql",
        None,
        count("events", "value > 5 * (SELECT AVG(value) FROM events)"),
    ),
    "custom_sql_fanout": (
        "nation",
        "custom_sql",
        None,
        count("customer", "c_nationkey IN (SELECT n_nationkey FROM nation)"),
    ),
}


def orders_suite(source: str = "orders") -> list[tuple]:
    total = count(source)
    days = f"SELECT COUNT(*) AS n FROM {source} GROUP BY o_orderdate"
    return [
        ("order_key_present", "not_null", "o_orderkey", "error", "key is set", total,
         count(source, "o_orderkey IS NULL")),
        ("order_key_unique", "unique", "o_orderkey", "error", "", total, repeated(source, "o_orderkey")),
        ("customer_once", "unique", "o_custkey", "warning", "", total, repeated(source, "o_custkey")),
        ("price_range", "min_max", "o_totalprice", "error", "", total,
         invalid(source, "o_totalprice BETWEEN 1000 AND 400000")),
        ("status_known", "allowed_values", "o_orderstatus", "error", "", total,
         invalid(source, "o_orderstatus IN ('F', 'O')")),
        ("priority_format", "regex", "o_orderpriority", "error", "", total,
         invalid(source, "regexp_matches(o_orderpriority, '^[1-3]-')")),
        ("price_per_key", "sql_expression", None, "error", "", total,
         invalid(source, "o_totalprice >= o_custkey")),
        ("busy_days", "custom_sql", None, "warning", "days with over twice the orders of the mean day", total,
         f"SELECT COUNT(*) FROM ({days}) WHERE n > 2 * (SELECT AVG(n) FROM ({days}))"),
    ]


def documents_suite() -> list[tuple]:
    total = count(LABELLED)
    return [
        ("quality_present", "not_null", "quality", "error", "", total, count(LABELLED, "quality IS NULL")),
        ("quality_range", "min_max", "quality", "error", "", total,
         invalid(LABELLED, "quality BETWEEN 0 AND 1")),
        ("toxic_no", "allowed_values", "toxic", "warning", "", total, invalid(LABELLED, "toxic IN (0)")),
        ("text_unique", "unique", "text", "error", "", total, repeated(LABELLED, "text")),
        ("toxic_unique", "unique", "toxic", "warning", "", total, repeated(LABELLED, "toxic")),
        ("lang_known", "regex", "lang", "error", "", total,
         invalid(LABELLED, "regexp_matches(lang, '^(de|en|es|fr)$')")),
        ("good_or_clean", "sql_expression", None, "error", "", total,
         invalid(LABELLED, "quality = 1 OR toxic = 0")),
    ]


def customer_suite() -> list[tuple]:
    total = count("customer")
    return [
        ("balance", "min_max", "c_acctbal", "warning", "", total, invalid("customer", "c_acctbal >= 0")),
        ("name_format", "regex", "c_name", "error", "", total,
         invalid("customer", "regexp_matches(c_name, '^Customer#')")),
        ("segment", "allowed_values", "c_mktsegment", "error", "", total,
         invalid("customer", "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')")),
    ]


def history() -> str:
    def run(run_id: str, day: str) -> str:
        return (
            f"'{run_id}' AS run_id, CAST(epoch(TIMESTAMP '{day} 06:00:00') AS BIGINT) AS run_epoch, "
            f"'{day}' AS run_date, "
        )

    return " UNION ALL BY NAME ".join(
        [
            results("orders", orders_suite()[:4], run("run-a", "2024-05-01")),
            results("orders", orders_suite()[3:7], run("run-b", "2024-05-02")),
            results("customer", customer_suite(), run("run-c", "2024-05-02")),
        ]
    )


LINEITEM = "* REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate)"
ORDERS = "* REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate)"


def all_oracles() -> dict[str, str]:
    found = {key: one_rule(key, *spec) for key, spec in SINGLE.items()}
    prefixes = [
        ("name_prefix", "starts_with", "c_name", "error", "", count("customer"),
         invalid("customer", "c_name LIKE 'Customer#%'")),
        ("segment_prefix", "starts_with", "c_mktsegment", "error", "", count("customer"),
         invalid("customer", "c_mktsegment LIKE 'B%'")),
    ]
    found |= {
        "suite_orders": results("orders", orders_suite()),
        "suite_documents": results("labelled", documents_suite()),
        "suite_empty": results("orders", orders_suite("(SELECT * FROM orders WHERE o_totalprice < 0)")),
        "suite_custom_rule": results("customer", prefixes),
        "job_read_evaluate_write": results("orders", orders_suite()),
        "job_csv_source": results("orders", orders_suite()),
        "severity_gate": (
            "SELECT COUNT(*) AS blocking_failures, COUNT(*) > 0 AS blocked "
            f"FROM ({results('orders', orders_suite())}) WHERE status = 'FAIL' AND severity = 'error'"
        ),
        "failing_rows_row_level": (
            f"SELECT {LINEITEM} FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45"
        ),
        "failing_rows_pushed_down": (
            f"SELECT {LINEITEM} FROM lineitem WHERE l_linenumber < 2 OR l_linenumber > 6"
        ),
        "failing_rows_regex": "SELECT * FROM pages WHERE NOT regexp_matches(url, '^https://')",
        "failing_rows_null_verdict": (
            f"SELECT * FROM {LABELLED} "
            "WHERE quality IS NULL OR quality <> 1"
        ),
        "failing_rows_unique": (
            "SELECT * FROM documents WHERE text IN "
            "(SELECT text FROM documents GROUP BY text HAVING COUNT(*) > 1)"
        ),
        "failing_rows_unique_digest": (
            "SELECT * FROM documents WHERE text IN "
            "(SELECT text FROM documents GROUP BY text HAVING COUNT(*) > 1)"
        ),
        "failing_rows_custom_sql": (
            f"SELECT {ORDERS} FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"
        ),
        "scan_csv": "SELECT * FROM customer",
        "scan_csv_schema": "SELECT * FROM customer",
        "scan_json": "SELECT * FROM documents",
        "scan_parquet": "SELECT * FROM documents",
        "results_partitioned_append": history(),
        "results_csv_append": history(),
        "results_json_append": history(),
        "results_overwrite": f"SELECT * FROM ({history()}) WHERE run_id = 'run-c'",
        "history_errors": (
            f"SELECT * FROM ({history()}) WHERE status = 'FAIL' AND severity = 'error'"
        ),
        "history_ordered": (
            "SELECT run_epoch, status, rule_id, run_id, ROW_NUMBER() OVER "
            "(PARTITION BY run_epoch ORDER BY status, rule_id, run_id) AS position "
            f"FROM ({history()}) WHERE dataset = 'orders'"
        ),
        "history_top": (
            f"SELECT run_epoch, status, rule_id, run_id FROM ({history()}) "
            "ORDER BY run_epoch DESC, status, rule_id, run_id LIMIT 5"
        ),
        "history_latest_run": (
            f"WITH h AS ({history()}) SELECT * FROM h WHERE run_id = "
            "(SELECT run_id FROM h ORDER BY run_epoch DESC, status, rule_id, run_id LIMIT 1)"
        ),
        "run_summary": (
            "SELECT run_id, dataset, COUNT(*) FILTER (WHERE status = 'FAIL') AS failed_rules, "
            f"COUNT(*) AS total_rules FROM ({history()}) GROUP BY run_id, dataset"
        ),
    }
    return found
