"""The results table: one row per rule, built inside the plan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritable.rules import Rule

# Columns of the results table, in order.
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("run_timestamp", T.TimestampType(), False),
        T.StructField("run_date", T.StringType(), False),
        T.StructField("dataset", T.StringType(), False),
        T.StructField("rule_id", T.StringType(), False),
        T.StructField("rule_type", T.StringType(), False),
        T.StructField("column_name", T.StringType(), True),
        T.StructField("severity", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("total_records", T.LongType(), False),
        T.StructField("failed_records", T.LongType(), False),
        T.StructField("passed_records", T.LongType(), False),
        T.StructField("pass_rate", T.DoubleType(), False),
        T.StructField("status", T.StringType(), False),
    ]
)

#: The status of a rule that raised, where rules are isolated.
ERROR = "ERROR"

_RULE_COLUMNS = ("rule_id", "rule_type", "column_name", "severity", "description", "failed_records")


def side_by_side(
    parts: Sequence[DataFrame], pairs: Sequence[DataFrame], names: Sequence[str]
) -> DataFrame:
    """One row with the counts ``names``, from one-row frames and (name, n) pairs.

    They meet in a union of pairs, a handful per frame. Its branches are
    independent, so Spark starts their first stages together. Scalar subqueries
    would do as well, but a query may hold subqueries of its own, and enough
    waiting for each other exhaust Spark's subquery threads.
    """
    if len(parts) == 1 and not pairs:
        return parts[0]
    unpivoted = []
    for part in parts:
        structs = [f"struct('{name}' AS name, {name} AS n)" for name in part.columns]
        unpivoted.append(part.selectExpr(f"inline(array({', '.join(structs)}))"))
    counts = reduce(DataFrame.union, [*unpivoted, *pairs]).selectExpr(
        "map_from_entries(collect_list(struct(name, n))) AS counts"
    )
    return counts.selectExpr(*[f"counts['{name}'] AS {name}" for name in names])


def long_form(
    counts: DataFrame,
    rules: Sequence[Rule],
    failed: Sequence[Column],
    total: str,
    dataset: str,
    run_id: str,
    run_timestamp: dt.datetime,
) -> DataFrame:
    """Turn the one-row frame of counts into one row per rule, in rule order.

    A query can return more rows than the dataset holds (a fan-out join);
    passed_records and pass_rate then go below zero, by definition.
    """
    literal = cache(F.lit)  # most rules share their type, severity and so on
    entries = F.array(
        *[
            F.struct(
                *[
                    literal(value)
                    for value in (rule.id, rule.type, rule.column, rule.severity, rule.description)
                ],
                count,
            )
            for rule, count in zip(rules, failed, strict=True)
        ]
    )
    return (
        counts.select(
            F.expr(f"coalesce({total}, 0L)").alias("total_records"),
            F.inline(entries).alias(*_RULE_COLUMNS),
        )
        .select(
            F.lit(run_id).alias("run_id"),
            F.lit(run_timestamp).cast(T.TimestampType()).alias("run_timestamp"),
            F.lit(run_timestamp.date().isoformat()).alias("run_date"),
            F.lit(dataset).alias("dataset"),
            "*",
        )
        .selectExpr(
            "run_id",
            "run_timestamp",
            "run_date",
            "dataset",
            "rule_id",
            "rule_type",
            "CAST(column_name AS STRING) AS column_name",
            "severity",
            "CAST(description AS STRING) AS description",
            "total_records",
            "failed_records",
            "total_records - failed_records AS passed_records",
            "coalesce((total_records - failed_records) / nullif(total_records, 0), 1D) AS pass_rate",
            "CASE WHEN failed_records = 0 THEN 'PASS' ELSE 'FAIL' END AS status",
        )
    )
