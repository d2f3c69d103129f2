"""Read, evaluate, write: the whole batch job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritable.plans.commits import commit_run
from veritable.plans.history import stored_results
from veritable.plans.suite import CheckSuite
from veritable.rules import Rule
from veritable.sources.tables import UNREADABLE, check_format, read_table, write_table

# Defaults of the source and destination settings.
SOURCE_FORMAT = "csv"
DESTINATION_FORMAT = "parquet"
WRITE_MODE = "append"
PARTITION_BY = ("run_date",)


def run_job(
    spark: SparkSession,
    dataset: str,
    source: Mapping[str, Any],
    destination: Mapping[str, Any],
    rules: Iterable[Rule | Mapping[str, Any]],
    run_id: str | None = None,
    run_timestamp: dt.datetime | None = None,
) -> DataFrame:
    """Evaluate ``rules`` on ``source``, store the results, return this run's.

    ``source`` takes ``path``, ``format`` and optionally ``schema``, and ``unreadable``,
    the column for lines that could not be read (named by a ``readable`` rule otherwise);
    ``destination`` takes ``path``, ``format``, ``write_mode`` and
    ``partition_by``. Results are stored whether or not rules fail. What is
    returned is the stored run, so looking at it again rescans a few rows and
    not the source. Under ``append`` a run is stored once: repeated under its run
    id, say after it was killed, it replaces what it stored before. Under write mode
    ``ignore``, which may store nothing, the unevaluated plan is returned instead.
    """
    suite = CheckSuite(dataset, rules, run_id, run_timestamp)
    if not suite.rules:
        raise ValueError("A job needs at least one rule")
    path, mode = destination["path"], destination.get("write_mode", WRITE_MODE)
    fmt = check_format(destination.get("format", DESTINATION_FORMAT))

    source_fmt = check_format(source.get("format", SOURCE_FORMAT))
    asked = [rule.column or UNREADABLE for rule in suite.rules if rule.type == "readable"]
    unreadable = source.get("unreadable", asked[0] if asked else None)
    data = read_table(spark, source["path"], source_fmt, source.get("schema"), unreadable)
    if unreadable is not None and source_fmt == "parquet":
        data = data.withColumn(unreadable, F.lit(None).cast("string"))  # unreadable files stop the job
    # Text has to be parsed whole by every scan, so the unique rules share one.
    results = suite.evaluate(data, shared_scan=source_fmt != "parquet")
    partition_by = destination.get("partition_by", PARTITION_BY) or ()
    if mode.lower() == "append":
        commit_run(results, path, dataset, suite.run_id, fmt, partition_by)
    else:
        write_table(results, path, fmt, mode, partition_by, num_files=1)
    if mode.lower() == "ignore":
        return results

    rule_order = F.array(*[F.lit(rule.id) for rule in suite.rules])
    return (
        stored_results(spark, path, fmt)
        .filter(F.col("run_date") == suite.run_timestamp.date().isoformat())
        .filter((F.col("run_id") == suite.run_id) & (F.col("dataset") == dataset))
        .orderBy(F.array_position(rule_order, F.col("rule_id")))
    )
