"""Reading accumulated results back, and the reports made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritable.plans.compaction import CSV_OPTIONS, Manifest, live_files, read_files, read_manifest
from veritable.plans.results import RESULT_SCHEMA
from veritable.sources.files import Folder
from veritable.sources.tables import check_format, read_table

# Statuses, the severity that blocks, rows shown by default.
FAIL = "FAIL"
BLOCKING_SEVERITY = "error"
DEFAULT_TOP = 200


def history_order() -> list:
    """Newest run first, failures before passes, then a stable order."""
    return [F.desc("run_timestamp"), F.asc("status"), F.asc("rule_id"), F.asc("run_id")]


def stored_results(
    spark: SparkSession, path: str, fmt: str = "parquet", dataset: str | None = None
) -> DataFrame:
    """All stored results, unordered, under the fixed schema (no inference).

    Of a compacted history the files are listed now, and those that count are read.
    """
    fmt = check_format(fmt)
    folder = Folder(spark, path)
    manifest = read_manifest(folder)
    if manifest is None:
        options = CSV_OPTIONS if fmt == "csv" else {}
        stored = read_table(spark, path, fmt, RESULT_SCHEMA, **options).select(*RESULT_SCHEMA.fieldNames())
    else:
        stored = read_files(spark, path, fmt, live_files(folder, manifest))
    return stored if dataset is None else stored.filter(F.col("dataset") == dataset)


def read_history(
    spark: SparkSession, path: str, fmt: str = "parquet", dataset: str | None = None
) -> DataFrame:
    """All stored results in history order, of one dataset if named."""
    return stored_results(spark, path, fmt, dataset).orderBy(*history_order())


def top_history(history: DataFrame, n: int = DEFAULT_TOP) -> DataFrame:
    """The first ``n`` rows in history order."""
    return history.orderBy(*history_order()).limit(n)


def latest_run(history: DataFrame) -> DataFrame:
    """The results of the newest run; no rows when the history is empty.

    The newest row is found by an aggregate, one row a task. Its date is asked for as
    well, so that a stored history is read in the newest partition only; a run has one
    timestamp, hence one date.
    """
    first = F.struct((-F.unix_micros("run_timestamp")).alias("age"), "status", "rule_id", "run_id", "run_date")
    newest = history.agg(F.min(first).alias("newest")).select(F.struct("newest.run_id", "newest.run_date").alias("run")).scalar()
    # Both conditions name the same subquery, which is run once.
    return history.filter((F.col("run_date") == newest["run_date"]) & (F.col("run_id") == newest["run_id"]))


def latest_stored_run(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest run of a history that is partitioned by ``run_date``, from its newest partition alone.

    The dates are the names of folders, so nothing else is read to find it.
    """
    folder = Folder(spark, path)
    manifest = read_manifest(folder)
    files = live_files(folder, manifest or Manifest(depth=1))
    dates = [name.split("/")[0] for name in files if name.startswith("run_date=")]
    newest = [name for name in files if name.split("/")[0] == max(dates, default="")]
    return latest_run(read_files(spark, path, check_format(fmt), newest))


def run_summary(results: DataFrame) -> DataFrame:
    """Failed and total number of rules per run and dataset."""
    return results.groupBy("run_id", "dataset").agg(
        F.count_if(F.col("status") == FAIL).alias("failed_rules"),
        F.count(F.lit(1)).alias("total_rules"),
    )


def severity_gate(results: DataFrame) -> DataFrame:
    """One row: failed rules of blocking severity, and whether they block."""
    blocking = (F.col("status") == FAIL) & (F.col("severity") == BLOCKING_SEVERITY)
    return results.agg(F.count_if(blocking).alias("blocking_failures")).withColumn(
        "blocked", F.col("blocking_failures") > 0
    )
