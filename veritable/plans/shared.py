"""One read of a dear dataset for all rules: the columns they need, stored first."""

from __future__ import annotations

import contextlib
import io
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veritable.sources.files import Folder, join

_SCAN = re.compile(r"^Location: (?P<place>.*)$|^ReadSchema: struct<(?P<columns>.*)>$", re.MULTILINE)
_FIELDS = "spark.sql.debug.maxToStringFields"


def needed_columns(df: DataFrame, plan: Callable[[DataFrame], DataFrame], folder: str) -> list[str]:
    """The columns of ``df`` that ``plan`` reads, by planning it over an empty table of the same columns.

    Every scan of that table in the plan, in subqueries too, names the columns it reads.
    """
    spark = df.sparkSession
    probe = join(folder, "columns")
    numbered = [f"c{i}" for i in range(len(df.columns))]
    # The table's own columns are numbered, so that no name has to be read out of a text.
    df.limit(0).toDF(*numbered).write.parquet(probe)
    empty = spark.read.schema(df.toDF(*numbered).schema).parquet(probe).toDF(*df.columns)
    shown = _explained(spark, plan(empty))
    Folder(spark, probe).remove()
    used: set[str] = set()
    at = ""
    for found in _SCAN.finditer(shown):
        if found["place"] is not None:
            at = found["place"]
        elif probe.rstrip("/").rsplit("/", 2)[-2] in at:
            used |= set(re.findall(r"(?:^|,)(c\d+):", found["columns"]))
    return [name for name, number in zip(df.columns, numbered, strict=True) if number in used]


def _explained(spark: SparkSession, df: DataFrame) -> str:
    before = spark.conf.get(_FIELDS)
    spark.conf.set(_FIELDS, "100000")
    try:
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.explain("formatted")
        return text.getvalue()
    finally:
        spark.conf.set(_FIELDS, before)


def stored_columns(df: DataFrame, plan: Callable[[DataFrame], DataFrame], folder: str) -> DataFrame:
    """``df`` read once: what ``plan`` needs of it, written below ``folder`` and read back.

    If nothing is needed but the number of rows, the first column is kept for that.
    """
    kept = [f"`{name.replace('`', '``')}`" for name in needed_columns(df, plan, folder) or df.columns[:1]]
    narrow = df.select(*kept)
    path = join(folder, "rows")
    narrow.write.parquet(path)
    return df.sparkSession.read.schema(narrow.schema).parquet(path)
