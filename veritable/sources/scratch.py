"""Tables that a plan writes for itself, in a folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

from veritable.sources.files import Folder

_MADE: ContextVar[list[str] | None] = ContextVar("scratch_tables", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, else under the warehouse folder.

    The first is taken to be shared, whatever its scheme: that is what it is for. By
    default the warehouse is a folder of the driver's machine, so without a local master it is refused
    unless it lies in a file system of its own. Tables stay until the caller removes
    them, see ``recorded``, or the cluster cleans that folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir")
        local = spark.conf.get("spark.master", "local").startswith("local")
        if not local and urlparse(base).scheme in ("", "file"):
            raise ValueError(f"Set spark.checkpoint.dir to a folder that all executors share; {base!r} is the driver's own")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths that are handed out inside the block, to be removed when nothing reads them any more."""
    made: list[str] = []
    before = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(before)


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        Folder(spark, path).remove()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read back: its lineage ends here.

    What is read back survives lost executors, and Spark knows its true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
