"""Reading and writing tables in the supported formats, at any Spark path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The formats accepted by sources and sinks, and the options
# each of them is used with.
FORMATS = ("csv", "json", "parquet")
READ_OPTIONS = {"csv": {"header": "true"}, "json": {}, "parquet": {}}
# Spark's text formats would cut timestamps off at milliseconds.
TIMESTAMPS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# The CSV writer would trim text.
UNTRIMMED = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
WRITE_OPTIONS = {"csv": {"header": "true", **UNTRIMMED, **TIMESTAMPS}, "json": TIMESTAMPS, "parquet": {}}


#: The column that holds lines which could not be read, where one is asked for.
UNREADABLE = "__unreadable"


def check_format(fmt: str) -> str:
    name = fmt.lower()
    if name not in FORMATS:
        raise ValueError(f"Unsupported format {fmt!r}; choose one of {list(FORMATS)}")
    return name


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    schema: StructType | str | None = None,
    unreadable: str | None = None,
    **options: str,
) -> DataFrame:
    """Scan a file or directory.

    Without a schema, CSV and JSON types are inferred, which reads the source
    once more; pass one for anything large.

    ``unreadable`` names a further column, for CSV and JSON: the text of a line that
    does not parse, or does not fit the schema, and NULL for all others. Such a line is
    a row whose other columns hold what could be read of it.
    """
    fmt = check_format(fmt)
    if unreadable is not None and fmt != "parquet":
        return _with_unreadable(spark, path, fmt, schema, unreadable, options)
    reader = spark.read.format(fmt).options(**{**READ_OPTIONS[fmt], **options})
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.load(path)


def _with_unreadable(
    spark: SparkSession, path: str, fmt: str, schema: StructType | str | None, name: str, options: dict[str, str]
) -> DataFrame:
    if schema is None:
        schema = read_table(spark, path, fmt, columnNameOfCorruptRecord=name, **options).schema
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    fields = [field for field in schema.fields if field.name != name]
    reader = spark.read.format(fmt).options(**{**READ_OPTIONS[fmt], **options})
    reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=name)
    df = reader.schema(StructType([*fields, StructField(name, StringType())])).load(path)
    # Only columns that are asked for are parsed, and a line is found bad only by what is
    # parsed. No text repeated any number of times is no text, but needs all columns.
    columns = [f"`{field.name.replace('`', '``')}`" for field in fields]
    nothing = f"repeat('', CAST(xxhash64({', '.join(columns)}) % 8 AS INT))"
    return df.withColumn(name, F.expr(f"concat(`{name}`, {nothing})"))


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: Sequence[str] | None = None,
    num_files: int | None = None,
) -> None:
    """Write a table, by default in the frame's own partitioning.

    ``num_files`` deals the rows to so many tasks first: one is right for a
    results table (a row per rule), and for nothing that grows. ``overwrite``
    follows the session's partition overwrite mode: static by default, replacing
    every partition.
    """
    fmt = check_format(fmt)
    if num_files is not None:
        # A shuffle of a few rows; coalesce() would instead pull the stage that
        # produces them down to that many tasks.
        df = df.repartition(num_files)
    writer = df.write.format(fmt).options(**WRITE_OPTIONS[fmt]).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
