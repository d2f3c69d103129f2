"""The ``foreign_key`` rule: a value that the reference column does not hold is a failure.

Whole numbers are looked up in bitmaps of the reference's keys, one of 4 KB for every
32,768 neighbouring numbers that hold a key. They are broadcast, so the dataset is not
shuffled at all. That is done only if they take ``BITMAP_BYTES`` at most, whatever the
reference's size: a job over the reference's column finds its range and number of keys
first, which bound the number of bitmaps. Beyond that, and for values of other types,
the dataset's distinct values are joined with those of the reference, counted map-side
first, so a value that a third of all rows have is one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritable.functions.columns import column_type
from veritable.rules import Rule
from veritable.sources.tables import read_table

BITMAP_BYTES = 32 << 20
_ONE_BITMAP = 4096
_KEY = "__reference_key"
_VALUE = "__checked_value"
_COPIES = "__copies"


def check_reference(rule: Rule) -> None:
    """Refuse a rule whose reference cannot be read."""
    reference = rule.params["reference"]
    missing = [key for key in ("path", "column") if not reference.get(key)]
    if missing:
        raise ValueError(f"foreign_key rule {rule.id!r}: its reference requires {missing}")


def _reference_keys(spark: SparkSession, rule: Rule) -> DataFrame:
    reference = rule.params["reference"]
    table = read_table(spark, reference["path"], reference.get("format", "parquet"), reference.get("schema"))
    return table.select(F.col(reference["column"]).alias(_KEY)).where(F.col(_KEY).isNotNull())


def _bitmaps(df: DataFrame, rule: Rule, keys: DataFrame) -> DataFrame | None:
    """(bucket, bits) of the reference's keys, if both sides are whole numbers and they are few."""
    if not isinstance(column_type(df, rule.column), T.IntegralType) or not isinstance(keys.schema[_KEY].dataType, T.IntegralType):
        return None
    least, most, count = keys.agg(F.min(_KEY), F.max(_KEY), F.count(F.lit(1))).first()
    if count and min((most - least) // (8 * _ONE_BITMAP) + 2, count) * _ONE_BITMAP > rule.params.get("bitmap_bytes", BITMAP_BYTES):
        return None
    return keys.groupBy(F.bitmap_bucket_number(_KEY).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(_KEY)).alias("__bits")
    )


def _hit(value: Column) -> Column:
    """Whether the value's bit is set; NULL without a bitmap."""
    position = F.bitmap_bit_position(value).cast("int")
    byte = F.conv(F.hex(F.expr("__bits").substr(F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, position % 8).bitwiseAND(F.lit(1)) == 1


def _missing_values(df: DataFrame, rule: Rule, keys: DataFrame) -> DataFrame:
    """(value, copies): the dataset's distinct values that the reference lacks, NULL among them."""
    values = df.groupBy(F.col(rule.column).alias(_VALUE)).agg(F.count(F.lit(1)).alias(_COPIES))
    return values.join(keys.distinct(), F.col(_VALUE) == F.col(_KEY), "left_anti")


def missing_count(df: DataFrame, rule: Rule, name: str) -> DataFrame:
    """One (name, n) pair with the number of rows whose value the reference lacks."""
    keys = _reference_keys(df.sparkSession, rule)
    bitmaps = _bitmaps(df, rule, keys)
    if bitmaps is None:
        return _missing_values(df, rule, keys).agg(F.lit(name).alias("name"), F.coalesce(F.sum(_COPIES), F.lit(0)).alias("n"))
    looked_up = _looked_up(df.select(F.col(rule.column).alias(_VALUE)), F.col(_VALUE), bitmaps, name)
    return looked_up.agg(F.lit(name).alias("name"), F.count(F.when(F.col(name), True)).alias("n"))


def _looked_up(df: DataFrame, value: Column, bitmaps: DataFrame, name: str) -> DataFrame:
    on = F.bitmap_bucket_number(value) == F.col("__bucket")
    found = df.join(F.broadcast(bitmaps), on, "left")
    return found.withColumn(name, ~F.coalesce(_hit(value), F.lit(False))).drop("__bucket", "__bits")


def with_missing(df: DataFrame, rule: Rule, name: str) -> DataFrame:
    """``df`` with a column that is TRUE where the reference lacks the row's value."""
    keys = _reference_keys(df.sparkSession, rule)
    bitmaps = _bitmaps(df, rule, keys)
    if bitmaps is not None:
        return _looked_up(df, F.col(rule.column), bitmaps, name)
    missing = _missing_values(df, rule, keys).select(_VALUE, F.lit(True).alias(name))
    joined = df.withColumn(_KEY, F.col(rule.column)).join(missing, F.col(_KEY).eqNullSafe(F.col(_VALUE)), "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(False))).drop(_KEY, _VALUE)
