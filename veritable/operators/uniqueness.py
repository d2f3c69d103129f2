"""The ``unique`` rule: every member of a duplicate group is a failure."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritable.functions.columns import column_type
from veritable.rules import Rule
from veritable.sources.tables import read_table, write_table

_KEY = "__unique_key"
_REPEATED = "__repeated_key"
_COPIES = "__copies"
_SET = "__grouping_set"


def by_digest(rule: Rule) -> bool:
    """Whether a rule asks for its values to be grouped by digest."""
    return bool(rule.params.get("digest", False))


def group_key(df: DataFrame, column: str, digest: bool = False) -> Column:
    """What values are grouped by: themselves, or with ``digest`` their SHA-256.

    The digest is for long text and binary values, of which 32 bytes travel
    then, whatever their length. Other types, and text under a collation (where
    different bytes may be equal), are grouped as they are.
    """
    value = F.col(column)
    if not digest:
        return value
    kind = column_type(df, column)
    binary_text = isinstance(kind, T.StringType) and kind.isUTF8BinaryCollation()
    if not binary_text and not isinstance(kind, T.BinaryType):
        return value
    return F.unhex(F.sha2(value.cast("binary"), 256))


def duplicate_counts(df: DataFrame, columns: Mapping[str, tuple[str, bool]], total: str) -> DataFrame:
    """One row: the number of rows, and per name the rows whose value repeats.

    ``columns`` maps output names to a column and whether its values are grouped
    by digest. NULLs form one group, as they do
    in GROUP BY. Groups are counted map-side first, so a hot value reaches its
    reducer as one row per task. Several columns share one scan by way of
    grouping sets, at the price of shuffling them all at once.
    """
    keys = [f"{_KEY}_{i}" for i in range(len(columns))]
    keyed = df.select(
        *[group_key(df, *column).alias(key) for key, column in zip(keys, columns.values(), strict=True)]
    )
    copies = F.count(F.lit(1)).alias(_COPIES)
    if len(keys) == 1:
        groups = keyed.groupBy(*keys).agg(copies).withColumn(_SET, F.lit(0))
    else:
        each_alone = [[F.col(key)] for key in keys]
        groups = keyed.groupingSets(each_alone, *keys).agg(copies, F.grouping_id().alias(_SET))
    # grouping_id() has a bit for every column that is not part of the set.
    full = 2 ** len(keys) - 1
    set_ids = [full - 2 ** (len(keys) - 1 - i) for i in range(len(keys))]
    return groups.selectExpr(
        f"coalesce(sum(CASE WHEN {_SET} = {set_ids[0]} THEN {_COPIES} END), 0L) AS {total}",
        *[
            f"coalesce(sum(CASE WHEN {_SET} = {set_id} AND {_COPIES} > 1 THEN {_COPIES} END), 0L) AS {name}"
            for name, set_id in zip(columns, set_ids, strict=True)
        ],
    )


def repeated_keys(
    df: DataFrame, column: str, digest: bool, name: str, keys_path: str | None = None
) -> DataFrame:
    """The keys that occur more than once, one row each, in a column ``name``; stored first if a path is given."""
    repeated = (
        df.groupBy(group_key(df, column, digest).alias(name))
        .agg(F.count(F.lit(1)).alias(_COPIES))
        .filter(F.col(_COPIES) > 1)
        .select(name)
    )
    if keys_path is None:
        return repeated
    write_table(repeated, keys_path, mode="error", num_files=None)
    return read_table(df.sparkSession, keys_path, "parquet", repeated.schema)


def duplicated_rows(
    df: DataFrame, column: str, keys_path: str | None = None, digest: bool = False
) -> DataFrame:
    """All rows whose value occurs more than once.

    A semi-join against the repeated keys, one row per key. Where the right
    side is large, Spark can split the left side of a hot key between tasks.
    With ``keys_path`` the repeated keys are stored there first: Spark then
    knows their size when it plans the join, and broadcasts them if they are
    few, without shuffling the dataset at all.
    """
    repeated = repeated_keys(df, column, digest, _REPEATED, keys_path)
    # The key travels as a column: as a join expression it would be computed
    # again for partitioning, for sorting and for every comparison.
    keyed = df.withColumn(_KEY, group_key(df, column, digest))
    return keyed.join(repeated, F.col(_KEY).eqNullSafe(F.col(_REPEATED)), "left_semi").drop(_KEY)
