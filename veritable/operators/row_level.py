"""Row-level rules: fused counts of valid rows, and the rows that fail."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritable.functions.columns import column_type
from veritable.functions.predicates import raw_predicate, valid_rows
from veritable.rules import Rule


def valid_counts(rules: Sequence[Rule], names: Sequence[str]) -> list[Column]:
    """Per rule, the number of rows whose verdict is TRUE, for one global aggregate.

    All other rows fail, a NULL verdict included. The counts combine map-side,
    so each task ships one small row whatever the distribution of the data.
    They are spelled COUNT(CASE ...) because COUNT_IF adds a projection of
    every verdict, and from some fifty rules on that becomes a generated
    method too long for the JVM to compile.
    """
    return [
        F.count(F.when(raw_predicate(rule), True)).alias(name)
        for rule, name in zip(rules, names, strict=True)
    ]


def rejected_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows a row-level rule rejects, with all their columns."""
    if _never_null(df, rule):
        # Without the null guard the negation becomes `c IS NULL OR c < min OR
        # c > max`, which reaches the Parquet scan and skips clean row groups.
        return df.filter(~raw_predicate(rule))
    return df.filter(~valid_rows(rule))


def _never_null(df: DataFrame, rule: Rule) -> bool:
    """Whether the rule's raw predicate is TRUE or FALSE on every row."""
    if rule.type == "not_null":
        return True
    if rule.type != "min_max":
        return False
    kind = column_type(df, rule.column)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # NaN is above every maximum, but column statistics may leave NaN out;
        # a pushed-down `c > max` could then skip rows that must be returned.
        if "max" in rule.params:
            return False
        wanted: tuple[type, ...] = (int, float)
    elif isinstance(kind, T.IntegralType):
        wanted = (int, float)
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        wanted = (dt.date,)
    else:
        return False
    bounds = [rule.params[key] for key in ("min", "max") if key in rule.params]
    return all(isinstance(bound, wanted) and not isinstance(bound, bool) for bound in bounds)
