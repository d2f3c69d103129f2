"""Row-level predicates: rule type -> Column that is TRUE for valid rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritable.sources.tables import UNREADABLE
from veritable.rules import CUSTOM_SQL, DATASET_LEVEL, FOREIGN_KEY, UNIQUE, Rule

Builder = Callable[[Rule], Column]


class RowCheck(NamedTuple):
    build: Builder
    requires: tuple[str, ...]


_ROW_CHECKS: dict[str, RowCheck] = {}

_DATASET_REQUIRES = {UNIQUE: ("column",), CUSTOM_SQL: ("query",), FOREIGN_KEY: ("column", "reference")}


def register_row_check(name: str, build: Builder, requires: tuple[str, ...] = ()) -> None:
    """Add a row-level rule type; ``requires`` lists the keys a rule must carry."""
    if name in DATASET_LEVEL:
        raise ValueError(f"{name!r} is a dataset-level rule type")
    _ROW_CHECKS[name] = RowCheck(build, tuple(requires))


def row_check(name: str, requires: tuple[str, ...] = ()) -> Callable[[Builder], Builder]:
    """Decorator form of :func:`register_row_check`."""

    def decorate(build: Builder) -> Builder:
        register_row_check(name, build, requires)
        return build

    return decorate


def required_keys(rule: Rule) -> tuple[str, ...]:
    if rule.dataset_level:
        return _DATASET_REQUIRES[rule.type]
    if rule.type not in _ROW_CHECKS:
        raise ValueError(f"Unknown rule type {rule.type!r} (rule {rule.id!r})")
    return _ROW_CHECKS[rule.type].requires


def raw_predicate(rule: Rule) -> Column:
    if rule.dataset_level:
        raise ValueError(f"{rule.type!r} is a dataset-level rule type and has no row predicate")
    required_keys(rule)
    return _ROW_CHECKS[rule.type].build(rule)


def valid_rows(rule: Rule) -> Column:
    """Non-null predicate: a NULL verdict counts as a failure, never as a skip."""
    return F.coalesce(raw_predicate(rule), F.lit(False))


def _within_bounds(rule: Rule) -> Column:
    value = F.col(rule.column)
    verdict = value.isNotNull()
    if "min" in rule.params:
        verdict &= value >= F.lit(rule.params["min"])
    if "max" in rule.params:
        verdict &= value <= F.lit(rule.params["max"])
    return verdict


register_row_check("not_null", lambda rule: F.col(rule.column).isNotNull(), ("column",))
register_row_check("min_max", _within_bounds, ("column",))
register_row_check(
    "allowed_values",
    lambda rule: F.col(rule.column).isin(rule.params["values"]),
    ("column", "values"),
)
register_row_check(
    "regex",
    lambda rule: F.col(rule.column).rlike(rule.params["pattern"]),
    ("column", "pattern"),
)
# The reader tells in this column what it could not read; see read_table.
register_row_check("readable", lambda rule: F.col(rule.column or UNREADABLE).isNull())
register_row_check("sql_expression", lambda rule: F.expr(rule.params["expression"]), ("expression",))
