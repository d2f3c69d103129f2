"""All verdicts of a suite on every row: which rules a row fails, from one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.functions.predicates import valid_rows
from veritable.operators.foreign_keys import with_missing
from veritable.operators.uniqueness import by_digest, group_key, repeated_keys
from veritable.rules import FOREIGN_KEY, UNIQUE, Rule
from veritable.sources.files import join

FAILED_RULES = "failed_rules"
_PASSED = "passed"


def with_failed_rules(
    df: DataFrame, rules: Sequence[Rule], column: str = FAILED_RULES, keys_path: str | None = None
) -> DataFrame:
    """``df`` with the ids of the rules that each row fails, in rule order; none for a good row.

    Row-level rules are computed side by side in the one scan. A ``unique`` rule adds a
    left join with its repeated values, one row per value, which is broadcast if they
    are few; where many rows share a value, Spark can split the side of the dataset.
    With ``keys_path``, a new folder, the values are stored first, so their size is known.
    """
    marks: dict[str, str] = {}
    # The verdicts come first: the joined columns must not be seen by a rule's SQL.
    verdicts = {
        f"__failed_{i}": ~valid_rows(rule) for i, rule in enumerate(rules) if not rule.dataset_level
    }
    marked = df.select("*", *[verdict.alias(name) for name, verdict in verdicts.items()])
    for i, rule in enumerate(rules):
        name = f"__failed_{i}"
        marks[rule.id] = name
        if rule.type == FOREIGN_KEY:
            marked = with_missing(marked, rule, name)
        if rule.type != UNIQUE:
            continue
        key, repeated = f"__key_{i}", f"__repeated_{i}"
        path = None if keys_path is None else join(keys_path, f"rule-{i}")
        values = repeated_keys(df, rule.column, by_digest(rule), repeated, path)
        marked = (
            marked.withColumn(key, group_key(df, rule.column, by_digest(rule)))
            .join(values.withColumn(name, F.lit(True)), F.col(key).eqNullSafe(F.col(repeated)), "left")
            .drop(key, repeated)
        )
    ids = [F.when(F.col(name), F.lit(rule_id)) for rule_id, name in marks.items()]
    failed = F.array_compact(F.array(*ids)) if ids else F.array().cast("array<string>")
    return marked.withColumn(column, failed).select(*df.columns, column)


def rows_by_verdict(marked: DataFrame, column: str, path: str) -> tuple[DataFrame, DataFrame]:
    """``marked`` stored once at ``path``, a new folder, as good and bad rows; what is returned reads it."""
    passed = (F.size(column) == 0).alias(_PASSED)
    if _PASSED in marked.columns:
        raise ValueError(f"The dataset has a column {_PASSED!r}, which the stored verdict is named")
    stored = marked.select("*", passed)
    stored.write.partitionBy(_PASSED).parquet(path)
    table = marked.sparkSession.read.schema(stored.schema).parquet(path)
    good = table.where(_PASSED).drop(_PASSED, column)
    return good, table.where(f"NOT {_PASSED}").drop(_PASSED)
