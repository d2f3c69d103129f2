"""Compile a list of rules and a DataFrame into one lazy results frame."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritable.operators.foreign_keys import missing_count, with_missing
from veritable.operators.queries import dataset_view, violation_count, violations
from veritable.operators.row_level import rejected_rows, valid_counts
from veritable.operators.uniqueness import by_digest, duplicate_counts, duplicated_rows
from veritable.operators.verdicts import FAILED_RULES, rows_by_verdict, with_failed_rules
from veritable.plans.parsing import parse_rules
from veritable.plans.shared import stored_columns
from veritable.plans.results import ERROR, RESULT_SCHEMA, long_form, side_by_side
from veritable.rules import CUSTOM_SQL, FOREIGN_KEY, UNIQUE, Rule

_TOTAL = "total"


class CheckSuite:
    """Rules bound to a dataset name; queries see the dataset under that name.

    ``run_id`` and ``run_timestamp`` identify the run in the results; both are
    generated (UUID4, now in UTC) when left out.
    """

    def __init__(
        self,
        dataset: str,
        rules: Iterable[Rule | Mapping[str, Any]],
        run_id: str | None = None,
        run_timestamp: dt.datetime | None = None,
    ) -> None:
        self.dataset = dataset
        self.rules = parse_rules(rules)
        self.run_id = run_id or str(uuid.uuid4())
        self.run_timestamp = run_timestamp or dt.datetime.now(dt.timezone.utc)

    def evaluate(self, df: DataFrame, shared_scan: bool = False, shared_input: str | None = None) -> DataFrame:
        """Results frame, one row per rule in rule order. Nothing runs yet.

        Row-level rules share one global aggregate; each of the other rules is
        an aggregate of its own. All of them meet in a union of counts, so
        Spark runs them side by side in one job and collects nothing between. Only a
        ``foreign_key`` rule runs a job now, over its reference's column.

        Every ``unique`` rule reads its own column, which costs no extra input
        on a columnar table. ``shared_scan`` makes them read the input together
        instead; choose it where reading is dear (text formats, joins).

        ``shared_input`` names a new folder, for an input that is dear to read: the columns
        that any rule or query of the suite reads are found in its plan and written there now, in
        one read of ``df``, and all rules are evaluated on that. The caller removes the folder.

        Acting on the frame twice evaluates the rules twice: write it first
        (as ``run_job`` does) and read the table.
        """
        self._refuse_stream(df)
        if not self.rules:
            return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
        if shared_input is not None:
            df = stored_columns(df, self.evaluate, shared_input)
        with dataset_view(df.sparkSession, self.dataset, df, self.rules):
            counts, failed = self._counts(df, shared_scan)
        return long_form(
            counts, self.rules, failed, _TOTAL, self.dataset, self.run_id, self.run_timestamp
        )

    def evaluate_isolated(self, df: DataFrame, shared_scan: bool = False) -> DataFrame:
        """The results frame, where a rule that raises costs only its own verdict. This runs now.

        All rules are evaluated in one plan, as by ``evaluate``. Only if that raises are
        they halved until the ones that raise stand alone, so a run without errors costs
        nothing extra, and one bad rule of n about log n evaluations of ever fewer rules.
        Such a rule gets the status ``ERROR``, its cause behind the description, and as
        failed records the rows that are not valid when values which cannot be cast,
        divided and so on are taken as NULL (all rows, where even that is impossible).
        """
        rows = self._isolated(df, self.rules, shared_scan)
        order = [rule.id for rule in self.rules]
        rows.sort(key=lambda row: order.index(row["rule_id"]))
        values = [tuple(row[name] for name in RESULT_SCHEMA.fieldNames()) for row in rows]
        return df.sparkSession.createDataFrame(values, RESULT_SCHEMA).coalesce(1)

    def _isolated(self, df: DataFrame, rules: list[Rule], shared_scan: bool) -> list[dict[str, Any]]:
        if not rules:
            return []
        try:
            return [row.asDict() for row in self._only(rules).evaluate(df, shared_scan).collect()]
        except PySparkException as error:
            half = len(rules) // 2
            if half:
                return [row for part in (rules[:half], rules[half:]) for row in self._isolated(df, part, shared_scan)]
            return [self._error(df, rules[0], error)]

    def _only(self, rules: list[Rule]) -> CheckSuite:
        return CheckSuite(self.dataset, rules, self.run_id, self.run_timestamp)

    def _error(self, df: DataFrame, rule: Rule, error: PySparkException) -> dict[str, Any]:
        described = f"{rule.description or ''} [{error.getCondition() or type(error).__name__}]".strip()
        row = self._lenient(df, rule)
        if row is None:
            total = df.count()
            counts = {"total_records": total, "failed_records": total, "passed_records": 0, "pass_rate": 0.0 if total else 1.0}
            facts = {"run_id": self.run_id, "run_timestamp": self.run_timestamp, "dataset": self.dataset, "rule_id": rule.id}
            facts |= {"rule_type": rule.type, "column_name": rule.column, "severity": rule.severity}
            row = facts | counts | {"run_date": self.run_timestamp.date().isoformat()}
        return row | {"description": described, "status": ERROR}

    def _lenient(self, df: DataFrame, rule: Rule) -> dict[str, Any] | None:
        """The rule's result where what cannot be computed is NULL; ANSI mode is read when a plan is made."""
        settings = df.sparkSession.conf
        before = settings.get("spark.sql.ansi.enabled")
        try:
            settings.set("spark.sql.ansi.enabled", "false")
            return self._only([rule]).evaluate(df).first().asDict()
        except PySparkException:
            return None
        finally:
            settings.set("spark.sql.ansi.enabled", before)

    def failing_rows(self, df: DataFrame, rule_id: str, keys_path: str | None = None) -> DataFrame:
        """The rows behind one rule's ``failed_records``.

        For ``custom_sql`` these are the rows (and columns) of the query, also
        where an empty dataset makes them count as no failure. For ``unique``,
        ``keys_path`` names a new folder to store the repeated values in, which
        lets Spark choose the join by their true size.
        """
        self._refuse_stream(df)
        rule = next((r for r in self.rules if r.id == rule_id), None)
        if rule is None:
            raise ValueError(f"No rule {rule_id!r} in this suite")
        if rule.type == UNIQUE:
            return duplicated_rows(df, rule.column, keys_path, by_digest(rule))
        if rule.type == CUSTOM_SQL:
            return violations(df.sparkSession, rule, self.dataset, df)
        if rule.type == FOREIGN_KEY:
            return with_missing(df, rule, "__missing").where("__missing").drop("__missing")
        with dataset_view(df.sparkSession, self.dataset, df, [rule]):
            return rejected_rows(df, rule)

    def verdicts(self, df: DataFrame, keys_path: str | None = None, column: str = FAILED_RULES) -> DataFrame:
        """``df`` with an array of the ids of the rules that each row fails, in rule order.

        Row-level, ``unique`` and ``foreign_key`` rules take part, which judge rows of the
        dataset; a ``custom_sql`` rule returns rows of its own and is refused. One scan serves all
        row-level rules; each ``unique`` rule reads its own column once more. Counting a
        rule's id gives its ``failed_records``. For ``keys_path`` see ``failing_rows``.
        """
        self._refuse_stream(df)
        queries = [rule.id for rule in self.rules if rule.type == CUSTOM_SQL]
        if queries:
            raise ValueError(f"custom_sql rules judge no rows of the dataset: {queries}")
        if column in df.columns:
            raise ValueError(f"The dataset has a column {column!r} already")
        with dataset_view(df.sparkSession, self.dataset, df, self.rules):
            return with_failed_rules(df, self.rules, column, keys_path)

    def all_failing_rows(self, df: DataFrame, keys_path: str | None = None, column: str = FAILED_RULES) -> DataFrame:
        """The rows that fail any rule, each once, with the ids of all rules it fails; see ``verdicts``."""
        return self.verdicts(df, keys_path, column).where(F.size(column) > 0)

    def split_rows(
        self, df: DataFrame, path: str, keys_path: str | None = None, column: str = FAILED_RULES
    ) -> tuple[DataFrame, DataFrame]:
        """The good rows, and the bad ones with the ids of the rules they fail.

        Both come from one pass over ``df``, written to ``path``, a new folder; see ``verdicts``.
        """
        return rows_by_verdict(self.verdicts(df, keys_path, column), column, path)

    def _counts(self, df: DataFrame, shared_scan: bool) -> tuple[DataFrame, list[Column]]:
        """A one-row frame, and over it each rule's number of failures."""
        names = {rule.id: f"n{i}" for i, rule in enumerate(self.rules)}
        row_level = [rule for rule in self.rules if not rule.dataset_level]
        uniques = [
            (names[rule.id], (rule.column, by_digest(rule))) for rule in self.rules if rule.type == UNIQUE
        ]
        size = max(1, len(uniques)) if shared_scan else 1
        parts = [
            duplicate_counts(df, dict(uniques[start : start + size]), _TOTAL)
            for start in range(0, len(uniques), size)
        ]
        if row_level or not parts:
            counted = valid_counts(row_level, [names[rule.id] for rule in row_level])
            parts.insert(0, df.agg(F.count(F.lit(1)).alias(_TOTAL), *counted))
        # The group sizes of a unique rule add up to the total as well: whatever
        # comes first provides it.
        parts[1:] = [part.drop(_TOTAL) for part in parts[1:]]
        pairs = [
            violation_count(df.sparkSession, rule, self.dataset, df, names[rule.id])
            for rule in self.rules
            if rule.type == CUSTOM_SQL
        ]
        pairs += [missing_count(df, rule, names[rule.id]) for rule in self.rules if rule.type == FOREIGN_KEY]
        failed = [self._failed(rule, names[rule.id]) for rule in self.rules]
        return side_by_side(parts, pairs, [_TOTAL, *names.values()]), failed

    @staticmethod
    def _failed(rule: Rule, name: str) -> Column:
        if not rule.dataset_level:
            return F.expr(f"coalesce({_TOTAL} - {name}, 0L)")
        # An empty dataset passes every rule, whatever a query would return.
        return F.expr(f"CASE WHEN {_TOTAL} = 0 THEN 0L ELSE coalesce({name}, 0L) END")

    @staticmethod
    def _refuse_stream(df: DataFrame) -> None:
        if df.isStreaming:
            raise ValueError("Checks are evaluated on bounded DataFrames, not on streams")


def evaluate(
    df: DataFrame,
    dataset: str,
    rules: Iterable[Rule | Mapping[str, Any]],
    run_id: str | None = None,
    run_timestamp: dt.datetime | None = None,
    shared_scan: bool = False,
    shared_input: str | None = None,
) -> DataFrame:
    """Shorthand for ``CheckSuite(dataset, rules, ...).evaluate(df, shared_scan, shared_input)``."""
    return CheckSuite(dataset, rules, run_id, run_timestamp).evaluate(df, shared_scan, shared_input)


def failing_rows(
    df: DataFrame, dataset: str, rule: Rule | Mapping[str, Any], keys_path: str | None = None
) -> DataFrame:
    """The rows that fail one rule; see ``CheckSuite.failing_rows``."""
    suite = CheckSuite(dataset, [rule])
    return suite.failing_rows(df, suite.rules[0].id, keys_path)
