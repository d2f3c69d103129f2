"""Counts taken while the caller writes the data: no scan for the checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from veritable.operators.row_level import valid_counts
from veritable.plans.results import long_form
from veritable.plans.suite import CheckSuite

_TOTAL = "total"


class Watch:
    """``rows`` is the dataset, to be written by the caller; ``results`` are those of that write.

    The counts travel with the tasks that write. Spark adds up what each task of the
    last stage reports when it has succeeded, so a task that fails and runs again, or
    runs twice by speculation, counts once. For that, ``rows`` must be what is written,
    or be narrowed by selections only: what comes behind a shuffle may run again.

    Only rules that judge each row by itself can be watched.
    """

    def __init__(self, suite: CheckSuite, df: DataFrame) -> None:
        whole = [rule.id for rule in suite.rules if rule.dataset_level]
        if whole or not suite.rules:
            raise ValueError(f"Only row-level rules can be watched; not {whole}")
        self.suite = suite
        self._spark = df.sparkSession
        self._names = [f"n{i}" for i in range(len(suite.rules))]
        self._seen = Observation(f"checks-{uuid.uuid4().hex}")
        counts = valid_counts(suite.rules, self._names)
        self.rows = df.observe(self._seen, F.count(F.lit(1)).alias(_TOTAL), *counts)

    def results(self) -> DataFrame:
        """The results frame of the first action on ``rows``; waits until there has been one."""
        seen = self._seen.get
        counts = self._spark.range(1).select(*[F.lit(seen[name]).cast("bigint").alias(name) for name in (_TOTAL, *self._names)])
        failed = [F.expr(f"{_TOTAL} - {name}") for name in self._names]
        suite = self.suite
        return long_form(counts, suite.rules, failed, _TOTAL, suite.dataset, suite.run_id, suite.run_timestamp)
