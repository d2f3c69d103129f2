"""Declarative data-quality checks compiled into one lazy Spark plan."""

from veritable.functions.predicates import register_row_check, row_check, valid_rows
from veritable.plans.history import (
    latest_run,
    latest_stored_run,
    read_history,
    run_summary,
    severity_gate,
    top_history,
)
from veritable.plans.commits import commit_run
from veritable.plans.compaction import compact_history
from veritable.plans.job import run_job
from veritable.plans.observed import Watch
from veritable.plans.results import RESULT_SCHEMA
from veritable.plans.states import SuiteState, UniqueState
from veritable.plans.suite import CheckSuite, evaluate, failing_rows
from veritable.rules import Rule
from veritable.sources.tables import read_table, write_table

__all__ = [
    "RESULT_SCHEMA",
    "CheckSuite",
    "Rule",
    "SuiteState",
    "UniqueState",
    "Watch",
    "commit_run",
    "compact_history",
    "evaluate",
    "failing_rows",
    "latest_run",
    "latest_stored_run",
    "read_history",
    "read_table",
    "register_row_check",
    "row_check",
    "run_job",
    "run_summary",
    "severity_gate",
    "top_history",
    "valid_rows",
    "write_table",
]
