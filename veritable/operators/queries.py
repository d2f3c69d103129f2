"""The ``custom_sql`` rule: every row the query returns is one failure."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritable.rules import Rule
from veritable.sources.tables import read_table


# View names are shared by all threads of a session.
_VIEWS = threading.RLock()


@contextmanager
def dataset_view(spark: SparkSession, name: str, df: DataFrame, rules: Iterable[Rule]) -> Iterator[None]:
    """Expose a dataset under its name to row-level rules that look it up there.

    Only a subquery inside such a rule's SQL needs that, so no view is made unless
    the name occurs in one. A view of the caller with that name is put back.
    """
    check_name(spark, name)
    if not any(looks_up(rule, name) for rule in rules if not rule.dataset_level):
        yield
        return
    with _VIEWS:
        before = _existing_view(spark, name)
        if before is not None and before.sameSemantics(df):
            yield
            return
        _make_view(df, name)
        try:
            yield
        finally:
            if before is None:
                spark.catalog.dropTempView(name)
            else:
                before.createOrReplaceTempView(name)


_NAME = re.compile(r"`(?:[^`]|``)+`|\w+")


def check_name(spark: SparkSession, name: str) -> None:
    """Refuse what could not be the name of a view: one identifier, quoted or not, that is no keyword."""
    spark.sql(f"WITH {name} AS (SELECT 1) SELECT 1")
    # What Spark takes there may be more than a name.
    if not _NAME.fullmatch(name):
        raise ValueError(f"Not a name for a dataset: {name!r}")


def looks_up(rule: Rule, name: str) -> bool:
    """Whether a rule's SQL may look the dataset up by its name."""
    return any(isinstance(text, str) and _plain(name) in text.lower() for text in rule.params.values())


def _plain(name: str) -> str:
    """A name as Spark compares it by default."""
    return name.strip("`").lower()


def _existing_view(spark: SparkSession, name: str) -> DataFrame | None:
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary:
        return spark.table(name)
    return None


def _make_view(df: DataFrame, name: str) -> None:
    # Dropping a view also drops cached data of the same plan. A filter that keeps
    # every row tells the view from the caller's frame, and costs nothing: the
    # optimizer removes it.
    df.where(F.lit(True)).createOrReplaceTempView(name)


def violation_count(spark: SparkSession, rule: Rule, dataset: str, df: DataFrame, name: str) -> DataFrame:
    """One (name, count) pair with the number of rows the query returns."""
    return _wrapped(spark, rule, dataset, df, f"SELECT '{name}' AS name, COUNT(*) AS n")


def violations(spark: SparkSession, rule: Rule, dataset: str, df: DataFrame) -> DataFrame:
    """The rows the query returns."""
    return _wrapped(spark, rule, dataset, df, "SELECT *")


def _wrapped(spark: SparkSession, rule: Rule, dataset: str, df: DataFrame, head: str) -> DataFrame:
    """The query as a subquery, with the names of the dataset and of its references bound to it.

    The frames are views under private names while the query is analysed (plans keep
    their resolved inputs), and WITH gives them the names the query knows. Views of
    the caller are never touched, whatever they are called. As a subquery only a
    query parses: a statement with side effects is refused. The line breaks keep a
    trailing comment inside.
    """
    query = without_end(rule.params["query"])
    # An alias hides the dataset.
    frames = {_plain(dataset): (dataset, df)}
    frames |= {_plain(alias): (alias, frame) for alias, frame in _reference_tables(spark, rule).items()}
    private = {f"__{uuid.uuid4().hex}": bound for bound in frames.values()}
    bound = ", ".join(f"{alias} AS (SELECT * FROM {view})" for view, (alias, _) in private.items())
    try:
        for view, (_, frame) in private.items():
            _make_view(frame, view)
        return spark.sql(f"WITH {bound} {head} FROM (\n{query}\n)")
    finally:
        for view in private:
            spark.catalog.dropTempView(view)


_TOKENS = re.compile(
    r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|(?P<note>--[^\n]*|/\*.*?\*/)|\S""", re.DOTALL
)


def without_end(query: str) -> str:
    """The query without the semicolons behind its last word; comments may follow them."""
    words = [m for m in _TOKENS.finditer(query) if m["note"] is None]
    while words and words[-1][0] == ";":
        at = words.pop().start()
        query = f"{query[:at]} {query[at + 1 :]}"
    return query


def _reference_tables(spark: SparkSession, rule: Rule) -> dict[str, DataFrame]:
    tables = rule.params.get("reference_tables") or {}
    return {
        alias: read_table(spark, ref["path"], ref.get("format", "parquet"), ref.get("schema"))
        for alias, ref in tables.items()
    }
