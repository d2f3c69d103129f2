"""Quality rules as a short-circuit cascade; DataFrame operations only.

Every document is measured once, inside its row: words, symbols, repeated lines and
words of repeated windows. No row is shuffled, so neither a hot source nor a huge
group of copies matters, and a long text costs n log n of its own words.

A rule is a condition under which a document is rejected. The rules become one
``CASE WHEN`` chain: a row leaves it at its first rejection, and what later rules
would have computed from its words is never computed. ``plan_cascade`` finds the
order. On a sample it takes each rule's share of rejected documents and its cost, the
time it adds to a pass that only measures, and sorts by rejection per cost. Rules are
ordered as if independent of each other.

The verdict does not depend on the order, hence neither on the sample nor on the
clock: a document is kept if no rule rejects it. ``rejected_by`` does; it names the
rule at which the row left the chain. The sample holds ``SAMPLE_ROWS`` documents of at
most ``SAMPLE_CHARS`` characters, the first ones that the table yields: reading them
touches a few partitions only, however large the table is, and at most 2 million
characters reach the driver.

Equal windows are told by 64-bit hashes within one document: two different ones are
taken for equal with a chance of about 1e-10 in a document of 50,000 words.

Edge cases: a null text is an empty one, and has no words; it fails the base rules.
Rows that repeat, and rows with null ids, are judged one by one. Extra columns are
ignored, whatever their names. An empty table gives an empty result; its rules stay
in the order they came in, as do rules of equal rank.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 100
SAMPLE_CHARS = 20_000
_LEAST_COST = 1e-3
_REPEATS = 2
_COPIES = 10

# What separates words, and what counts as a symbol.
SPACES = " \t\n\v\f\r"
SPACE = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"

# The class of separators in a string of SQL, and how many repeated runs are looked up one by one.
_SQL_SPACE = f"[{SPACE}]".replace("\\", "\\\\")
_WORDS = f"""CASE WHEN text RLIKE '{_SQL_SPACE.replace("[", "[^", 1)}'
    THEN split(trim(BOTH '{SPACES}' FROM text), '{_SQL_SPACE}+') ELSE array() END"""
_LOOKED_UP = 16

#: Base rules: too short, or more than half of it repeats itself.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
BASE_FAILED = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class QualityRule(NamedTuple):
    """``rejects`` is SQL over the measured columns: text, words, n_lines and ``COUNTS``."""

    name: str
    rejects: str


def _words_like(pattern: str) -> str:
    """SQL for the number of words of the text that match, found in one pass over it."""
    java = f"(?<![^{SPACE}]){pattern}(?![^{SPACE}])".replace("\\", "\\\\")
    return f"regexp_count(text, '{java}')"


_WITHOUT_LETTERS = _words_like(f"[^\\p{{L}}{SPACE}]++")
_ALL_CAPITALS = _words_like(f"[^\\p{{Ll}}\\p{{Lu}}{SPACE}]*+\\p{{Lu}}[^\\p{{Ll}}{SPACE}]++")

# Thresholds as published for web corpora.
QUALITY_RULES = (
    QualityRule("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words"),
    QualityRule("few_letters", f"100 * {_WITHOUT_LETTERS} > 20 * n_words"),
    QualityRule("shouting", f"100 * {_ALL_CAPITALS} > 30 * n_words"),
    QualityRule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    QualityRule("symbols", "100 * n_symbols > 10 * n_words"),
)


class Estimate(NamedTuple):
    rule: QualityRule
    cost: float
    rejected: float


def _once(rows: DataFrame, **made: str | Column) -> DataFrame:
    """``rows`` with further columns, each computed once a row.

    As columns of a projection they would be written out again wherever they are used:
    a filter on what comes of them moves below the projection and takes them along,
    into the bodies of lambda functions too. No filter passes the generator.
    """
    fields = [(F.expr(how) if isinstance(how, str) else how).alias(name) for name, how in made.items()]
    return rows.select("*", F.inline(F.array(F.struct(*fields))))


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """``text`` with its words and counts, after the columns ``keep``, which must not be named like them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = _once(
        docs.select(*keep, text.alias("text")),
        words=_WORDS,
        lines=F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]")),
    )
    # Hashes of all runs of three words; sequence() would count downwards below 3 words.
    runs = "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2]))"
    rows = _once(rows, runs=f"CASE WHEN size(words) >= 3 THEN {runs} ELSE array() END")
    # Numbers are sorted fast, but only a text in which a run occurs again needs it.
    rows = _once(rows, sorted="CASE WHEN size(array_distinct(runs)) < size(runs) THEN sort_array(runs) ELSE array() END")
    rows = _once(rows, again="array_distinct(filter(sorted, (h, k) -> k > 0 AND sorted[k - 1] = h))")
    # Where they occur: looked up if few of them are different, else by sorting all runs with their places.
    placed = _once(
        rows.drop("sorted"),
        placed=f"CASE WHEN size(again) > {_LOOKED_UP} THEN sort_array(transform(runs, (h, i) -> struct(h AS h, i AS i))) END",
    )
    looked_up = "CASE WHEN size(again) > 0 THEN filter(sequence(0, size(runs) - 1), i -> array_contains(again, runs[i])) END"
    sought = """sort_array(transform(filter(placed, (r, k) -> (k > 0 AND placed[k - 1].h = r.h)
        OR (k + 1 < size(placed) AND placed[k + 1].h = r.h)), r -> r.i))"""
    places = f"CASE WHEN size(again) > {_LOOKED_UP} THEN {sought} ELSE {looked_up} END"
    # Runs overlap: each adds what the one before does not cover.
    covered = f"""aggregate({places}, struct(0 AS upto, 0L AS n),
        (a, p) -> struct(p + 3 AS upto, a.n + least(3, p + 3 - a.upto) AS n), a -> a.n)"""
    symbols = " + ".join(f"octet_length(text) - octet_length(replace(text, '{symbol}', ''))" for symbol in SYMBOLS)
    rows = _once(
        placed,
        n_words=F.size("words").cast("long"),
        word_chars="CAST(char_length(array_join(words, '')) AS BIGINT)",
        n_symbols=f"CAST({symbols} AS BIGINT)",
        n_lines=F.size("lines").cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        n_repeat_words=f"coalesce({covered}, 0L)",
    )
    return rows.select(*keep, "text", "words", "n_lines", *COUNTS)


def _literal_rows(docs: DataFrame, rows: list[tuple], names: Sequence[str]) -> DataFrame:
    """A few rows as literals of a plan of their own."""
    one = docs.sparkSession.range(1)
    structs = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row, strict=True)]) for row in rows]
    return one.select(F.inline(F.array(*structs)))


def _seconds(action: Callable[[], object]) -> tuple[float, object]:
    best, value = float("inf"), None
    for _ in range(_REPEATS):
        start = time.perf_counter()
        value = action()
        best = min(best, time.perf_counter() - start)
    return best, value


def plan_cascade(docs: DataFrame, rules: Sequence[QualityRule] = QUALITY_RULES) -> list[Estimate]:
    """The rules with their estimated cost and selectivity, best rejection per cost first.

    The sample is measured once; rules are timed one by one on what passes the base rules.
    """
    short = docs.select(F.col("text").cast("string").alias("text")).where(F.char_length("text") <= SAMPLE_CHARS)
    texts = [(row["text"],) for row in short.take(SAMPLE_ROWS)]
    found = []
    if texts:
        measured = measure(_literal_rows(docs, texts, ["text"])).where(f"NOT ({BASE_FAILED})")
        found = measured.drop("words").collect()
    if not found:
        return [Estimate(rule, _LEAST_COST, 0.0) for rule in rules]
    rows = _literal_rows(docs, found, found[0].__fields__).withColumn("words", F.expr(_WORDS))
    rows = rows.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(_COPIES))))
    rows.count()  # the first pass over literals pays for more than they do
    nothing, _ = _seconds(lambda: rows.agg(F.sum("n_words")).first())
    estimates = []
    for rule in rules:
        took, row = _seconds(lambda rule=rule: rows.agg(F.count_if(F.expr(rule.rejects)).alias("hits")).first())
        share = row["hits"] / (_COPIES * len(found))
        estimates.append(Estimate(rule, max(took - nothing, _LEAST_COST), share))
    return sorted(estimates, key=lambda e: -e.rejected / e.cost)


def judge(measured: DataFrame, rules: Sequence[QualityRule]) -> DataFrame:
    """``measured`` with base_failed, rejected_by (null if kept) and kept; rules run in the order given."""
    chain = F.when(F.col("base_failed"), F.lit("base"))
    for rule in rules:
        chain = chain.when(F.expr(rule.rejects), F.lit(rule.name))
    judged = measured.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("rejected_by", chain)
    return judged.withColumn("kept", F.col("rejected_by").isNull())


def judge_quality(docs: DataFrame, rules: Sequence[QualityRule] = QUALITY_RULES) -> DataFrame:
    """(doc_id, counts, base_failed, kept, rejected_by) of every row of ``docs`` (doc_id, text)."""
    order = [estimate.rule for estimate in plan_cascade(docs, rules)]
    measured = measure(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    return judge(measured, order).select("doc_id", *COUNTS, "base_failed", "kept", "rejected_by")
