"""Quality rules against a plain version, on awkward rows and in any order."""

import itertools
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan
from veritable.llm.quality_rules import COUNTS, QUALITY_RULES, QualityRule, judge, judge_quality, measure, plan_cascade

TEXT = "doc_id long, text string"
PROSE = " ".join(f"Word{i:03d}x of" for i in range(40))


def counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    covered = {i + k for i, window in enumerate(windows) if times[window] > 1 for k in range(3)}
    symbols = re.findall("[#*$%&|<>]", text)
    return len(words), sum(map(len, words)), len(symbols), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " \t\r\n\v\f ", "one", "one two", "a a a", "a b a b a b a", "  no break \U0001f600 word",
    "same line\nsame line\n\nother\n \nsame line", "x y z " * 40 + PROSE, PROSE, PROSE + " #" * 30, PROSE.upper(),
    PROSE + " 12 34" * 30, "\n".join([f"line {i // 2} of many words" for i in range(40)]), "слово " + PROSE, "ab" * 400 + " " + PROSE,
    " ".join(f"p{i % 37} q{i % 37} r{i % 37} s{i}" for i in range(400)),
]


def test_counts_equal_a_plain_version(spark):
    rows = judge_quality(spark.createDataFrame(list(enumerate(TEXTS)), TEXT)).collect()
    assert {r["doc_id"]: tuple(r[name] for name in COUNTS) for r in rows} == {i: counts(t) for i, t in enumerate(TEXTS)}
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (r["rejected_by"] is None) and r["kept"] <= (not r["base_failed"])
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert {10, 15} <= kept and not kept & {0, 1, 2, 9, 11, 12, 13, 14}


def test_a_very_long_text(spark):
    text = " ".join(f"w{i * 7919 % 5003}" for i in range(60_000))
    row = judge_quality(spark.createDataFrame([(1, text)], TEXT)).first()
    assert tuple(row[name] for name in COUNTS) == counts(text)


def test_the_verdict_does_not_depend_on_the_order(spark):
    measured = measure(spark.createDataFrame(list(enumerate(TEXTS)), TEXT), "doc_id").cache()
    verdicts = set()
    for order in itertools.islice(itertools.permutations(QUALITY_RULES), 0, 120, 17):
        verdicts.add(tuple(sorted((r["doc_id"], r["kept"]) for r in judge(measured, order).collect())))
    measured.unpersist()
    assert len(verdicts) == 1


def test_rules_are_ordered_by_rejection_per_cost(spark):
    docs = spark.createDataFrame([(i, f"{PROSE} end{i} {'#' * 20 if i % 2 else ''}") for i in range(60)], TEXT)
    slow = "n_symbols >= 0 AND aggregate(sequence(1, 20000), 0L, (a, x) -> a + x * n_words) < 0"
    rules = [QualityRule("never", "n_words < 0"), QualityRule("slow", slow), QualityRule("half", "n_symbols > 0")]
    estimates = plan_cascade(docs, rules)
    assert estimates[0].rule.name == "half" and estimates[0].rejected == 0.5
    cost = {e.rule.name: e.cost for e in estimates}
    assert cost["slow"] > cost["never"]


def test_later_rules_are_not_run_on_rejected_rows(spark):
    docs = spark.createDataFrame([(1, PROSE), (2, PROSE + " #" * 50)], TEXT)
    rules = [QualityRule("symbols", "n_symbols > 0"), QualityRule("trap", "CASE WHEN n_symbols > 0 THEN raise_error('run') ELSE false END")]
    assert {r["doc_id"]: r["rejected_by"] for r in judge(measure(docs, "doc_id"), rules).collect()} == {1: None, 2: "symbols"}


def test_awkward_tables(spark):
    assert judge_quality(spark.createDataFrame([], TEXT)).collect() == []
    docs = spark.createDataFrame([(None, PROSE), (1, PROSE), (1, PROSE), (2, None)], TEXT)
    for name in ("words", "runs", "kept", "again", "n_words", "lines"):
        docs = docs.withColumn(name, F.lit("x"))
    rows = judge_quality(docs).collect()
    assert sorted((r["doc_id"] or 0, r["kept"]) for r in rows) == [(0, True), (1, True), (1, True), (2, False)]


@pytest.mark.parametrize("filtered", [False, True])
def test_native_and_without_a_shuffle(spark, filtered):
    judged = judge_quality(spark.range(3).select(F.col("id").alias("doc_id"), F.lit(PROSE).alias("text")))
    shown = plan(judged.where("kept") if filtered else judged)
    assert not re.search("Exchange|Python|Pandas|Arrow", shown)
    assert shown.count("Arguments: inline") >= 5  # a filter moved nothing out of its step
