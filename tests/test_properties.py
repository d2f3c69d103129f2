"""Random data against plain Python, and the laws every rule obeys."""

import math
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import veritable as v
from tests.helpers import verdicts

COMMON = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

TEXTS = st.one_of(st.none(), st.sampled_from(["", "a", "ab", "b", "x" * 31, "x" * 32, "x" * 40, "y" * 40]))
NUMBERS = st.one_of(st.none(), st.integers(-3, 3).map(float), st.just(float("nan")))
ROWS = st.lists(st.tuples(TEXTS, NUMBERS, st.integers(0, 4)), max_size=12)

RULES = [
    {"id": "null", "type": "not_null", "column": "s"},
    {"id": "uniq_s", "type": "unique", "column": "s"},
    {"id": "uniq_f", "type": "unique", "column": "f"},
    {"id": "range", "type": "min_max", "column": "f", "min": -1, "max": 2},
    {"id": "range_i", "type": "min_max", "column": "i", "min": 1, "max": 3},
    {"id": "in", "type": "allowed_values", "column": "s", "values": ["a", "b"]},
    {"id": "re", "type": "regex", "column": "s", "pattern": "a|x{32}"},
    {"id": "expr", "type": "sql_expression", "expression": "f < i"},
    {"id": "sql", "type": "custom_sql", "query": "SELECT * FROM data WHERE i > 2"},
]


def in_repeated_group(values):
    keys = ["nan" if isinstance(x, float) and math.isnan(x) else x for x in values]
    return sum(n for n in Counter(keys).values() if n > 1)


def expected(rows):
    texts, numbers, ints = ([r[i] for r in rows] for i in range(3))

    def fails(values, valid):
        return sum(not valid(x) for x in values)

    return {
        "null": fails(texts, lambda s: s is not None),
        "uniq_s": in_repeated_group(texts),
        "uniq_f": in_repeated_group(numbers),
        "range": fails(numbers, lambda f: f is not None and -1 <= f <= 2),
        "range_i": fails(ints, lambda i: 1 <= i <= 3),
        "in": fails(texts, lambda s: s in ("a", "b")),
        "re": fails(texts, lambda s: s is not None and ("a" in s or "x" * 32 in s)),
        "expr": fails(rows, lambda r: r[1] is not None and r[1] < r[2]),
        "sql": sum(i > 2 for i in ints),
    }


@COMMON
@given(ROWS, st.booleans())
def test_counts_match_plain_python(spark, rows, shared_scan):
    df = spark.createDataFrame(rows, "s STRING, f DOUBLE, i INT")
    results = verdicts(df, RULES, shared_scan=shared_scan)
    assert {key: row["failed_records"] for key, row in results.items()} == expected(rows)
    for row in results.values():
        assert row["total_records"] == len(rows)
        assert row["passed_records"] + row["failed_records"] == len(rows)
        assert row["status"] == ("FAIL" if row["failed_records"] else "PASS")
        assert row["pass_rate"] == (row["passed_records"] / len(rows) if rows else 1.0)


@settings(COMMON, max_examples=5)
@given(ROWS)
def test_failing_rows_are_as_many_as_counted(spark, rows):
    df = spark.createDataFrame(rows, "s STRING, f DOUBLE, i INT").repartition(3)
    counts = expected(rows)
    suite = v.CheckSuite("data", RULES)
    for rule in RULES:
        assert suite.failing_rows(df, rule["id"]).count() == counts[rule["id"]]
