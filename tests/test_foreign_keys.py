"""Foreign keys against the anti join."""

import random

import pytest

import veritable as v
from tests.helpers import failed, plan, scan_count, verdicts

LONGEST = 9223372036854775807
KEYS = [0, 1, -1, 5, 32768, 32769, -32768, -32769, LONGEST, -LONGEST - 1, 100000, None, 5]
CHECKED = [0, 1, -1, 2, -2, 5, 6, 32767, 32768, 32770, -32768, -32770, LONGEST, LONGEST - 1, -LONGEST - 1, None, None, 99999, 5]


def reference(spark, tmp_path, keys, kind="bigint"):
    path = str(tmp_path / "reference")
    spark.createDataFrame([(k,) for k in keys], f"k {kind}").write.mode("overwrite").parquet(path)
    return {"path": path, "column": "k"}


def rule(target, **more):
    return {"id": "r", "type": "foreign_key", "column": "x", "reference": target, **more}


def checked(spark, values, kind="bigint"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"id int, x {kind}")


def missing(values, keys):
    return sum(x is None or x not in keys for x in values)


@pytest.mark.parametrize("bound", [0, 1 << 20])
@pytest.mark.parametrize("kinds", [("bigint", "bigint"), ("int", "bigint"), ("bigint", "smallint"), ("tinyint", "tinyint")])
def test_equals_the_anti_join(spark, tmp_path, bound, kinds):
    fits = {"bigint": LONGEST, "int": 2**31 - 1, "smallint": 2**15 - 1, "tinyint": 127}
    values = [x for x in CHECKED if x is None or abs(x) <= fits[kinds[0]]]
    keys = [k for k in KEYS if k is None or abs(k) <= fits[kinds[1]]]
    df = checked(spark, values, kinds[0])
    spec = rule(reference(spark, tmp_path, keys, kinds[1]), bitmap_bytes=bound)
    assert failed(df, spec) == missing(values, keys)
    marked = v.CheckSuite("data", [spec]).verdicts(df).collect()
    assert {r["id"] for r in marked if r["failed_rules"]} == {i for i, x in enumerate(values) if x is None or x not in keys}


def test_random_numbers(spark, tmp_path):
    rng = random.Random(1)
    keys = [rng.randint(-200_000, 200_000) for _ in range(5000)]
    values = [rng.choice(keys) if rng.random() < 0.5 else rng.randint(-200_000, 200_000) for _ in range(5000)]
    target = reference(spark, tmp_path, keys)
    for bound in (0, 1 << 20):
        assert failed(checked(spark, values), rule(target, bitmap_bytes=bound)) == missing(values, set(keys))


@pytest.mark.parametrize(("kind", "keys", "values"), [
    ("string", ["a", None, ""], ["a", "b", "", None]),
    ("date", ["2024-01-01"], ["2024-01-01", "2024-01-02", None]),
])
def test_other_types(spark, tmp_path, kind, keys, values):
    def typed(items):
        return spark.createDataFrame([(i, x) for i, x in enumerate(items)], "id int, x string").selectExpr("id", f"CAST(x AS {kind}) AS x")

    typed(keys).selectExpr("x AS k").write.parquet(str(tmp_path / "reference"))
    spec = rule({"path": str(tmp_path / "reference"), "column": "k"})
    assert failed(typed(values), spec) == missing(values, set(keys))


def test_empty_sides(spark, tmp_path):
    target = reference(spark, tmp_path, [])
    assert failed(checked(spark, [1, None]), rule(target)) == 2
    assert failed(checked(spark, []), rule(target)) == 0
    assert failed(checked(spark, ["a"], "string"), rule(target)) == 1


def test_the_checked_side_is_not_shuffled_below_the_bound(spark, tmp_path):
    target = reference(spark, tmp_path, range(100_000))
    spark.range(1000).withColumnRenamed("id", "x").write.parquet(str(tmp_path / "data"))
    df = v.read_table(spark, str(tmp_path / "data"), "parquet")
    few = v.failing_rows(df, "data", rule(target))
    tree = plan(few).split("\n\n")[0].splitlines()
    join = next(i for i, line in enumerate(tree) if "BroadcastHashJoin LeftOuter" in line)
    own = [line for line in tree[join + 1 :] if ":" in line]
    assert own and not any("Exchange" in line for line in own) and scan_count(few) == 2
    # 100,000 numbers next to each other take 5 bitmaps at most.
    assert "__bits" in plan(few) and "__bits" not in plan(v.failing_rows(df, "data", rule(target, bitmap_bytes=4 * 4096)))


def test_next_to_other_rules_and_an_empty_dataset(spark, tmp_path):
    df = checked(spark, [1, 2, None, 7])
    rules = [rule(reference(spark, tmp_path, [1, 2])), {"id": "set", "type": "not_null", "column": "x"}, {"id": "once", "type": "unique", "column": "x"}]
    assert [r["failed_records"] for r in verdicts(df, rules).values()] == [2, 1, 0]
    assert all(r["status"] == "PASS" for r in verdicts(df.where("id > 9"), rules).values())


@pytest.mark.parametrize("target", [{}, {"path": "x"}, {"column": "k"}])
def test_refusals(target):
    with pytest.raises(ValueError, match="requires"):
        v.CheckSuite("data", [rule(target)])
