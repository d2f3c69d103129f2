"""States that grow with the dataset against evaluating all of it."""

import datetime as dt

import pytest
from pyspark.sql import types as T

import veritable as v
from tests.helpers import plan, scan_count, verdicts
from veritable.plans import states

NAN = float("nan")


def unique_rule(column="k"):
    return {"id": "once", "type": "unique", "column": column}


def facts(results):
    return [(r["rule_id"], r["total_records"], r["failed_records"], r["status"]) for r in results.collect()]


@pytest.mark.parametrize(
    ("kind", "slices"),
    [
        ("string", [["a", None, "b"], ["a", "c", ""], [None, "d", "null"]]),
        ("double", [[0.0, NAN, 1.5], [-0.0, 2.5], [NAN, 1e300, None]]),
        ("binary", [[b"\x00", b""], [b"\x00\xff"], [b"", None]]),
        ("date", [[dt.date(2024, 1, 1)], [dt.date(2024, 1, 2)], [dt.date(2024, 1, 1)]]),
        ("bigint", [[-1, 1, 2], [], [1, 2, 2]]),
        ("decimal(10,2)", [], ),
    ],
)
def test_slices_count_as_their_union(spark, tmp_path, kind, slices):
    state = v.UniqueState(spark, str(tmp_path / "state"), "data", unique_rule(), buckets=4)
    union = spark.createDataFrame([], f"k {kind}")
    assert facts(state.evaluate()) == [("once", 0, 0, "PASS")]
    for number, values in enumerate(slices):
        part = spark.createDataFrame([(value,) for value in values], f"k {kind}")
        state.merge(part, str(number))
        union = union.union(part)
        assert facts(state.evaluate()) == facts(v.evaluate(union, "data", [unique_rule()]))
    assert state.slices() == [str(number) for number in range(len(slices))]


def test_a_merge_reads_the_slice_and_the_state_and_shuffles_the_slice_only(spark, tmp_path):
    state = v.UniqueState(spark, str(tmp_path / "state"), "data", unique_rule(), buckets=4)
    for number in range(2):
        state.merge(spark.range(number * 50, number * 50 + 100).withColumnRenamed("id", "k"), str(number))
    spark.range(200, 300).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "slice"))
    merged = state.merged(v.read_table(spark, str(tmp_path / "slice"), "parquet"))
    shown = plan(merged)
    assert scan_count(merged) == 2
    # The branch of the state goes from its scan to the join without an exchange.
    tree = shown.split("\n\n")[0].splitlines()
    join = next(i for i, line in enumerate(tree) if "SortMergeJoin FullOuter" in line)
    own = [line for line in tree[join + 1 :] if ":" in line]
    assert len(own) >= 2 and "Scan" in own[-1] and not any("Exchange" in line for line in own)
    assert sum("Exchange" in line for line in tree) >= 1


def test_a_slice_counts_once_and_a_killed_merge_not_at_all(spark, tmp_path, monkeypatch):
    state = v.UniqueState(spark, str(tmp_path / "state"), "data", unique_rule(), buckets=2)
    one, two = (spark.range(n).withColumnRenamed("id", "k") for n in (5, 3))
    state.merge(one, "one")
    state.merge(one, "one")
    assert facts(state.evaluate()) == [("once", 5, 0, "PASS")]
    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            state.merge(two, "two")  # its counts are written, its list of slices is not
    assert facts(state.evaluate()) == [("once", 5, 0, "PASS")]
    state.merge(two, "two")
    again = v.UniqueState(spark, str(tmp_path / "state"), "data", unique_rule(), buckets=7)
    assert facts(again.evaluate()) == [("once", 8, 6, "FAIL")]
    for number in range(4):
        again.merge(two, f"more {number}")
    assert facts(again.evaluate())[0][1:3] == (20, 18)
    assert len(again.versions()) == 2 and len(list((tmp_path / "state").iterdir())) <= 4
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("unique_state")]


def test_unique_state_refuses(spark, tmp_path):
    with pytest.raises(ValueError, match="unique"):
        v.UniqueState(spark, str(tmp_path), "data", {"id": "x", "type": "not_null", "column": "k"})
    nested = spark.createDataFrame([((1,),)], "k struct<a: int>")
    with pytest.raises(ValueError, match="digest"):
        v.UniqueState(spark, str(tmp_path), "data", unique_rule()).merge(nested, "a")


RULES = [
    {"id": "set", "type": "not_null", "column": "x"},
    {"id": "small", "type": "min_max", "column": "x", "max": 5},
    {"id": "letter", "type": "regex", "column": "t", "pattern": "^.$"},
]
ROWS = [("a", 1, "q"), ("a", 9, "qq"), ("b", None, "r"), (None, 3, None), ("", 7, "s"), ("c", 2, "t")]
SCHEMA = "part string, x int, t string"


def test_partitions_add_up_to_the_whole(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    state = v.SuiteState(spark, str(tmp_path / "state"), "data", RULES, "part")
    assert [f[1:] for f in facts(state.evaluate())] == [(0, 0, "PASS")] * 3
    state.update(df, ["a", "b"])
    assert facts(state.evaluate()) == facts(v.evaluate(df.where("part IN ('a', 'b')"), "data", RULES))
    state.update(df, ["", None, "c", "a", "gone"])
    assert facts(state.evaluate()) == facts(v.evaluate(df, "data", RULES))
    changed = df.where("part <> 'c' OR part IS NULL").union(spark.createDataFrame([("a", 50, "z")], SCHEMA))
    state.update(changed, ["a", "c"])
    assert facts(state.evaluate()) == facts(v.evaluate(changed, "data", RULES))


def test_only_the_named_partition_is_read(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.partitionBy("part").parquet(str(tmp_path / "data"))
    df = spark.read.schema(T.StructType.fromDDL(SCHEMA)).parquet(str(tmp_path / "data"))
    state = v.SuiteState(spark, str(tmp_path / "state"), "data", RULES, "part")
    partial = state.partial(df, ["a"])
    assert "PartitionFilters: [part" in plan(partial) or "PartitionFilters: [isnotnull(part" in plan(partial)
    assert scan_count(partial) == 1 and partial.count() == 3


def test_changed_rules_ask_for_updates(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    v.SuiteState(spark, str(tmp_path / "state"), "data", RULES, "part").update(df, ["a", "b"])
    changed = [*RULES[:1], {**RULES[1], "max": 8}]
    state = v.SuiteState(spark, str(tmp_path / "state"), "data", changed, "part")
    assert state.outdated() == ["=a", "=b"]
    with pytest.raises(ValueError, match="=a"):
        state.evaluate()
    state.update(df, ["a", "b"])
    assert facts(state.evaluate()) == facts(v.evaluate(df.where("part IN ('a', 'b')"), "data", changed))
    assert v.SuiteState(spark, str(tmp_path / "state"), "data", RULES, "part").outdated() == ["=a", "=b"]


@pytest.mark.parametrize(
    "rule",
    [unique_rule("x"), {"id": "q", "type": "custom_sql", "query": "SELECT 1"},
     {"id": "mean", "type": "sql_expression", "expression": "x > (SELECT avg(x) FROM data)"}],
)
def test_rules_of_the_whole_dataset_are_refused(spark, tmp_path, rule):
    with pytest.raises(ValueError, match=rule["id"]):
        v.SuiteState(spark, str(tmp_path), "data", [rule], "part")


def test_definitions_differ_by_every_parameter():
    rules = [v.Rule.parse(r) for r in (RULES[0], RULES[1], {**RULES[1], "max": 6}, {**RULES[1], "column": "y"})]
    assert len({states._definition(rule) for rule in rules}) == 4


def test_states_and_evaluation_agree_on_verdicts(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    state = v.SuiteState(spark, str(tmp_path / "state"), "data", RULES, "part")
    state.update(df, ["a", "b", "c", "", None])
    rows = {r["rule_id"]: r["pass_rate"] for r in state.evaluate().collect()}
    assert rows == {rule_id: r["pass_rate"] for rule_id, r in verdicts(df, RULES).items()}
