"""The unique rule: whole groups fail, and hot or long values are no trouble."""

import pytest
from pyspark.sql import functions as F

import veritable as v
from tests.helpers import failed, plan

RULE = {"type": "unique", "column": "x"}


def frame(spark, values, kind):
    return spark.createDataFrame([(value,) for value in values], f"x {kind}")


@pytest.mark.parametrize(
    ("values", "kind", "expected"),
    [
        ([1, 2, 3], "INT", 0),
        ([1, 1, 1, 2], "INT", 3),
        ([1, None], "INT", 0),
        ([1, None, None], "INT", 2),
        (["a", None, None], "STRING", 2),
        (["a", "A", "a "], "STRING", 0),
        (["", "", "a"], "STRING", 2),
        ([float("nan"), float("nan"), 1.0], "DOUBLE", 2),
        ([0.0, -0.0, 1.0], "DOUBLE", 2),
        ([b"ab", b"ab", b"c"], "BINARY", 2),
        ([[1, 2], [1, 2], [2, 1]], "ARRAY<INT>", 2),
        ([], "INT", 0),
        ([], "STRING", 0),
    ],
)
def test_every_member_of_a_duplicate_group_fails(spark, values, kind, expected):
    assert failed(frame(spark, values, kind), RULE) == expected


@pytest.mark.parametrize("digest", [False, True])
@pytest.mark.parametrize("size", [31, 32, 5000])
def test_texts_of_any_length(spark, size, digest):
    same, other = "é" + "x" * (size - 2), "é" + "x" * (size - 3) + "y"
    assert failed(frame(spark, [same, same, other], "STRING"), {**RULE, "digest": digest}) == 2


def test_a_value_equal_to_another_values_digest_stays_apart(spark):
    long_value = b"z" * 100
    digest = bytes(frame(spark, [long_value], "BINARY").select(F.unhex(F.sha2("x", 256))).first()[0])
    assert len(digest) == 32
    # At 32 bytes the digest itself is digested, so the two keys differ.
    assert failed(frame(spark, [long_value, digest], "BINARY"), RULE) == 0


def test_collation_decides_equality(spark):
    df = frame(spark, ["a", "A", "b"], "STRING COLLATE UTF8_LCASE")
    assert failed(df, RULE) == 2


def test_column_called_count_or_like_an_internal_name(spark):
    for name in ("count", "total", "failed", "n0"):
        df = spark.createDataFrame([(1,), (1,), (2,)], f"{name} INT")
        assert failed(df, {"type": "unique", "column": name}) == 2


def test_failing_rows_keep_every_column_and_copy(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "id INT, x STRING")
    rows = v.failing_rows(df, "data", {"id": "r", **RULE})
    assert rows.columns == ["id", "x"]
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 4, 5]


def test_stored_keys_give_the_same_rows_without_shuffling_the_dataset(spark, tmp_path):
    path = str(tmp_path / "data")
    rows = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None), (6, "z" * 99), (7, "z" * 99)]
    v.write_table(spark.createDataFrame(rows, "id INT, x STRING"), path)
    df = v.read_table(spark, path, "parquet")
    found = v.failing_rows(df, "data", {"id": "r", **RULE}, keys_path=str(tmp_path / "keys"))
    assert sorted(r["id"] for r in found.collect()) == [1, 2, 4, 5, 6, 7]
    shown = plan(found)
    assert "BroadcastHashJoin" in shown
    assert "hashpartitioning" not in shown


def test_stored_keys_too_large_to_broadcast_are_shuffled(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 500 AS x", "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        found = v.failing_rows(df, "data", {"id": "r", **RULE}, keys_path=str(tmp_path / "keys"))
        assert "SortMergeJoin" in plan(found)
        assert found.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_text_is_grouped_by_digest_if_asked_for(spark):
    df = spark.range(10).select(F.repeat(F.col("id").cast("string"), 200).alias("x"))
    assert "sha2" not in plan(v.evaluate(df, "data", [{"id": "r", **RULE}]))
    shown = plan(v.evaluate(df, "data", [{"id": "r", **RULE, "digest": True}]))
    assert "sha2" in shown


def test_hot_value_is_one_row_per_task_after_the_map_side(spark):
    df = spark.range(0, 30000, 1, 6).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("x"))
    assert failed(df, RULE) == 10000
    shown = plan(v.evaluate(df, "data", [{"id": "r", **RULE}]))
    assert shown.index("partial_count") < shown.index("hashpartitioning")


def test_hot_value_is_split_between_tasks_when_rows_are_returned(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = spark.range(0, 200000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("x"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        rows = v.failing_rows(df, "data", {"id": "r", **RULE})
        assert len(rows.collect()) == 66667
        assert "(skew=true)" in plan(rows)
    finally:
        for key in settings:
            spark.conf.unset(key)
