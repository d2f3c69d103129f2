"""The corpus pipeline on small tables, stage by stage and as a whole."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from tests.llm.test_operators import prose

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(seed, n, lang="en"):
    stems = {"en": ["the", "and", "walk", "thing", "with"], "de": ["und", "nicht", "haus", "grün", "zeit"]}[lang]
    return " ".join(f"{stems[(seed * 7 + i * i) % 5]} {word}" for i, word in enumerate(prose(seed, n // 2).split()))


def rows_of(texts, lang="en"):
    return [(i, t, lang, f"s{(i or 0) % 3}", len(t or "")) for i, t in texts]


@pytest.fixture
def tables(spark, tmp_path):
    def write(docs, items=((1, prose(900, 40)),)):
        spark.createDataFrame(docs, DOCS).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame(list(items), "item_id long, text string").write.mode("overwrite").parquet(str(tmp_path / "benchmark.parquet"))
        return str(tmp_path)

    return write


def test_stages_are_named_and_ordered():
    assert [name for name, _ in p.STAGES] == ["language", "near_duplicates", "passages", "decontaminated", "tokens"]


def scratch(spark):
    return {path.name for path in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}


def test_the_whole(spark, tables):
    before = scratch(spark)
    base = rows_of([(i, sentence(i, 160)) for i in range(40)]) + rows_of([(50 + i, sentence(200 + i, 160, "de")) for i in range(40)], "de")
    shared = sentence(999, 90)
    special = rows_of(
        [
            (100, base[0][1]),  # a copy of 0
            (101, base[1][1].upper()),  # a copy of 1, but for case
            (102, f"{base[2][1]} more"),  # a near copy of 2
            (103, f"{sentence(301, 80)} {shared}"), (104, f"{shared} {sentence(302, 80)}"),  # one passage in both
            (105, f"{sentence(303, 60)} {prose(900, 40)} {sentence(304, 60)}"),  # an item of the benchmark
            (106, None), (107, ""), (108, "12345 !!! ---"),
        ]
    )
    rows = {r["doc_id"]: r for r in p.run(spark, tables(base + special)).collect()}
    assert set(rows) == {r[0] for r in base} | {103, 104}
    assert rows[0]["decoded_sha256"] == hashlib.sha256(base[0][1].encode()).hexdigest()
    assert rows[103]["decoded_sha256"] == hashlib.sha256(special[3][1].encode()).hexdigest()
    left = [sentence(302, 80), f" {sentence(302, 80)}"]  # 104 loses the passage that 103 has
    assert [name.rpartition("-")[0] for name in scratch(spark) - before] == ["pipeline-decontaminated"]
    assert rows[104]["decoded_sha256"] in {hashlib.sha256(t.encode()).hexdigest() for t in left}


def test_rows_that_repeat_and_ids_that_are_null(spark, tables):
    one, two, three = (sentence(seed, 120) for seed in (1, 2, 3))
    docs = rows_of([(1, one), (1, one), (2, one), (None, one), (3, two), (4, two), (None, three), (None, three), (5, sentence(5, 120)), (5, sentence(6, 120))])
    df = spark.createDataFrame(docs, DOCS)
    kept = p.near_duplicates(spark, df, tables(docs)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(1, one), (3, two), (0, three), (5, sentence(5, 120)), (5, sentence(6, 120))])


@pytest.mark.parametrize("stage", range(5))
def test_empty_tables_and_columns_of_other_names(spark, tables, stage):
    name, function = p.STAGES[stage]
    docs = rows_of([(i, sentence(i, 120)) for i in range(12)] + [(None, sentence(50, 120)), (20, None), (21, "")])
    path = tables(docs)
    df = spark.createDataFrame(docs, DOCS)
    for extra in ("digest", "_slot", "_gone", "component_id", "cut_id", "cut_spans", "score", "n", "start", "id"):
        df = df.withColumn(extra, F.lit("kept"))
    made = function(spark, df, path)
    if name != "tokens":
        assert made.columns == df.columns
        assert {r["cut_id"] for r in made.collect()} <= {"kept"}
        assert set(range(12)) <= {r["doc_id"] for r in made.collect()}
    nothing = function(spark, df.limit(0), path)
    assert nothing.collect() == [] and nothing.columns == made.columns


def test_the_size_of_slices_changes_no_token(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([None, "", "a", sentence(1, 400), "grün  und\n\n" * 50, sentence(2, 30)])], "doc_id long, text string")
    whole, *others = (sorted(map(tuple, p.round_trip(docs, n).collect())) for n in (4 << 20, 1 << 10, 1))
    assert len(whole) == 6 and others == [whole, whole]
