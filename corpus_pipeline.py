"""From raw documents to tokens: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritable.llm.byte_bpe import round_trip
from veritable.llm.common import fresh_name, split_by, table, without
from veritable.llm.decontaminate import find_leaks
from veritable.llm.jaccard_join import jaccard_components
from veritable.llm.language_id import UNKNOWN, identify_documents
from veritable.llm.passages import cut_passages, repeated_passages
from veritable.sources.scratch import recorded, remove_tables, stored

#: Documents whose language holds less than this share of their letters are rejected.
LEAST_LANGUAGE_SHARE = 0.3
#: The executors come to the last stage with full heaps; smaller slices leave room for them.
TOKEN_SLICE_BYTES = 1 << 20


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language of their own; those without letters or in no known language go."""
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SHARE)
    return identify_documents(docs).where(known).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Five words a shingle, a Jaccard of 0.8 or more, whatever the case. Groups are decided
    by id: rows that share an id but not their text stay or go together. Of rows equal in
    id and text one stays. A row without an id goes if a row with an id has its text, or
    another without one; it stays if it is a near copy only. Documents without words are
    copies of none, but for such rows.
    """
    docs = _rows_once(docs)
    lowered = docs.select("doc_id", F.lower("text").alias("text"))
    groups = jaccard_components(lowered, width=5, percent=80).where("doc_id IS NOT NULL")
    copies = groups.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("first")).where("NOT first")
    return without(docs, "doc_id", stored(copies.select("doc_id"), "pipeline-copies"))


def _rows_once(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of those equal in id and text, ids that are null being equal to any."""
    digest, first = fresh_name("digest"), fresh_name("first")
    marked = docs.select("doc_id", F.sha2(F.col("text").cast("string"), 256).alias(digest))
    times = marked.groupBy("doc_id", digest).agg(F.count(F.lit(1)).alias("n"))
    # Few rows repeat or have no id; only these, and those like them, are shuffled.
    repeated = stored(times.where("n > 1 OR doc_id IS NULL").select("doc_id"), "pipeline-repeated")
    doubtful, clear = split_by(docs, "doc_id", repeated)
    doubtful = doubtful.withColumn(digest, F.sha2(F.col("text").cast("string"), 256)).dropDuplicates(["doc_id", digest])
    named = marked.where("doc_id IS NOT NULL").select(F.col(digest).alias(first)).distinct()
    known = doubtful.where("doc_id IS NULL").join(named, F.col(digest).eqNullSafe(F.col(first)), "left_anti")
    return clear.union(doubtful.where("doc_id IS NOT NULL").union(known).drop(digest))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of more than 50 words stay in the document with the smallest id only."""
    return cut_passages(docs, stored(repeated_passages(docs), "pipeline-passages"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    leaks = find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return without(docs, "doc_id", stored(leaks, "pipeline-leaks"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of what is left: number and digest of the ids, and of the text decoded again."""
    return round_trip(docs, TOKEN_SLICE_BYTES)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("decontaminated", decontaminated),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; of the tables in between, the last one stays, which the result reads."""
    docs, former = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with recorded() as used:
            result = stage(spark, docs, sf_dir)
        with recorded() as kept:
            docs = stored(result, f"pipeline-{name}")
        remove_tables(spark, [*used, *former])
        former = kept
    return STAGES[-1][1](spark, docs, sf_dir)
