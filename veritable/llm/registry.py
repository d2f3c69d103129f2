"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritable.llm.byte_bpe import round_trip
from veritable.llm.collocations import collocations
from veritable.llm.common import table
from veritable.llm.decontaminate import find_leaks
from veritable.llm.embedding_pairs import near_duplicates
from veritable.llm.hard_negatives import hard_negatives
from veritable.llm.jaccard_join import jaccard_components
from veritable.llm.language_id import held_out, identify_documents
from veritable.llm.main_text import extract_main_text
from veritable.llm.passages import repeated_passages
from veritable.llm.quality_rules import COUNTS, judge_quality
from veritable.llm.sharding import shard_documents
from veritable.llm.url_filter import filter_urls
from veritable.llm.warc import derivatives, responses

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24
# The rules that URLs are judged by.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked records of all pages; of the records themselves their digest."""
    made = derivatives(responses(table(spark, sf_dir, "pages")))
    return made.withColumn("record_sha256", F.sha2("record", 256)).drop("record")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url")
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = identify_documents(table(spark, sf_dir, "documents"))
    return named.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "lang_pred", "score")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_embedding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")

    def scaled(x: Column) -> Column:
        y = x.cast("double") * 256
        whole = y - y % 1  # floor() would return 64 bits
        return F.when(whole > y, whole - 1).otherwise(whole)

    whole = rows.select("vec_id", label.alias("label"), F.transform("embedding", scaled).alias("vector"))
    return hard_negatives(whole, F.col("vec_id") % 100 == 0)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_jaccard_join,
        op2_warc_derivatives,
        op3_sharding,
        op4_url_filter,
        op5_passages,
        op6_language_id,
        op7_main_text,
        op8_decontamination,
        op9_embedding_pairs,
        op10_byte_bpe,
        op11_collocations,
        op12_hard_negatives,
        op13_quality_rules,
    )
} | {"pipeline": corpus_pipeline.run}

_URL_FILTER = """
WITH parsed AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), judged AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(action, length(rule_host || rule_path)) AS action
  FROM (SELECT DISTINCT host, path FROM parsed) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, parsed.host, parsed.path, rule, coalesce(action, 'allow') AS verdict
FROM parsed LEFT JOIN judged ON parsed.host = judged.host AND parsed.path = judged.path
"""

_QUALITY_RULES = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS copies
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM texts)
), repeated AS (
  SELECT r, count(DISTINCT place) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM windows WHERE copies > 1)
  GROUP BY r
), counted AS (
  SELECT doc_id, words, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM texts LEFT JOIN repeated USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    word_chars < 3 * n_words OR word_chars > 10 * n_words
    OR 100 * len(list_filter(words, lambda w: NOT regexp_matches(w, '\\p{L}'))) > 20 * n_words
    OR 100 * len(list_filter(words, lambda w: regexp_matches(w, '^[^\\p{Ll}\\p{Lu}]*\\p{Lu}[^\\p{Ll}]+$'))) > 30 * n_words
    OR 100 * n_dup_lines > 30 * n_lines OR 100 * n_symbols > 10 * n_words AS rejected
  FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected AS kept
FROM judged
"""

_COLLOCATIONS = """
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, words
  FROM (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words
    FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
      FROM documents
    )
  )
), placed AS (
  SELECT lang, words[i] AS x, words[i + 1] AS y, words[i + 2] AS z
  FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces)
), one AS (SELECT lang, x, count(*) AS f FROM placed GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang),
two AS (SELECT lang, x, y, count(*) AS f FROM placed WHERE y IS NOT NULL GROUP BY ALL),
three AS (SELECT lang, x, y, z, count(*) AS f FROM placed WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, x, y, max(f) AS most
  FROM (SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y, z, f FROM three)
  GROUP BY lang, x, y
), cuts AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, l.f AS l, r.f AS r, 1 AS k
  FROM two t JOIN one l ON t.lang = l.lang AND t.x = l.x JOIN one r ON t.lang = r.lang AND t.y = r.x
    LEFT JOIN longer m ON t.lang = m.lang AND t.x = m.x AND t.y = m.y
  WHERE t.f >= 10 AND (most IS NULL OR 100 * most < 50 * t.f)
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, l.f, r.f, 1
  FROM three t JOIN one l ON t.lang = l.lang AND t.x = l.x
    JOIN two r ON t.lang = r.lang AND t.y = r.x AND t.z = r.y
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, l.f, r.f, 2
  FROM three t JOIN two l ON t.lang = l.lang AND t.x = l.x AND t.y = l.y
    JOIN one r ON t.lang = r.lang AND t.z = r.x
), scored AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

_HARD_NEGATIVES = """
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.row, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.row <> b.row
), positives AS (
  SELECT row, anchor_id, other_id AS positive_id, score AS positive_score
  FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY row, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (row, anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLES: dict[str, str] = {
    "op4_url_filter": _URL_FILTER,
    "op11_collocations": _COLLOCATIONS,
    "op12_hard_negatives": _HARD_NEGATIVES,
    "op13_quality_rules": _QUALITY_RULES,
} | (
    {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
)
