"""URL filters: host-suffix and path-prefix expressions met by hash.

Every URL is expanded into (host suffix, path prefix) expressions, one for each
trailing run of host labels and each length a rule path has. Expressions and
rules are equi-joined on the first bytes of their SHA-256 alone; the full digests then
decide, and of the rules that remain the longest one (host and path together,
then host, then block before allow) gives the verdict.

The judgement depends on the URL alone, so equal URLs are judged once, and their
verdict is joined back to the rows; a URL that holds a third of all rows is one
row on the side that is expanded. Rules are a table of any size: the
join is on short keys and left to Spark, which broadcasts only what it knows to
be small. Only the distinct lengths of rule paths come to the driver.

Edge cases: a null URL, or one without ``://``, has empty host and path and fits
no rule; neither does an empty host. Repeated rows stay repeated; repeated rules
count once. Rules with a null or empty host fit nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_CHARS = 8  # four bytes, in hexadecimal
_SEPARATOR = "\n"  # never part of a rule's host
_JUDGED = f"judged-{uuid.uuid4().hex}".replace("-", "_")


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _expression(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit(_SEPARATOR), path), 256)


def rule_table(rules: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Rules (host, path, action) with digests, one per expression; block wins over allow."""
    return (
        rules.where("host IS NOT NULL AND host <> '' AND path IS NOT NULL")
        .withColumn("host", F.translate("host", UPPER, LOWER))
        .groupBy("host", "path")
        .agg(F.max("action").alias("action"))
        .select(
            "action",
            F.concat("host", "path").alias("rule"),
            F.length("host").alias("host_length"),
            F.length("path").alias("path_length"),
            _expression(F.col("host"), F.col("path")).alias("rule_digest"),
        )
        .withColumn("rule_prefix", F.substring("rule_digest", 1, prefix_chars))
    )


def _expressions(urls: DataFrame, lengths: Sequence[int], prefix_chars: int) -> DataFrame:
    """One row per expression of every (host, path), dealt by URL before it is expanded."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."),
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    return (
        urls.where("host <> ''")
        # In a fixed number of parts: by their size before it, Spark would expand many in one task.
        .repartition(int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions")), "host", "path")
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("path_length", F.explode(fitting))
        .withColumn("digest", _expression(F.col("suffix"), F.expr("left(path, path_length)")))
        .select("host", "path", "digest", F.substring("digest", 1, prefix_chars).alias("prefix"))
    )


def confirm(met: DataFrame) -> DataFrame:
    """Of what met by its prefix, the expressions whose full digest is the rule's.

    Digests are equally long, so one that starts with the other is the same. As an
    equality of two columns this would become a second key of the join.
    """
    return met.where(F.col("digest").startswith(F.col("rule_digest")))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``pages`` (any columns, ``url`` among them) with host, path, rule and verdict.

    ``rules`` has host, path and action (``allow`` or ``block``); a URL that fits
    none gets ``default`` and a null rule. Columns of these names are replaced; other
    columns are kept, whatever their names. ``prefix_chars`` is the number of hexadecimal
    digits that are joined on; it changes nothing in the result.
    """
    known = rule_table(rules, prefix_chars)
    lengths = sorted(row[0] for row in known.select("path_length").distinct().collect())
    parsed = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    if not lengths:
        return parsed.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    urls = parsed.select("host", "path").distinct()
    confirmed = confirm(_expressions(urls, lengths, prefix_chars).join(known, F.col("prefix") == F.col("rule_prefix")))
    rank = F.struct(
        (F.col("host_length") + F.col("path_length")).alias("length"), "host_length", "action", "rule"
    )
    judged = confirmed.groupBy("host", "path").agg(F.max(rank).alias("best"))
    # One column of a name that no table has; what is inside cannot clash.
    judged = judged.select(F.struct("host", "path", "best.rule", "best.action").alias(_JUDGED))
    on = F.col("host").eqNullSafe(F.col(f"{_JUDGED}.host")) & F.col("path").eqNullSafe(F.col(f"{_JUDGED}.path"))
    return (
        parsed.join(judged, on, "left")
        .withColumn("rule", F.col(f"{_JUDGED}.rule"))
        .withColumn("verdict", F.coalesce(f"{_JUDGED}.action", F.lit(default)))
        .drop(_JUDGED)
    )
