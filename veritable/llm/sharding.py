"""Sharding by balanced label propagation; DataFrame operations only.

Documents with equal texts are linked. What is kept of a group is its cells: how
many of its documents started in which shard, and where that cell is now. A round
joins every group with the counts of its cells by shard; a cell wants to go where
most of its neighbours are (a group larger than a shard fills as many shards as it
needs). A shard takes in cells only as far as its quota of documents goes, counted
from small to large groups, so that cells of a group move together; the others
stay and try again next round. Unlinked documents yield: they fill what the linked ones leave.

The law is ``rows``: shard sizes differ by at most one row. Linked documents above a
shard's quota and unlinked ones are numbered and dealt into the free places, so the
law holds exactly, whatever the rounds achieved.

Numbers within a shard come from counts of hashed buckets, a table of shards x
buckets, plus a rank inside the bucket: no window holds more than a bucket, of which
there are more the more rows there are, and a
group that holds a third of all rows is spread over the buckets of its shards.

Edge cases: null texts have size 8, checksum 0 and are linked with nothing; empty
texts are equal texts. Rows with a null or repeated id are rows of their own. With
fewer rows than shards, some shards are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritable.sources.scratch import stored

_BUCKETS = 1024
_BUCKET_ROWS = 50_000
_ROUNDS = 3


def buckets_for(rows: int) -> int:
    """Enough buckets that one holds some ten thousand rows, however many there are."""
    return max(_BUCKETS, -(-rows // _BUCKET_ROWS))


def _bucket(buckets: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns, F.lit("bucket")), F.lit(buckets))


def _numbered(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with a gapless number from 0 within ``by``; needs bucket and order columns.

    Bucket counts are added up first; ranks are taken inside a bucket only.
    """
    counts = rows.groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("n"))
    key = ", ".join(by) if by else "0"
    before = counts.selectExpr(
        *[f"{c} AS before_{c}" for c in by],
        "bucket AS before_bucket",
        f"sum(n) OVER (PARTITION BY {key} ORDER BY bucket) - n AS before",
    )
    on = " AND ".join([*(f"{c} <=> before_{c}" for c in by), "bucket <=> before_bucket"])
    inside = ", ".join([*by, "bucket"])
    joined = rows.join(before, F.expr(on)).drop(*[f"before_{c}" for c in by], "before_bucket")
    ranked = joined.selectExpr(
        *rows.columns, f"before + row_number() OVER (PARTITION BY {inside} ORDER BY tie, doc_id) - 1 AS {name}"
    )
    return ranked


def compact(docs: DataFrame) -> DataFrame:
    """What the rounds need of a document: id, size, checksum, group, and a tie breaker."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.when(text.isNotNull(), F.sha2(text, 256)).alias("digest"),
    )


def _cells(linked: DataFrame) -> DataFrame:
    return linked.groupBy("grp", "origin").agg(F.count(F.lit(1)).alias("n")).withColumn("shard", F.col("origin"))


def _round(cells: DataFrame, shards: int, quota: int, buckets: int) -> DataFrame:
    """One round of label propagation over (grp, origin, n, shard)."""
    here = cells.groupBy("grp", "shard").agg(F.sum("n").alias("here"))
    load = here.groupBy("shard").agg(F.sum("here").alias("load"))
    here = here.join(load.withColumnRenamed("shard", "at"), F.expr("shard <=> at")).selectExpr(
        "grp", "shard", "here", "load - here + sum(here) OVER (PARTITION BY grp) <= %d AS fits" % quota
    )
    # At most ``shards`` rows a group: shards with room for all of it first, then by
    # neighbours, ties by hash so that no shard is preferred.
    order = "ORDER BY fits DESC, here DESC, xxhash64(grp, shard)"
    ranked = here.selectExpr(
        "grp AS g", "shard AS s", f"row_number() OVER (PARTITION BY grp {order}) - 1 AS place",
        f"sum(here) OVER (PARTITION BY grp {order}) - here AS ahead",
    )
    wanted = ranked.withColumn("want", F.least(F.floor(F.col("ahead") / quota), F.lit(shards - 1)))
    places = wanted.selectExpr("g AS pg", "place AS pp", "s AS target")
    targets = wanted.join(places, F.expr("g <=> pg AND want <=> pp")).select("g", "s", "target")
    moves = cells.join(targets, F.expr("grp <=> g AND shard <=> s")).drop("g", "s")
    # Small groups come first: one that is larger than the room left blocks nothing.
    moves = moves.withColumn(
        "bucket", F.floor(F.log2(F.sum("n").over(Window.partitionBy("grp")))) * buckets + _bucket(buckets, "grp")
    )
    staying = moves.where("target = shard").groupBy("shard").agg(F.sum("n").alias("stay"))
    asked = moves.where("target <> shard").groupBy("target", "bucket", "origin").agg(F.sum("n").alias("asking"))
    # At most buckets x size classes x shards rows a target, whatever the number of groups.
    running = asked.selectExpr(
        "target AS t", "bucket AS b", "origin AS o", "sum(asking) OVER (PARTITION BY target ORDER BY bucket, origin) AS upto"
    )
    granted = (
        running.join(staying.withColumnRenamed("shard", "at"), F.expr("t <=> at"), "left")
        .where(F.col("upto") + F.coalesce("stay", F.lit(0)) <= quota)
        .select("t", "b", "o")
    )
    granted = granted.withColumn("granted", F.lit(True))
    return moves.join(granted, F.expr("target <=> t AND bucket <=> b AND origin <=> o AND target <> shard"), "left").select(
        "grp", "origin", "n", F.when(F.col("granted"), F.col("target")).otherwise(F.col("shard")).alias("shard")
    )


def shard_documents(docs: DataFrame, shards: int = 24, rounds: int = _ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    rows = stored(compact(docs), "shard-rows")
    copies = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    rows = rows.join(copies.select(F.col("digest").alias("grp")), F.expr("digest <=> grp"), "left")
    rows = rows.select("doc_id", "size", "text_crc32", "grp", F.xxhash64("doc_id", "digest").alias("tie"))
    rows = rows.withColumn("origin", F.pmod(F.xxhash64("tie"), F.lit(shards)).cast("int"))
    rows = stored(rows, "shard-linked")
    total = rows.count()
    buckets = buckets_for(total)
    low, more = divmod(total, shards)  # the first ``more`` shards take one row more
    cells = stored(_cells(rows.where("grp IS NOT NULL")), "shard-cells")
    for _ in range(rounds if total else 0):
        cells = stored(_round(cells, shards, max(low, 1), buckets), "shard-cells")
    moved = rows.join(
        cells.select(F.col("grp").alias("g"), F.col("origin").alias("o"), F.col("shard").cast("int").alias("shard")),
        F.expr("grp <=> g AND origin <=> o"),
        "left",
    ).drop("g", "o")
    # Groups stay together in buckets of their own; only one bucket of a full shard is cut.
    moved = moved.withColumn("bucket", F.when(F.col("grp").isNotNull(), _bucket(buckets, "grp", "tie")).otherwise(_bucket(buckets, "tie")))
    moved = stored(moved, "shard-moved")
    quotas = spark.range(shards).select(
        F.col("id").cast("int").alias("quota_shard"), (F.lit(low) + (F.col("id") < more).cast("int")).alias("quota")
    )
    held = _numbered(moved.where("shard IS NOT NULL"), ["shard"], "position")
    held = held.join(quotas, F.expr("shard <=> quota_shard"))
    held = stored(held.select(*moved.columns, (F.col("position") < F.col("quota")).alias("fits")), "shard-held")
    taken = held.where("fits").groupBy("shard").agg(F.count(F.lit(1)).alias("taken"))
    room = (
        quotas.join(taken.withColumnRenamed("shard", "at"), F.expr("quota_shard <=> at"), "left")
        .selectExpr("quota_shard", "quota - coalesce(taken, 0) AS free")
        .where("free > 0")
        .selectExpr("quota_shard", "free", "sum(free) OVER (ORDER BY quota_shard) AS upto")
    )
    loose = moved.where("shard IS NULL").union(held.where("NOT fits").drop("fits"))
    dealt = _numbered(loose.drop("shard"), [], "position")
    # The free places of all shards in a row: at most ``shards`` numbers.
    places = room.agg(F.sort_array(F.collect_list(F.struct("upto", "quota_shard"))).alias("places"))
    target = F.expr("filter(places, p -> p.upto > position)[0].quota_shard")
    dealt = dealt.join(F.broadcast(places)).withColumn("shard", target).drop("places", "position")
    kept = held.where("fits").select(*dealt.columns)
    final = kept.union(dealt).withColumn("bucket", _bucket(buckets, "tie"))
    final = _numbered(stored(final, "shard-final"), ["shard"], "slot")
    return final.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
