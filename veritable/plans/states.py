"""Stored states: what a growing dataset needs not be read for again."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritable.functions.columns import column_type
from veritable.operators.queries import looks_up
from veritable.operators.row_level import valid_counts
from veritable.plans.results import long_form
from veritable.plans.suite import CheckSuite
from veritable.rules import UNIQUE, Rule
from veritable.sources.files import Folder, join

BUCKETS = 256
_KEPT_VERSIONS = 2


def value_digest(df: DataFrame, column: str) -> Column:
    """32 bytes for a value, none for NULL; equal for what GROUP BY takes as equal."""
    value, kind = F.col(column), column_type(df, column)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) or (
        isinstance(kind, T.StringType) and not kind.isUTF8BinaryCollation()
    ):
        raise ValueError(f"No digest is defined for values of type {kind.simpleString()} ({column!r})")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0).cast(kind)  # minus zero becomes zero
    if not isinstance(kind, (T.StringType, T.BinaryType)):
        value = value.cast("string")
    return F.coalesce(F.unhex(F.sha2(value.cast("binary"), 256)), F.lit(b""))


class UniqueState:
    """How often each value of a column occurred, kept in buckets by digest of the value.

    ``merge`` adds a slice of new rows: the slice is aggregated and shuffled into the
    buckets, and joined with each of them where it lies; the state itself is read and
    written, never shuffled. A merge is a new version of the state, which counts once
    it is whole, so one that is killed changes nothing, and repeating it, or merging a
    slice again that was merged before, is safe. ``evaluate`` reads the state alone.

    One merge at a time. The number of buckets is fixed by the first merge; a bucket
    should fit an executor (rows x 40 bytes / buckets).
    """

    def __init__(
        self, spark: SparkSession, path: str, dataset: str, rule: Rule | Mapping[str, Any], buckets: int = BUCKETS
    ) -> None:
        self.suite = CheckSuite(dataset, [rule])
        self.rule = self.suite.rules[0]
        if self.rule.type != UNIQUE:
            raise ValueError(f"A unique rule is needed, not {self.rule.type!r}")
        self.spark, self.path, self.buckets = spark, path, buckets
        self._folder = Folder(spark, path)

    def versions(self) -> list[int]:
        """Whole versions, oldest first. The list of slices is written last."""
        found = self._folder.files("version-*/slices/_SUCCESS")
        return sorted(int(name.split("/")[0].removeprefix("version-")) for name in found)

    def slices(self) -> list[str]:
        """The slices merged so far."""
        versions = self.versions()
        if not versions:
            return []
        return [row["slice"] for row in self._read(versions[-1], "slices", "slice string, buckets int").collect()]

    def _read(self, version: int, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self._at(version, name))

    def _at(self, version: int, name: str) -> str:
        return join(self.path, f"version-{version:08d}", name)

    def _buckets_of(self, version: int) -> int:
        return self._read(version, "slices", "slice string, buckets int").first()["buckets"]

    def _keys(self, version: int) -> DataFrame:
        """(key, copies), known to Spark as bucketed and sorted by key."""
        name, count = f"unique_state_{uuid.uuid4().hex}", self._buckets_of(version)
        self.spark.sql(
            f"CREATE TABLE {name} (key BINARY, copies BIGINT) USING parquet "
            f"CLUSTERED BY (key) SORTED BY (key) INTO {count} BUCKETS LOCATION '{self._at(version, 'keys')}'"
        )
        try:
            return self.spark.table(name)
        finally:
            # The table is a name for files; dropping it leaves them.
            self.spark.sql(f"DROP TABLE {name}")

    def merged(self, df: DataFrame) -> DataFrame:
        """(key, copies) of the state and of ``df`` together; nothing is stored."""
        fresh = df.select(value_digest(df, self.rule.column).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
        versions = self.versions()
        if not versions:
            return fresh
        old = self._keys(versions[-1]).withColumnRenamed("copies", "before")
        # Dealt like the state's files, or Spark would shuffle the state instead where it
        # has fewer buckets than the session has shuffle partitions.
        fresh = fresh.repartition(self._buckets_of(versions[-1]), "key")
        return old.join(fresh, "key", "full_outer").selectExpr("key", "coalesce(before, 0L) + coalesce(copies, 0L) AS copies")

    def merge(self, df: DataFrame, slice_id: str) -> None:
        """Add the rows of ``df``, unless a slice of this id has been merged."""
        known = self.slices()
        if slice_id in known:
            return
        versions = self.versions()
        number = versions[-1] + 1 if versions else 1
        buckets = self._buckets_of(versions[-1]) if versions else self.buckets
        self._folder.remove(f"version-{number:08d}")  # of a merge that was killed
        name = f"unique_state_{uuid.uuid4().hex}"
        keys = self.merged(df)
        if not versions:
            keys = keys.repartition(buckets, "key")  # one file a bucket
        keys.write.bucketBy(buckets, "key").sortBy("key").option("path", self._at(number, "keys")).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        rows = [(known_id, buckets) for known_id in [*known, slice_id]]
        slices = self.spark.createDataFrame(rows, "slice string, buckets int").coalesce(1)
        slices.write.parquet(self._at(number, "slices"))
        for old in versions[: 1 - _KEPT_VERSIONS]:
            self._folder.remove(f"version-{old:08d}")

    def evaluate(self, run_id: str | None = None, run_timestamp: dt.datetime | None = None) -> DataFrame:
        """The results frame of the rule over all slices merged so far."""
        suite = CheckSuite(self.suite.dataset, [self.rule], run_id, run_timestamp)
        versions = self.versions()
        if versions:
            keys = self._read(versions[-1], "keys", "key binary, copies bigint")
        else:
            keys = self.spark.createDataFrame([], "key binary, copies bigint")
        counts = keys.selectExpr(
            "coalesce(sum(copies), 0L) AS total", "coalesce(sum(CASE WHEN copies > 1 THEN copies END), 0L) AS n0"
        )
        return long_form(counts, [self.rule], [F.col("n0")], "total", suite.dataset, suite.run_id, suite.run_timestamp)


_PARTIAL = "part string, rule_id string, definition string, total bigint, valid bigint"


class SuiteState:
    """Counts of a suite's row-level rules by partition of the dataset, merged on demand.

    ``update`` evaluates the partitions that are named, all rules in one scan of these,
    and replaces what is stored for them; ``evaluate`` adds up what is stored. A
    partition is a value of ``column``; where the dataset is laid out by it, others are
    not read. Rules of the whole dataset cannot be added up and are refused.
    """

    def __init__(
        self, spark: SparkSession, path: str, dataset: str, rules: Sequence[Rule | Mapping[str, Any]], column: str
    ) -> None:
        self.spark, self.path, self.column = spark, path, column
        self.suite = CheckSuite(dataset, rules)
        whole = [rule.id for rule in self.suite.rules if rule.dataset_level or looks_up(rule, dataset)]
        if whole or not self.suite.rules:
            raise ValueError(f"Only rules that judge each row by itself can be added up; not {whole}")

    def update(self, df: DataFrame, values: Sequence[Any]) -> None:
        """Evaluate the partitions ``values`` of ``df``; one that has no rows (any more) counts as empty."""
        writer = self.partial(df, values).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("part").parquet(self.path)

    def partial(self, df: DataFrame, values: Sequence[Any]) -> DataFrame:
        """What ``update`` stores: per partition and rule the number of rows, and of valid ones."""
        rules = self.suite.rules
        names = [f"n{i}" for i in range(len(rules))]
        column = F.col(self.column)
        wanted = column.isin([value for value in values if value is not None])
        if None in values:
            wanted |= column.isNull()
        counts = df.where(wanted).groupBy(_part(column).alias("part")).agg(
            F.count(F.lit(1)).alias("total"), *valid_counts(rules, names)
        )
        asked = df.sparkSession.range(1).select(
            F.explode(F.array(*[_part(F.lit(value).cast(column_type(df, self.column))) for value in values])).alias("part")
        )
        rows = [
            F.struct(F.lit(rule.id).alias("rule_id"), F.lit(_definition(rule)).alias("definition"), F.coalesce(name, F.lit(0)).alias("valid"))
            for rule, name in zip(rules, names, strict=True)
        ]
        partial = asked.distinct().join(counts, "part", "left")
        partial = partial.select("part", F.coalesce("total", F.lit(0)).alias("total"), F.inline(F.array(*rows)))
        return partial.select("rule_id", "definition", "total", "valid", "part").repartition("part")

    def _stored(self) -> DataFrame:
        if not Folder(self.spark, self.path).has():
            return self.spark.createDataFrame([], _PARTIAL)
        known = F.array(*[F.lit(f"{rule.id}\n{_definition(rule)}") for rule in self.suite.rules])
        stored = self.spark.read.schema(_PARTIAL).parquet(self.path)
        return stored.where(F.array_contains(known, F.concat_ws("\n", "rule_id", "definition")))

    def outdated(self) -> list[str]:
        """Stored partitions that lack a rule of the suite, or hold an earlier definition of one."""
        if not Folder(self.spark, self.path).has():
            return []
        every = self.spark.read.schema(_PARTIAL).parquet(self.path).select("part").distinct()
        whole = self._stored().groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(self.suite.rules))
        return sorted(row["part"] for row in every.join(whole, "part", "left_anti").collect())

    def evaluate(self, run_id: str | None = None, run_timestamp: dt.datetime | None = None) -> DataFrame:
        """The results frame over all stored partitions; refused while some of them are outdated."""
        if outdated := self.outdated():
            raise ValueError(f"Partitions to be updated first: {outdated[:20]}")
        suite = CheckSuite(self.suite.dataset, self.suite.rules, run_id, run_timestamp)
        rules = suite.rules
        counts = self._stored().agg(
            F.sum(F.when(F.col("rule_id") == rules[0].id, F.col("total"))).alias("total"),
            *[F.sum(F.when(F.col("rule_id") == rule.id, F.col("valid"))).alias(f"n{i}") for i, rule in enumerate(rules)],
        )
        failed = [F.expr(f"coalesce(total - n{i}, 0L)") for i in range(len(rules))]
        return long_form(counts, rules, failed, "total", suite.dataset, suite.run_id, suite.run_timestamp)


def _part(value: Column) -> Column:
    """A partition's name; NULL and empty text have different ones."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def _definition(rule: Rule) -> str:
    spec = json.dumps([rule.type, rule.column, dict(rule.params)], sort_keys=True, default=repr)
    return hashlib.sha256(spec.encode()).hexdigest()
