"""What several operators share: Arrow stages, sorted groups, connected components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritable.sources.scratch import stored
from veritable.sources.tables import read_table

Batches = Iterable[pa.RecordBatch]


def fresh_name(name: str) -> str:
    """A column name that no table has."""
    return f"{name}_{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", "parquet")


def in_arrow(df: DataFrame, function: Callable[[Batches], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow``; what a task has freed goes back to the machine when it ends."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        _give_back()

    return df.mapInArrow(run, schema)


def _give_back() -> None:
    """A worker outlives its tasks, and memory that it merely keeps counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def key_runs(batches: Batches, key: str) -> Iterator[pa.Table]:
    """Rows of one key after the other, from batches in which equal keys are adjacent."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            if held and keys[low] != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            held_key = keys[low]
    if held:
        yield pa.Table.from_batches(held)


SLOT_BITS = 23
BROADCAST_BITS = 20
_PAGE = 1 << 10


def slot_of(column: str) -> Column:
    """A number below 2 ** SLOT_BITS for every value, null included."""
    return F.xxhash64(column).bitwiseAND(F.lit((1 << SLOT_BITS) - 1))


def slot_bits(slots: DataFrame) -> np.ndarray:
    """One bit per slot that occurs in ``slots`` (slot long): 1 MB, whatever the input.

    Pages of 1 KB are ORed on the executors; at most 1,024 of them reach the driver.
    A full filter still lets everything through, so it decides about speed only.
    """

    def flag(batches: Batches) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << SLOT_BITS, bool)
        for batch in batches:
            bits[batch.column("slot").to_numpy()] = True
        pages = np.packbits(bits).reshape(-1, _PAGE)
        used = np.flatnonzero(pages.any(axis=1))
        yield pa.record_batch({"page": used.astype(np.int32), "bits": pa.array([pages[i].tobytes() for i in used], pa.binary())})

    def merge(batches: Batches) -> Iterator[pa.RecordBatch]:
        for run in key_runs(batches, "page"):
            merged = np.zeros(_PAGE, np.uint8)
            for raw in run.column("bits").to_pylist():
                merged |= np.frombuffer(raw, np.uint8)
            yield pa.record_batch({"page": run.column("page").combine_chunks()[:1], "bits": pa.array([merged.tobytes()], pa.binary())})

    pages = in_arrow(slots.select("slot"), flag, "page int, bits binary")
    merged = in_arrow(pages.repartition(16, "page").sortWithinPartitions("page"), merge, "page int, bits binary")
    bits = np.zeros((1 << SLOT_BITS) // 8, np.uint8).reshape(-1, _PAGE)
    for row in merged.collect():
        bits[row["page"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.ravel()


def has_bit(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 > 0


def split_by(rows: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``column`` may be among ``ids`` (one column), and those where it surely is not.

    The second part need not be joined, and so is not shuffled. What is broadcast are
    hashes below 2 ** BROADCAST_BITS, a million numbers at most whatever the input;
    if nearly all of them occur, nearly all rows are in the first part.
    """

    def few(name: str) -> Column:
        return F.xxhash64(name).bitwiseAND(F.lit((1 << BROADCAST_BITS) - 1))

    slot = fresh_name("slot")
    known = F.broadcast(ids.select(few(ids.columns[0]).alias(slot)).distinct())
    on = few(column) == F.col(slot)
    return rows.join(known, on, "left_semi"), rows.join(known, on, "left_anti")


def without(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``rows`` whose ``column`` is not among ``ids`` (one column)."""
    doubtful, clear = split_by(rows, column, ids)
    name = fresh_name("gone")
    gone = ids.select(F.col(ids.columns[0]).alias(name))
    return clear.union(doubtful.join(gone, F.col(column).eqNullSafe(F.col(name)), "left_anti"))


def components(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """(id, component): the smallest id each end of an edge can reach.

    Edges may repeat, run both ways or join an id to itself. Alternating
    large-star and small-star steps: each hangs neighbours onto the smallest one,
    never creates more edges than there are, and needs a number of rounds that
    grows with the logarithm of the longest path. Hubs are aggregated map-side,
    and joined in a way that lets Spark split them. Every round is written to the
    shared folder, so a lost executor costs a part of one round.
    """
    high, low = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    now = stored(edges.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), name)
    state = _signature(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            both.where("v > u")
            .join(smallest.withColumnRenamed("u", "k"), F.col("u").eqNullSafe(F.col("k")))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = stored(large, name)
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(smallest.withColumnRenamed("u", "k"), F.col("u").eqNullSafe(F.col("k")))
            .selectExpr("inline(array(struct(v AS u, m AS v), struct(u AS u, m AS v)))")
            .where("u > v")
            .distinct()
        )
        now = stored(small, name)
        before, state = state, _signature(now)
        if state == before:
            break
    members = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.union(members.select("component", "component").distinct())


def _signature(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them: unchanged once the stars are final."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
    )
