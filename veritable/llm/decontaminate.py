"""Benchmark decontamination: SimHash of item-sized windows, verified exactly.

A shingle weighs less the more items have it, and nothing if no item has it. The
similarity of a window to an item is the share of the item's weight that the window
holds, repeated shingles counted.

1. Windows. A window is as long as an item. Windows are laid where a shingle of the
   document is a telling one of an item, at the offset it has there. Telling are an
   item's rarest shingles, as many as together outweigh what a similar window may lack:
   a window without any of them is below the similarity. Phrases that many items share
   open no windows, unless an item has nothing else. Documents are scanned once per
   block of items; a block holds about ``BLOCK_SHINGLES`` shingles, which is what
   is broadcast, however many items there are.
2. Fingerprints. The SimHash of a window has 64 bits. Its shingles vote with the roots of
   their weights, which makes the cosine of window and item follow the similarity.
3. Multi-index Hamming. The fingerprint is cut into ``_PARTS`` parts of 16 bits.
   If two differ in at most ``radius`` bits, some part differs in at most
   ``radius // _PARTS`` bits. The radius follows from the similarity, see
   ``radius_for``: 19 bits for 0.8. Items are entered under every value that near, windows
   are looked up under their own: an equi-join that loses no fingerprint within
   the radius.
4. Verification of the similarity, on the shingles that a window shares with any item.

Hits and votes are worked off in portions of a fixed size, so a task's memory does not
depend on how long a text is or how often it says what items say.

Words are compared in lower case, of all scripts.

Edge cases: null and empty texts match nothing, on either side; items of fewer
words than a shingle are one shingle, of the whole sequence; documents shorter
than an item are compared as a whole. Rows with one doc_id count as one document,
items with one item_id keep their best match; of equally similar windows the first
one counts. Rows with a null id are found under that. Extra columns are ignored,
whatever their names. An empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.llm.common import Batches, in_arrow
from veritable.llm.words import U64, Words, mix, slices, windows, words_of
from veritable.sources.scratch import scratch_path, stored

BLOCK_SHINGLES = 1 << 20
_DEVIATIONS = 3.3
_PARTS, _PART_BITS = 4, 16
#: What is worked off at once: places that items begin at, and shingles that vote.
_HITS, _VOTES = 1 << 17, 1 << 16
_LAID = "block int, doc_id long, start int, n_words int, shingles binary, fingerprint long"


def _runs(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    value, at = windows(words, width)
    return mix(value ^ U64(width)), at


def simhash(shingles: np.ndarray, weights: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Fingerprints of the shingle lists shingles[cuts[i]:cuts[i + 1]], none of them empty."""
    bits = np.unpackbits(mix(shingles).view(np.uint8).reshape(-1, 8), axis=1)
    votes = np.add.reduceat((bits * 2.0 - 1) * np.sqrt(weights)[:, None], cuts[:-1], axis=0)
    return np.packbits(votes > 0, axis=1).reshape(-1, 8).copy().view(np.int64).ravel()


@dataclass
class Items:
    """Shingles of a block of items, sorted: all with their weights, and the telling ones."""

    width: int  # words a shingle; fewer for shorter items
    known: np.ndarray
    weight: np.ndarray
    shingle: np.ndarray  # telling: with the item's offset and number of words
    offset: np.ndarray
    words: np.ndarray


def _shingled(items: DataFrame, width: int) -> DataFrame:
    """(item_id, n_words, width, shingles) of every item with words."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words = words_of(piece.column("text"))
                rows = []
                for i, number in enumerate(piece.column("item_id").to_pylist()):
                    own = words.hash[words.first[i] : words.first[i + 1]]
                    if len(own):
                        wide = min(width, len(own))
                        shingles, _ = _runs(Words(own, np.array([0, len(own)]), own, own), wide)
                        rows.append((number, len(own), wide, shingles.view(np.int64)))
                if rows:
                    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
                    columns = [pa.array(list(x), kind) for x, kind in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, ["item_id", "n_words", "width", "shingles"])

    kept = items.select(F.col("item_id").cast("long"), F.lower(F.col("text").cast("string")).alias("text"))
    return in_arrow(kept, run, "item_id long, n_words int, width int, shingles array<long>")


def telling(shingles: np.ndarray, weights: np.ndarray, similarity: float) -> np.ndarray:
    """Which of an item's shingles are telling: without all of them, the similarity cannot be reached."""
    own, first, where, times = np.unique(shingles, return_index=True, return_inverse=True, return_counts=True)
    total = times * weights[first]
    order = np.argsort(-weights[first], kind="stable")
    needed = np.searchsorted(np.cumsum(total[order]), (1 - similarity) * total.sum() * (1 + 1e-9), "right") + 1
    chosen = np.zeros(len(own), bool)
    chosen[order[:needed]] = True
    return chosen[where]


def _items(benchmark: DataFrame, width: int, similarity: float) -> DataFrame:
    """(item, item_id, n_words, width, shingles, weights, telling, fingerprint) of every item with words.

    ``item`` is a number of its own for every row of the benchmark.
    """

    def packed(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: dict[str, list] = {"shingles": [], "weights": [], "telling": [], "fingerprint": []}
            for entries in batch.column("list").to_pylist():
                shingles = np.array([e["shingle"] for e in entries], np.int64).view(U64)
                weights = np.array([e["weight"] for e in entries])
                made["shingles"].append(shingles.tobytes())
                made["weights"].append(weights.tobytes())
                made["telling"].append(telling(shingles, weights, similarity).tobytes())
                made["fingerprint"].append(simhash(shingles, weights, np.array([0, len(shingles)]))[0])
            kinds = {"shingles": pa.binary(), "weights": pa.binary(), "telling": pa.binary(), "fingerprint": pa.int64()}
            columns = {name: batch.column(name) for name in ("item", "item_id", "n_words", "width")}
            yield pa.record_batch(columns | {name: pa.array(made[name], kind) for name, kind in kinds.items()})

    rows = stored(_shingled(benchmark, width), "leak-items").select(F.monotonically_increasing_id().alias("item"), "*")
    rows = stored(rows, "leak-items")
    single = rows.select("item", "item_id", "n_words", "width", F.posexplode("shingles").alias("place", "shingle"))
    spread = single.groupBy("shingle", "item").agg(F.lit(1).alias("one")).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    weighed = single.join(spread.withColumnRenamed("shingle", "s"), F.expr("shingle <=> s"))
    # One list per item: as long as the item.
    entry = F.struct("place", "shingle", (1 / F.log2(1.0 + F.col("n"))).alias("weight"))
    listed = weighed.groupBy("item", "item_id", "n_words", "width").agg(F.sort_array(F.collect_list(entry)).alias("list"))
    schema = "item long, item_id long, n_words int, width int, shingles binary, weights binary, telling binary, fingerprint long"
    return in_arrow(listed, packed, schema)


def _block(rows: pa.Table) -> list[Items]:
    """The shingles of some items, by shingle width."""
    found = []
    for width in sorted(set(rows["width"].to_pylist())):
        own = rows.filter(pa.array(rows["width"].to_numpy() == width))
        lists = [np.frombuffer(x, U64) for x in own["shingles"].to_pylist()]
        shingle = np.concatenate(lists)
        weight = np.concatenate([np.frombuffer(x, np.float64) for x in own["weights"].to_pylist()])
        chosen = np.concatenate([np.frombuffer(x, bool) for x in own["telling"].to_pylist()])
        known, first = np.unique(shingle, return_index=True)
        offset = np.concatenate([np.arange(len(x)) for x in lists])[chosen]
        size = np.repeat(own["n_words"].to_numpy(), [len(x) for x in lists])[chosen]
        entries = np.unique(np.rec.fromarrays([shingle[chosen], size, offset], names="shingle,words,offset"))
        found.append(Items(width, known, weight[first], entries.shingle, entries.offset, entries.words))
    return found


def _portions(counts: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of ``counts`` that add up to ``most`` at most, of one entry at least."""
    ends = np.cumsum(counts)
    low = 0
    while low < len(counts):
        before = ends[low] - counts[low]
        high = max(low + 1, int(np.searchsorted(ends, before + most, "right")))
        yield slice(low, high)
        low = high


def _windows(batches: Batches, number: int, block: list[Items]) -> Iterator[pa.RecordBatch]:
    """``_LAID``: every window with a telling shingle of an item as long, its known shingles and fingerprint."""
    for batch in batches:
        for piece in slices(batch, "text"):
            words = words_of(piece.column("text"))
            owner = words.owner
            for items in block:
                value, at = _runs(words, items.width)
                spot = np.minimum(np.searchsorted(items.known, value), len(items.known) - 1)
                place = np.flatnonzero(items.known[spot] == value)
                shingles, weights = value[place], items.weight[spot[place]]
                low = np.searchsorted(items.shingle, shingles, "left")
                count = np.searchsorted(items.shingle, shingles, "right") - low
                hit = np.flatnonzero(count)
                for some in _portions(count[hit], _HITS):
                    part = hit[some]
                    times = count[part]
                    entry = np.repeat(low[part] - np.cumsum(times) + times, times) + np.arange(times.sum())
                    begins = np.repeat(at[place[part]], times)
                    doc = owner[begins]
                    first, last = words.first[doc], words.first[doc + 1]
                    size = np.minimum(items.words[entry], last - first)
                    start = np.clip(begins - items.offset[entry], first, last - size)
                    spans = np.unique(np.stack([start, items.words[entry], size]), axis=1)
                    # The known shingles of a window are a run of all known ones.
                    begin = np.searchsorted(at, spans[0])
                    inside = np.searchsorted(place, begin)
                    held = np.searchsorted(place, begin + spans[2] - items.width + 1) - inside
                    for few in _portions(held, _VOTES):
                        cuts = np.concatenate(([0], np.cumsum(held[few])))
                        flat = np.repeat(inside[few] - cuts[:-1], held[few]) + np.arange(cuts[-1])
                        doc = owner[spans[0][few]]
                        lists = pa.array([shingles[a : a + n].tobytes() for a, n in zip(inside[few], held[few])], pa.binary())
                        yield pa.record_batch(
                            {
                                "block": pa.array(np.full(len(doc), number, np.int32)),
                                "doc_id": piece.column("doc_id").take(pa.array(doc)),
                                "start": pa.array((spans[0][few] - words.first[doc]).astype(np.int32)),
                                "n_words": pa.array(spans[1][few].astype(np.int32)),
                                "shingles": lists,
                                "fingerprint": simhash(shingles[flat], weights[flat], cuts),
                            }
                        )


def radius_for(similarity: float) -> int:
    """Bits in which windows of at least ``similarity`` differ, but for about one in a thousand at that bound.

    A bit differs with a chance of the angle / pi, independently of the others. Where a
    window holds a share s of an item's weight, and nothing of other items, the cosine is
    the root of s; shingles of other items lower it, to s at a window of the item's weight.
    """
    bits, chance = _PARTS * _PART_BITS, math.acos(math.sqrt(min(1.0, max(0.0, similarity)))) / math.pi
    return min(bits, math.ceil(bits * chance + _DEVIATIONS * math.sqrt(bits * chance * (1 - chance))))


def _near_values(radius: int) -> np.ndarray:
    """All 16-bit masks with at most ``radius`` bits."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(_PART_BITS), n)]
    return np.array(masks, np.int64)


def _index(items: DataFrame, radius: int) -> DataFrame:
    """Where an item is entered, in each part for every value near its own."""
    masks = _near_values(radius // _PARTS)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("fingerprint").to_numpy()
            for part in range(_PARTS):
                value = (own >> (part * _PART_BITS)) & 0xFFFF
                again = pa.array(np.repeat(np.arange(len(own)), len(masks)))
                yield pa.record_batch(
                    {
                        "own_block": batch.column("block").take(again),
                        "number": batch.column("item").take(again),
                        "size": batch.column("n_words").take(again),
                        "print": np.repeat(own, len(masks)),
                        "at": pa.array(np.full(len(again), part, np.int32)),
                        "near": (value[:, None] ^ masks[None, :]).ravel(),
                    }
                )

    kept = items.select("block", "item", "n_words", "fingerprint")
    # A few items at a time: each becomes thousands of rows.
    return in_arrow(kept.repartition("item"), run, "own_block int, number long, size int, print long, at int, near long")


def _similarity(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Share of the item's shingle weights that the window holds."""
    for batch in batches:
        scores = []
        columns = (batch.column(c).to_pylist() for c in ("shingles", "item_shingles", "weights"))
        for own, item, weight in zip(*columns):
            ours, counts = np.unique(np.frombuffer(own, U64), return_counts=True)
            theirs, at, wanted = np.unique(np.frombuffer(item, U64), return_index=True, return_counts=True)
            weights = np.frombuffer(weight, np.float64)[at]
            spot = np.minimum(np.searchsorted(ours, theirs), len(ours) - 1)
            held = np.where(ours[spot] == theirs, np.minimum(counts[spot], wanted), 0)
            scores.append(float((held * weights).sum() / (wanted * weights).sum()))
        kept = [n for n in batch.schema.names if n not in ("shingles", "item_shingles", "weights")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(scores, pa.float64())], [*kept, "similarity"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 5, similarity: float = 0.8, radius: int | None = None) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity): the best window of each item in each document.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Only matches of
    at least ``similarity`` within ``radius`` bits (``radius_for``) are returned.
    """
    radius = radius_for(similarity) if radius is None else radius
    spark = docs.sparkSession
    items = stored(_items(benchmark, width, similarity), "leak-items")
    total = items.agg(F.sum(F.octet_length("shingles"))).first()[0] or 0
    blocks = -(-total // (8 * BLOCK_SHINGLES)) or 1
    items = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long"), F.lower(F.col("text").cast("string")).alias("text"))
    path = scratch_path(spark, "leak-windows")
    for number in range(blocks):
        # Bounded by BLOCK_SHINGLES but for the spread of the hash and the longest item.
        own = items.where(F.col("block") == number).select("n_words", "width", "shingles", "weights", "telling")
        block = spark.sparkContext.broadcast(_block(own.toArrow()))
        laid = in_arrow(texts, lambda batches, number=number, block=block: _windows(batches, number, block.value), _LAID)
        laid.write.mode("append").parquet(path)
        block.destroy()
    # Portions of one text may lay a window twice.
    laid = spark.read.schema(_LAID).parquet(path)
    parts = F.array(*[F.struct(F.lit(p).alias("part"), F.shiftright("fingerprint", p * _PART_BITS).bitwiseAND(F.lit(0xFFFF)).alias("value")) for p in range(_PARTS)])
    probes = laid.select("block", "fingerprint", "n_words").distinct().select("block", "fingerprint", "n_words", F.inline(parts))
    # Spark takes the index for as small as the items; it is some thousand times larger.
    on = F.expr("block = own_block AND n_words = size AND part = at AND value = near")
    met = probes.join(_index(items, radius).hint("merge"), on)
    hamming = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("print"))).cast("int")
    near = met.withColumn("hamming", hamming).where(F.col("hamming") <= radius).selectExpr("block AS b", "fingerprint AS f", "n_words AS w", "number", "hamming").distinct()
    pairs = laid.join(near, F.expr("block <=> b AND fingerprint <=> f AND n_words <=> w"))
    weighed = items.selectExpr("item", "item_id", "shingles AS item_shingles", "weights")
    pairs = pairs.join(weighed, F.expr("number <=> item"))
    pairs = pairs.select("doc_id", "item_id", "start", "n_words", "hamming", "shingles", "item_shingles", "weights")
    scored = in_arrow(pairs, _similarity, "doc_id long, item_id long, start int, n_words int, hamming int, similarity double")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n_words", "hamming")).alias("best")
    return (
        scored.where(F.col("similarity") >= similarity)
        .groupBy("doc_id", "item_id")
        .agg(best)
        .select(
            "doc_id",
            "item_id",
            (-F.col("best.before")).alias("start_word"),
            "best.n_words",
            "best.hamming",
            "best.similarity",
        )
    )
