"""Hard negatives by threshold joins over pruned inverted indexes.

Some rows are anchors. An anchor's positives are its best other rows of the same label;
each positive opens a window of scores, and the window's negatives are the best rows of
another label inside it. Both questions are one search: the first k rows of a window
[low, high], given which labels count.

A search runs as joins under a threshold. Windows start with a high one. A join finds
every row whose score reaches it; a window that has its k rows is done, the others come
again with a lower threshold, at last with ``low`` itself. Nothing is estimated: the
thresholds decide how much is pruned, never what is found.

The join is that of L2AP, over blocks of rows. Dimensions are taken in the order of their
energy in the whole table. A block's index omits the last dimensions of every row, as many
as cannot matter: their norm times the greatest norm that any row has there stays below
the lowest threshold. What remains is kept by dimension, rows with many indexed
dimensions first, so that a posting list is the front of an array. Anchors stream through
the index: scores are accumulated from list to list, and a pair is dropped when its sum
plus the product of the norms of what is left cannot reach the anchor's threshold. Pairs
that survive get the exact score.

Anchors are a fixed share of all rows (the query set), and each visits every block; that
is the product that the question asks for, in blocks of ``_BLOCK`` rows, and the anchors
are sent once per block and round. A task holds one block and ``_ANCHORS`` anchors at
once. A block reports k rows a window at most. Labels are compared inside a block, not
shuffled by, so a label that a third of all rows have costs nothing.

Scores are sums of products of whole numbers held as doubles: exact while below 2^53.

Edge cases: a row with a null id, label or vector, or with null or non-finite components,
takes no part. Shorter vectors count as padded with zeros. Rows that repeat, also under
one id, are rows of their own, as anchors too; ties go to the smaller id. Fewer rows than
asked for are returned as they are; negative positive scores have no window. Extra columns
are ignored, whatever their names. An empty table gives an empty result. Of the table,
only numbers per dimension come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritable.llm.common import Batches, in_arrow
from veritable.sources.scratch import stored

_BLOCK = 8192
_ANCHORS = 256
_GROUP = 8
_PAIRS = 1 << 15
#: Part of the possible pairs below which they are finished one by one.
_FEW = 0.02
#: Bounds are rounded; they must not be too low.
_SLACK = 1 + 1e-9

#: First thresholds for positives, as cosines with the longest row; then all rows count.
POSITIVE_STEPS = (0.7, 0.35)
#: How far down its window the threshold of negatives goes.
NEGATIVE_STEPS = (0.125, 0.5, 1.0)

_FOUND = "row long, low double, high double, found_id long, score double"


def usable(rows: DataFrame) -> DataFrame:
    """(row, vec_id, label, vector) of the rows that take part; ``row`` is a number of their own."""
    vector = F.col("vector").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), vector.alias("vector"))
    kept = kept.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(finite)
    return kept.select(F.monotonically_increasing_id().alias("row"), "*")


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``size`` columns."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == size).all():
        return flat.reshape(-1, size).astype(np.float64)
    made = np.zeros((len(lengths), size))
    made[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return made


def _rest_norms(matrix: np.ndarray) -> np.ndarray:
    """Norms of what follows each boundary between groups of dimensions, zero after the last."""
    cuts = np.arange(0, matrix.shape[1], _GROUP)
    squares = np.add.reduceat(matrix * matrix, cuts, axis=1) if matrix.size else np.zeros((len(matrix), len(cuts)))
    norms = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
    return np.hstack([norms, np.zeros((len(matrix), 1))])


class _Layout:
    """Order of the dimensions, and the greatest norm of any row after each boundary."""

    def __init__(self, rows: DataFrame) -> None:
        def energy(batches: Batches) -> Iterator[pa.RecordBatch]:
            total = np.zeros(0)
            for batch in batches:
                size = int(np.diff(batch.column("vector").offsets.to_numpy()).max(initial=0))
                own = (_matrix(batch.column("vector"), size) ** 2).sum(axis=0)
                if size > len(total):
                    total, own = own, total
                total[: len(own)] += own
            yield pa.record_batch({"d": pa.array(np.arange(len(total)), pa.int32()), "x": total})

        summed = in_arrow(rows.select("vector"), energy, "d int, x double").groupBy("d").agg(F.sum("x").alias("x"))
        energies = {r["d"]: r["x"] for r in summed.collect()}
        self.order = np.array(sorted(energies, key=lambda d: (-energies[d], d)), np.int64)
        size = len(self.order)
        laid = self.laid

        def norms(batches: Batches) -> Iterator[pa.RecordBatch]:
            most = np.zeros(0)
            for batch in batches:
                if batch.num_rows:
                    own = _rest_norms(laid(batch.column("vector"))).max(axis=0)
                    most = np.maximum(most, own) if len(most) else own
            yield pa.record_batch({"d": pa.array(np.arange(len(most)), pa.int32()), "x": most})

        greatest = in_arrow(rows.select("vector"), norms, "d int, x double").groupBy("d").agg(F.max("x").alias("x"))
        found = {r["d"]: r["x"] for r in greatest.collect()}
        self.greatest = np.array([found.get(b, 0.0) for b in range(-(-size // _GROUP) + 1)])

    def laid(self, vectors: pa.Array) -> np.ndarray:
        return _matrix(vectors, len(self.order))[:, self.order]


class _Index:
    """Posting lists of one block, without the dimensions that cannot matter."""

    def __init__(self, rows: list[pa.RecordBatch], layout: _Layout, least: float) -> None:
        table = pa.Table.from_batches(rows).combine_chunks()
        matrix = layout.laid(table.column("vector").combine_chunks())
        rest = _rest_norms(matrix)
        groups = rest.shape[1] - 1
        # The groups a row has in the index: up to the first boundary behind which nothing matters.
        covered = rest * layout.greatest * _SLACK < least
        kept = np.where(covered.any(axis=1), covered.argmax(axis=1), groups)
        order = np.argsort(-kept, kind="stable")
        order = order[kept[order] > 0]
        self.kept, self.matrix, self.rest = kept[order], np.ascontiguousarray(matrix[order]), rest[order]
        self.row, self.id, self.label = (table.column(c).to_numpy()[order] for c in ("row", "vec_id", "label"))
        # List g is that of the rows that index group g: the front of the block.
        self.length = [int(np.searchsorted(-self.kept, -g, "left")) for g in range(groups)]

    def pairs(self, asked: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, place in the block, score) of all pairs whose score reaches the anchor's ``least``."""
        size = len(self.kept)
        rest = _rest_norms(asked) * _SLACK
        sums = np.zeros((len(asked), size))
        # A row's norm behind what the index has of it so far.
        behind = self.rest[:, 0].copy()
        alive = np.ones(sums.shape, bool)
        at = np.zeros(size, np.int64)
        for g, length in enumerate(self.length):
            if not length:
                break
            dims = slice(g * _GROUP, (g + 1) * _GROUP)
            sums[:, :length] += asked[:, dims] @ self.matrix[:length, dims].T
            behind[:length] = self.rest[:length, g + 1]
            at[:length] = g + 1
            alive = sums + rest[:, at] * behind >= least[:, None]
            if alive.sum() < _FEW * alive.size:
                break
        who, where = np.nonzero(alive)
        score = np.empty(len(who))
        for low in range(0, len(who), _PAIRS):
            part = slice(low, low + _PAIRS)
            score[part] = np.einsum("ij,ij->i", asked[who[part]], self.matrix[where[part]])
        good = score >= least[who]
        return who[good], where[good], score[good]

    def best(self, anchors: pa.RecordBatch, layout: _Layout, k: int, same_label: bool) -> pa.RecordBatch:
        """The first k rows of the block in each window of each anchor."""
        windows = anchors.column("windows").to_pylist()
        least = np.array([min(w["threshold"] for w in own) for own in windows])
        who, where, score = self.pairs(layout.laid(anchors.column("vector")), least)
        label, row = anchors.column("label").to_numpy()[who], anchors.column("row").to_numpy()[who]
        fits = (self.label[where] == label) == same_label
        fits &= self.row[where] != row
        who, where, score = who[fits], where[fits], score[fits]
        order = np.lexsort((self.id[where], -score, who))
        who, where, score = who[order], where[order], score[order]
        first = np.searchsorted(who, np.arange(len(windows) + 1))
        found: dict[str, list] = {"row": [], "low": [], "high": [], "found_id": [], "score": []}
        for i, (key, own) in enumerate(zip(anchors.column("row").to_pylist(), windows, strict=True)):
            scores, places = score[first[i] : first[i + 1]], where[first[i] : first[i + 1]]
            for w in own:
                inside = np.flatnonzero((scores >= w["threshold"]) & (scores <= w["high"]))[:k]
                found["row"] += [key] * len(inside)
                found["low"] += [w["low"]] * len(inside)
                found["high"] += [w["high"]] * len(inside)
                found["found_id"] += self.id[places[inside]].tolist()
                found["score"] += scores[inside].tolist()
        types = {"row": pa.int64(), "low": pa.float64(), "high": pa.float64(), "found_id": pa.int64(), "score": pa.float64()}
        return pa.record_batch({name: pa.array(values, types[name]) for name, values in found.items()})


def _joined(rows: DataFrame, open_windows: DataFrame, layout: _Layout, blocks: int, k: int, same_label: bool) -> DataFrame:
    """``_FOUND``: the first k rows at or above the threshold of each window (row, low, high, threshold)."""
    least = open_windows.agg(F.min("threshold")).first()[0]
    packed = open_windows.groupBy("row").agg(F.collect_list(F.struct("low", "high", "threshold")).alias("windows"))
    anchors = rows.join(packed, "row").select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), *rows.columns, "windows"
    )
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    none = F.lit(None).cast("array<struct<low: double, high: double, threshold: double>>")
    indexed = rows.select(block.alias("block"), F.lit(0).alias("kind"), *rows.columns, none.alias("windows"))

    def search(batches: Batches) -> Iterator[pa.RecordBatch]:
        current, held, index = None, [], None
        for batch in batches:
            key = batch.column("block").to_numpy() * 2 + batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                number, kind = divmod(int(key[low]), 2)
                if number != current:
                    current, held, index = number, [], None
                part = batch.slice(low, high - low)
                if kind == 0:
                    held.append(part)
                    continue
                if not held and index is None:
                    continue  # a block that no row fell into
                if index is None:
                    index, held = _Index(held, layout, least), []
                for start in range(0, part.num_rows, _ANCHORS):
                    yield index.best(part.slice(start, _ANCHORS), layout, k, same_label)

    tiles = indexed.union(anchors.select(*indexed.columns)).repartition("block").sortWithinPartitions("block", "kind")
    place = F.expr("row_number() OVER (PARTITION BY row, low, high ORDER BY score DESC, found_id)")
    return in_arrow(tiles, search, _FOUND).withColumn("place", place).where(F.col("place") <= k)


def _search(rows: DataFrame, windows: DataFrame, thresholds: list[Column], layout: _Layout, blocks: int, k: int, same_label: bool) -> DataFrame:
    """The first k rows of every window (row, low, high, norm), under one threshold after the other."""
    left, found = windows, []
    for last, threshold in zip([False] * (len(thresholds) - 1) + [True], thresholds, strict=True):
        now = left.withColumn("threshold", F.greatest("low", threshold))
        joined = stored(_joined(rows, now, layout, blocks, k, same_label), "negatives-found")
        if last:
            return _all(found, joined)
        full = joined.groupBy("row", "low", "high").agg(F.count(F.lit(1)).alias("n"))
        # Done: windows with all their rows, and those whose threshold could go no lower.
        done = full.where(F.col("n") >= k).select("row", "low", "high")
        done = done.union(now.where("threshold = low").select("row", "low", "high")).distinct()
        done = stored(done, "negatives-done")
        found.append(joined.join(done, ["row", "low", "high"], "left_semi"))
        left = stored(left.join(done, ["row", "low", "high"], "left_anti"), "negatives-open")
        if left.isEmpty():
            break
    return _all(found[:-1], found[-1])


def _all(parts: list[DataFrame], last: DataFrame) -> DataFrame:
    for part in parts:
        last = last.unionByName(part)
    return last


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has (vec_id, label, vector), the vectors of whole numbers; ``anchors`` is a
    condition over vec_id and label. A negative's score lies between ``low_percent`` and
    ``high_percent`` of the positive's.
    """
    rows = stored(usable(rows), "negatives-rows")
    spark = rows.sparkSession
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    layout = _Layout(rows)
    blocks = -(-total // _BLOCK)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    everything = [F.lit(sign * float("inf")).alias(name) for sign, name in ((-1, "low"), (1, "high"))]
    windows = rows.where(anchors).select("row", F.col("vec_id").alias("anchor_id"), *everything, norm.alias("norm"))
    windows = stored(windows, "negatives-anchors")
    steps = [F.col("norm") * (cosine * float(layout.greatest[0])) for cosine in POSITIVE_STEPS] + [F.col("low")]
    best = _search(rows, windows, steps, layout, blocks, positives, same_label=True)
    # Whole numbers from here on, so that the bounds of the windows are exact.
    best = best.selectExpr("row", "found_id AS positive_id", "CAST(score AS BIGINT) AS positive_score", "place AS positive_place")
    best = best.selectExpr(
        "*",
        f"CAST(({low_percent} * positive_score + 99) div 100 AS DOUBLE) AS low",
        f"CAST({high_percent} * positive_score div 100 AS DOUBLE) AS high",
    )
    best = stored(best.where("positive_score >= 0 AND low <= high").join(windows.select("row", "anchor_id"), "row"), "negatives-positives")
    asked = stored(best.select("row", "low", "high").distinct(), "negatives-windows")
    down = [F.ceil(F.col("high") - (F.col("high") - F.col("low")) * step).cast("double") for step in NEGATIVE_STEPS]
    found = _search(rows, asked, down, layout, blocks, negatives, same_label=False)
    return best.join(found, ["row", "low", "high"]).selectExpr(
        "anchor_id",
        "positive_id",
        "CAST(place AS INT) AS rank",
        "found_id AS negative_id",
        "positive_score",
        "CAST(score AS BIGINT) AS negative_score",
    )
