"""Embedding near-duplicates by PCA-ordered tiled comparison.

1. Vectors are scaled to length one in double precision; equal ones become one
   vertex with a weight, so a vector that a third of all rows share is one row.
2. PCA. Second moments are added up in Spark (d * d numbers, whatever the number
   of rows) and give an orthogonal basis, ordered by variance. Cosines do not
   change under it.
3. Tiles. Two linked vectors are at most ``sqrt(2 - 2 t)`` apart, hence also in each
   of the two leading coordinates. A grid of that width sends them to the same or
   to neighbouring cells; cells are cut into tiles of about ``TILE_ROWS`` vectors,
   as many as it takes. Neighbouring tiles meet in an equi-join.
4. A pair of tiles accumulates products over leading dimensions first. What the
   other dimensions can add is at most the product of the suffix norms; pairs that
   cannot reach the threshold stop there, the others go on, and the last ones are
   measured in the given coordinates.
5. Links are counted by weight; each pair of tiles returns a spanning forest, which
   ``components`` joins.

Edge cases: null, empty and zero vectors, and those with null or non-finite
components, link with nothing and are their own component. Vectors of different
length are compared as if the shorter one ended in zeros. Repeated ids stay
repeated rows; rows with equal vectors are linked with each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.llm.common import Batches, components, in_arrow, key_runs
from veritable.sources.scratch import stored

TILE_ROWS = 4096
_STAGES = (8, 16, 32)  # dimensions after which the bound is tested
_BLOCK = 512
_SLACK = 1e-9  # for the rounding of bounds


def _unit_rows(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Each vector scaled to length one, or None."""
    for row in column:
        values = row.as_py()
        if not values or any(v is None for v in values):
            yield None
            continue
        vector = np.array(values, np.float64)
        largest = np.abs(vector).max()
        if not np.isfinite(largest) or largest == 0:
            yield None
            continue
        vector /= largest  # so that squares neither overflow nor vanish
        yield vector / np.sqrt(vector @ vector)


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, unit) of every row: unit is packed doubles, or null with key."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, packed = [], []
            for unit in _unit_rows(batch.column("embedding")):
                if unit is None:
                    keys.append(None)
                    packed.append(None)
                    continue
                raw = (np.trim_zeros(unit, "b") + 0.0).tobytes()
                packed.append(raw)
                keys.append(int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True))
            yield pa.record_batch(
                {"vec_id": batch.column("vec_id"), "key": pa.array(keys, pa.int64()), "unit": pa.array(packed, pa.binary())}
            )

    kept = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return in_arrow(kept, run, "vec_id long, key long, unit binary")


def _matrix(packed: list[bytes], width: int) -> np.ndarray:
    rows = np.zeros((len(packed), width))
    for i, raw in enumerate(packed):
        one = np.frombuffer(raw, np.float64)
        rows[i, : len(one)] = one
    return rows


def principal_axes(units: DataFrame, width: int) -> np.ndarray:
    """Orthonormal columns by falling variance."""

    def moments(batches: Batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = _matrix(batch.column("unit").to_pylist(), width)
            total += rows.T @ rows
        i, j = np.nonzero(total)
        yield pa.record_batch({"i": i.astype(np.int32), "j": j.astype(np.int32), "x": total[i, j]})

    added = in_arrow(units.select("unit"), moments, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    cells = added.toArrow()
    total = np.zeros((width, width))
    total[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["x"].to_numpy()
    return np.linalg.eigh((total + total.T) / 2)[1][:, ::-1]


def linked(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of all pairs with a cosine of at least ``threshold``; i < j if ``same``."""
    width = a.shape[1]
    stages = [0, *(s for s in _STAGES if s < width), width]
    turned_a, turned_b = a @ axes, b @ axes

    def suffixes(turned: np.ndarray) -> np.ndarray:
        squares = np.cumsum(turned[:, ::-1] ** 2, axis=1)[:, ::-1]
        return np.sqrt(np.concatenate((squares, np.zeros((len(turned), 1))), axis=1))

    rest_a, rest_b = suffixes(turned_a), suffixes(turned_b)
    found = []
    for low in range(0, len(a), _BLOCK):
        for start in range(low if same else 0, len(b), _BLOCK):
            x, y = slice(low, low + _BLOCK), slice(start, start + _BLOCK)
            first = stages[1]
            partial = turned_a[x, :first] @ turned_b[y, :first].T
            alive = partial + rest_a[x, first, None] * rest_b[None, y, first] >= threshold - _SLACK
            i, j = np.nonzero(alive)
            if same and low == start:
                i, j = i[i < j], j[i < j]
            sums = partial[i, j]
            i, j = i + low, j + start
            for begin, stop in zip(stages[1:], stages[2:]):
                if not len(i):
                    break
                sums = sums + np.einsum("ij,ij->i", turned_a[i, begin:stop], turned_b[j, begin:stop])
                keep = sums + rest_a[i, stop] * rest_b[j, stop] >= threshold - _SLACK
                i, j, sums = i[keep], j[keep], sums[keep]
            exact = np.einsum("ij,ij->i", a[i], b[j]) >= threshold
            found.append((i[exact], j[exact]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _compare(batches: Batches, axes: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    width = len(axes)
    for run in key_runs(batches, "pair"):
        other = run.column("other").to_numpy()
        keys, weights = run.column("key").to_numpy(), run.column("weight").to_numpy()
        rows = _matrix(run.column("unit").to_pylist(), width)
        left, right = np.flatnonzero(other == 0), np.flatnonzero(other == 1)
        same = not len(right)
        i, j = linked(rows[left], rows[left if same else right], axes, threshold, same)
        i, j = left[i], (left if same else right)[j]
        if not len(i):
            continue
        links = np.bincount(i, weights[j], len(rows)) + np.bincount(j, weights[i], len(rows))
        hit = np.flatnonzero(links)
        parent = np.arange(len(rows))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        forest = []
        for p, q in zip(i.tolist(), j.tolist()):
            p, q = root(p), root(q)
            if p != q:
                parent[max(p, q)] = min(p, q)
                forest.append((p, q))
        ends = np.array(forest).reshape(-1, 2)
        yield pa.record_batch(
            {
                "a": pa.array(np.concatenate((keys[hit], keys[ends[:, 0]]))),
                "b": pa.array([None] * len(hit) + keys[ends[:, 1]].tolist(), pa.int64()),
                "links": pa.array(np.concatenate((links[hit], np.zeros(len(ends)))).astype(np.int64)),
            }
        )


def _tile_rows(distinct: DataFrame, axes: np.ndarray, threshold: float) -> DataFrame:
    """(pair, other, key, weight, unit): the vectors of every pair of neighbouring tiles."""
    width = len(axes)
    cell = float(np.sqrt(2 - 2 * threshold)) + 1e-6

    def place(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leading = _matrix(batch.column("unit").to_pylist(), width) @ axes[:, :2]
            grid = np.floor(leading / cell).astype(np.int32)
            grid = np.concatenate((grid, np.zeros((len(grid), 2 - grid.shape[1]), np.int32)), axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(grid[:, 0]), pa.array(grid[:, 1])], [*batch.schema.names, "cx", "cy"]
            )

    placed = in_arrow(distinct, place, "key long, weight long, unit binary, cx int, cy int")
    placed = stored(placed, "vector-cells")
    cells = placed.groupBy("cx", "cy").agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).alias("cuts"))
    tiles = stored(cells.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))), "vector-tiles")
    steps = F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy")) for x, y in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    ahead = tiles.select("cx", "cy", "part", F.inline(steps))
    ahead = ahead.selectExpr("cx", "cy", "part", "cx + dx AS nx", "cy + dy AS ny", "dx = 0 AND dy = 0 AS home")
    pairs = ahead.join(
        tiles.selectExpr("cx AS ox", "cy AS oy", "part AS opart"),
        F.expr("nx <=> ox AND ny <=> oy AND (NOT home OR part <= opart)"),
    ).withColumn("pair", F.xxhash64("cx", "cy", "part", "ox", "oy", "opart"))
    alone = F.expr("home AND part = opart")
    sides = pairs.select(F.col("cx").alias("tx"), F.col("cy").alias("ty"), F.col("part").alias("tile"), "pair", F.lit(0).alias("other")).union(
        pairs.where(~alone).select("ox", "oy", "opart", "pair", F.lit(1))
    )
    cut = placed.join(
        cells.select(F.col("cx").alias("kx"), F.col("cy").alias("ky"), "cuts"), F.expr("cx <=> kx AND cy <=> ky")
    ).withColumn("part", F.pmod(F.xxhash64("key"), F.col("cuts")))
    return cut.join(sides, F.expr("cx <=> tx AND cy <=> ty AND part <=> tile")).select("pair", "other", "key", "weight", "unit")


def near_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding).

    Rows link when their cosine is at least ``threshold`` (above 0); n_links counts
    other rows; component_id is the smallest vec_id reachable by links.
    """
    units = stored(unit_vectors(vectors), "vector-units")
    width = (units.agg(F.max(F.octet_length("unit"))).first()[0] or 0) // 8
    distinct = units.where("key IS NOT NULL").groupBy("key").agg(
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("vec_id"), F.first("unit").alias("unit")
    )
    distinct = stored(distinct, "vector-distinct")
    spark = vectors.sparkSession
    if width:
        axes = principal_axes(distinct, width)
        rows = _tile_rows(distinct.select("key", "weight", "unit"), axes, threshold)
        shared = spark.sparkContext.broadcast(axes)
        found = in_arrow(
            rows.repartition("pair").sortWithinPartitions("pair"),
            lambda batches: _compare(batches, shared.value, threshold),
            "a long, b long, links long",
        )
        found = stored(found, "vector-links")
    else:
        found = spark.createDataFrame([], "a long, b long, links long")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    reached = components(found.where("b IS NOT NULL"), "a", "b", "vector-stars")
    names = distinct.select(F.col("key").alias("k"), "vec_id")
    named = (
        reached.join(names, F.expr("id <=> k")).groupBy("component").agg(F.min("vec_id").alias("component_id"))
    )
    reached = reached.join(named, "component").select("id", "component_id")
    vertices = (
        distinct.select(F.col("key").alias("vertex"), "weight", F.col("vec_id").alias("least"))
        .join(counts, F.expr("vertex <=> a"), "left")
        .join(reached, F.expr("vertex <=> id"), "left")
        .selectExpr(
            "vertex", "weight - 1 + coalesce(links, 0) AS links", "coalesce(component_id, least) AS reached_id"
        )
    )
    return (
        units.join(vertices, F.expr("key <=> vertex"), "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("reached_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
