"""N-gram Jaccard join over signature trees, complete and without emitting all pairs.

1. Every text becomes the set of its distinct shingles (``words.shingle_sets``),
   every set a 64-bit id. Equal sets are one vertex from here on.
2. Blocks. Two sets of sizes a <= b with a Jaccard of at least t differ in at
   most (1 - t) / (1 + t) * (a + b) shingles, and as b is a / t at most, in no
   more than (1 - t) / t * a. Cutting the hash space into more
   parts than that leaves at least ``_SPARE + 1`` parts in which both agree. One
   key per non-empty part is emitted; sets with more than ``_SPARE`` empty parts
   emit those as well, so no pair is lost. How many parts there are depends on a
   size class, and a set near the border of its class joins the class below too.
   A shared passage does not make two sets agree in a part, so common passages
   cause no hot key; only sets that are alike nearly throughout share keys.
3. Nodes. Sets that share keys are gathered around the smallest set id they
   reach in a few steps over shared keys, and cut into nodes of about
   ``_NODE_SETS`` sets or ``_NODE_SHINGLES`` shingles, however many there are.
   The sets of a node are linked first; then, for homes of several nodes, one set for
   each group found so far is gathered into nodes anew, until those of a home have met.
   Sets linked by then carry one label. Two nodes are compared by those of their sets
   that share enough keys with sets of the other node and of another label: a large
   group of near copies is settled by sets in proportion to its size, and only sets
   that may still link two groups are sent.
4. Trees. A node pair is one small task: both nodes become trees whose inner
   nodes hold the OR of their sets' bitmaps and the range of their sizes. A dual
   traversal drops tree node pairs whose largest possible overlap is too small;
   surviving pairs of sets are compared exactly, unless they are connected by
   links found before. What a node pair returns is a spanning forest of its links.
5. ``components`` joins the forests.

Edge cases: null or empty texts have no shingles, are linked with nothing and are
their own component; equal texts with any number of rows are one vertex; repeated
ids are kept as repeated rows; a null id never becomes a component's name unless
all ids of the component are null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.llm.common import SLOT_BITS, Batches, components, has_bit, in_arrow, key_runs, slot_bits, slot_of
from veritable.llm.words import U64, mix, shingle_sets, slices
from veritable.sources.scratch import stored

_CLASS_RATIO = 1.4
_SPARE = 2  # and one for each _SPARE_SHARE differing shingles allowed
_SPARE_SHARE = 8
_HOME_STEPS = 2
_NODE_SETS = 512
_NODE_SHINGLES = 1 << 19
_FANOUT = 8
_ROUNDS = 6
_CLASS = 1 << 32


def set_id(shingles: np.ndarray) -> int:
    """An id of a set of shingles, as a signed 64-bit number."""
    total = mix(shingles).sum(dtype=U64) if len(shingles) else U64(0)
    return int(mix(np.array([total ^ U64(len(shingles))]))[0].astype(np.int64))


def class_start(k: int) -> int:
    return int(np.ceil(_CLASS_RATIO**k - 1e-9))


def size_classes(n: int, percent: int) -> list[int]:
    """The size classes in which a set of ``n`` shingles looks for partners."""
    k = max(0, int(np.log(n) / np.log(_CLASS_RATIO)) - 1)
    while class_start(k + 1) <= n:
        k += 1
    found = [k]
    # Partners have at least percent % of its size; it meets smaller ones in their class.
    while k and class_start(k) * 100 > percent * n:
        k -= 1
        if class_start(k + 1) > class_start(k):
            found.append(k)
    return found


def block_keys(shingles: np.ndarray, percent: int) -> list[tuple[int, int, np.ndarray]]:
    """(class, need, keys) for each size class of a set.

    Two sets with at least ``percent`` % Jaccard share at least as many keys of
    one class as either of them needs there, and one at least.
    """
    n = len(shingles)
    found = []
    mixed = mix(shingles ^ U64(0xA5A5A5A5A5A5A5A5))
    for k in size_classes(n, percent):
        # The smaller of a pair met in this class has this size at most, the larger
        # 100 / percent times as much: a tighter bound than twice the larger one.
        smaller = class_start(k + 1) - 1
        differing = (100 - percent) * smaller // percent
        spare = _SPARE + differing // _SPARE_SHARE if differing else 0
        parts = differing + 1 + spare
        part = ((shingles >> U64(32)) * U64(parts)) >> U64(32)
        begins = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        sums = mix(np.add.reduceat(mixed, begins))
        used = part[begins]
        salt = U64(k) << U64(40)
        keys = mix(sums ^ mix(used + salt))
        gaps = parts - len(used)
        if gaps > spare:
            empty = np.setdiff1d(np.arange(parts, dtype=U64), used)
            keys = np.concatenate((keys, mix(mix(empty + salt) ^ U64(0x5EED))))
        found.append((k, max(1, spare + 1 - gaps), keys))
    return found


def _sets(batches: Batches, width: int, *columns: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for piece in slices(batch, "text"):
            yield piece, shingle_sets(piece.column("text"), width)


def shingle_counts(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_id) of every row; needs doc_id and text."""

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        for piece, sets in _sets(batches, width):
            yield pa.record_batch(
                {
                    "doc_id": piece.column("doc_id"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set_id": pa.array([set_id(s) for s in sets], pa.int64()),
                }
            )

    return in_arrow(docs.select(F.col("doc_id").cast("long"), "text"), count, "doc_id long, n_shingles long, set_id long")


def _keys(docs: DataFrame, width: int, percent: int) -> DataFrame:
    def emit(batches: Batches) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, width):
            seen = {set_id(s): s for s in sets if len(s)}
            if not seen:
                continue
            found = [(one, *keys) for one, s in seen.items() for keys in block_keys(s, percent)]
            ids, classes, needs, keys = zip(*found)
            counts = [len(k) for k in keys]
            yield pa.record_batch(
                {
                    "key": np.concatenate(keys).astype(np.int64),
                    "set_id": np.repeat(np.array(ids, np.int64), counts),
                    "class_need": np.repeat(np.array(classes, np.int64) * _CLASS + np.array(needs), counts),
                }
            )

    return in_arrow(docs.select("text"), emit, "key long, set_id long, class_need long")


def _shared_keys(keys: DataFrame) -> DataFrame:
    """(key, set_id, class_need, home) of the keys that occur in two sets or more; home is the smallest of the sets.

    Sets that share fewer keys than they need are left out.
    """
    shared = (
        keys.selectExpr(
            "key",
            "set_id",
            "class_need",
            "min(set_id) OVER (PARTITION BY key) AS home",
            "max(set_id) OVER (PARTITION BY key) AS last",
        )
        .where("home < last")
        .drop("last")
        .distinct()
    )
    shared = stored(shared, "jaccard-keys")
    enough = (
        shared.groupBy("set_id", "class_need")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= F.pmod("class_need", F.lit(_CLASS)))
        .select(F.col("set_id").alias("s"), F.col("class_need").alias("c"))
    )
    return shared.join(enough, F.expr("set_id <=> s AND class_need <=> c"), "left_semi")


def _homes(shared: DataFrame) -> DataFrame:
    """(set_id, home): the smallest set id reached in a few steps over shared keys."""
    own = shared.select("key", "set_id")
    homes = stored(shared.groupBy("set_id").agg(F.min("home").alias("home")), "jaccard-homes")
    for step in range(2 * _HOME_STEPS):
        above = homes.withColumnsRenamed({"set_id": "k", "home": "up"})
        if step % 2 == 0:
            further = homes.join(above, F.expr("home <=> k"), "left")
            homes = further.select("set_id", F.coalesce("up", "home").alias("home"))
        else:
            labelled = own.join(above, F.expr("set_id <=> k")).select("key", "set_id", "up")
            lowest = labelled.groupBy("key").agg(F.min("up").alias("low"))
            met = own.join(lowest.withColumnRenamed("key", "k"), F.expr("key <=> k"))
            homes = met.groupBy("set_id").agg(F.min("low").alias("home"))
        homes = stored(homes, "jaccard-homes")
    return homes


def _shingles_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(set_id, shingles) for the wanted (set_id, doc_id), and a few more; texts themselves are not shuffled."""
    mask = (1 << SLOT_BITS) - 1
    slots = F.col("set_id").bitwiseXOR(F.xxhash64("doc_id")).bitwiseAND(F.lit(mask))
    bits = docs.sparkSession.sparkContext.broadcast(slot_bits(wanted.select(slots.alias("slot"))))

    def emit(batches: Batches) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # equal rows of a task come as one, and their copies meet by set id
        for piece, sets in _sets(batches, width):
            ids = np.array([set_id(s) for s in sets], np.int64)
            slot = (ids ^ piece.column("hash").to_numpy()) & mask
            hit = [i for i in np.flatnonzero(has_bit(bits.value, slot)).tolist() if ids[i] not in sent]
            hit = list({int(ids[i]): i for i in hit}.values())
            sent.update(ids[hit].tolist())
            yield pa.record_batch(
                {
                    "set_id": ids[hit],
                    "shingles": pa.array([sets[i].tobytes() for i in hit], pa.binary()),
                }
            )

    hashed = docs.select("text", F.xxhash64(F.col("doc_id").cast("long")).alias("hash"))
    return in_arrow(hashed, emit, "set_id long, shingles binary")


class _Tree:
    """Levels from single sets (0) up to one root: OR-combined bitmaps, size ranges, slack.

    ``slack`` is the largest number of shingles of a set beyond its set bits: a
    set shares at most its slack plus the common bits with another one.
    """

    def __init__(self, sets: list[np.ndarray], bits: int) -> None:
        self.sets = sets
        sizes = np.array([len(s) for s in sets])
        maps = np.zeros((len(sets), bits // 8), np.uint8)
        for i, s in enumerate(sets):
            spot = np.zeros(bits, bool)
            spot[(s & U64(bits - 1)).astype(np.int64)] = True
            maps[i] = np.packbits(spot)
        maps = maps.view(U64)
        slack = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, sizes, sizes, slack)]
        while len(maps) > 1:
            begins = np.arange(0, len(maps), _FANOUT)
            maps = np.bitwise_or.reduceat(maps, begins, axis=0)
            low, high, slack = (
                f.reduceat(x, begins)
                for f, x in zip((np.minimum, np.maximum, np.maximum), self.levels[-1][1:])
            )
            self.levels.append((maps, low, high, slack))


def _possible(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which tree node pairs (i, j) may hold a link, by size ranges and common bits."""
    (maps_a, low_a, high_a, slack_a), (maps_b, low_b, high_b, slack_b) = a, b
    keep = (low_a[i] * percent <= 100 * high_b[j]) & (low_b[j] * percent <= 100 * high_a[i])
    i, j = i[keep], j[keep]
    alive = []
    step = max(1, (1 << 20) // maps_a.shape[1])
    for at in range(0, len(i), step):
        x, y = i[at : at + step], j[at : at + step]
        common = np.bitwise_count(maps_a[x] & maps_b[y]).sum(axis=1, dtype=np.int64)
        most = np.minimum(np.minimum(slack_a[x], slack_b[y]) + common, np.minimum(high_a[x], high_b[y]))
        alive.append(most * (100 + percent) >= percent * (low_a[x] + low_b[y]))
    alive = np.concatenate(alive) if alive else np.zeros(0, bool)
    return i[alive], j[alive]


def _children(nodes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Children of each node, and how many it has, on a level of ``count``."""
    first = nodes * _FANOUT
    return first, np.minimum(first + _FANOUT, count) - first


def linked_pairs(a: list[np.ndarray], b: list[np.ndarray] | None, percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between ``a`` and ``b`` (within ``a`` if None).

    Yields positions in ``a + b``. Depth-first over levels, breadth-first in one.
    """
    sets = a if b is None else a + b
    bits = 256
    while bits < 2 * max(len(s) for s in sets):
        bits *= 2
    order_a = sorted(range(len(a)), key=lambda i: len(a[i]))
    order_b = order_a if b is None else sorted(range(len(b)), key=lambda i: len(b[i]))
    tree_a = _Tree([a[i] for i in order_a], bits)
    tree_b = tree_a if b is None else _Tree([b[i] for i in order_b], bits)
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    level_a, level_b = len(tree_a.levels) - 1, len(tree_b.levels) - 1
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(i):
        i, j = _possible(tree_a.levels[level_a], tree_b.levels[level_b], i, j, percent)
        if level_a == level_b == 0:
            break
        if level_a >= level_b:
            level_a -= 1
            first, count = _children(i, len(tree_a.levels[level_a][1]))
            i = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            j = np.repeat(j, count)
            if b is None and level_a < level_b:  # the other side of the same tree comes down as well
                level_b -= 1
                first, count = _children(j, len(tree_b.levels[level_b][1]))
                j = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                i = np.repeat(i, count)
                keep = i <= j
                i, j = i[keep], j[keep]
        else:
            level_b -= 1
            first, count = _children(j, len(tree_b.levels[level_b][1]))
            j = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            i = np.repeat(i, count)
    offset = 0 if b is None else len(a)
    for x, y in zip(i.tolist(), j.tolist()):
        if b is None and x == y:
            continue
        p, q = order_a[x], offset + order_b[y]
        if root(p) == root(q):
            continue
        one, two = tree_a.sets[x], tree_b.sets[y]
        shared = len(np.intersect1d(one, two, assume_unique=True))
        if shared * (100 + percent) >= percent * (len(one) + len(two)):
            parent[root(p)] = root(q)
            yield p, q


def _links(batches: Batches, percent: int) -> Iterator[pa.RecordBatch]:
    for run in key_runs(batches, "pair"):
        sides: tuple[dict, dict] = ({}, {})
        rows = zip(run.column("other").to_pylist(), run.column("set_id").to_pylist(), run.column("shingles").to_pylist())
        for other, one, raw in rows:
            sides[other][one] = np.frombuffer(raw, U64)
        ids = [*sides[0], *sides[1]]
        found = list(linked_pairs([*sides[0].values()], [*sides[1].values()], percent)) if all(sides) else []
        if found:
            yield pa.record_batch(
                {
                    "a": pa.array([ids[p] for p, _ in found], pa.int64()),
                    "b": pa.array([ids[q] for _, q in found], pa.int64()),
                }
            )


def _stars(batches: Batches, percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b): every set of a node, and the smallest set id that it reaches by links inside the node."""
    for run in key_runs(batches, "pair"):
        sides = dict(zip(run.column("set_id").to_pylist(), run.column("shingles").to_pylist()))
        ids = sorted(sides)
        parent = list(range(len(ids)))

        def root(i: int, parent: list[int] = parent) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for p, q in linked_pairs([np.frombuffer(sides[one], U64) for one in ids], None, percent):
            p, q = root(p), root(q)
            parent[max(p, q)] = min(p, q)
        yield pa.record_batch({"a": pa.array(ids, pa.int64()), "b": pa.array([ids[root(i)] for i in range(len(ids))], pa.int64())})


def _nodes(shared: DataFrame, sets: DataFrame) -> DataFrame:
    """(set_id, home, node): where each set with partners is kept."""
    homes = _homes(shared).join(
        sets.select(F.col("set_id").alias("s"), "n_shingles"), F.expr("set_id <=> s")
    )
    cuts = F.greatest(F.count(F.lit(1)) / _NODE_SETS, F.sum("n_shingles") / _NODE_SHINGLES)
    sizes = homes.groupBy("home").agg(F.ceil(cuts).alias("cuts"))
    node = F.xxhash64("home", F.pmod(F.xxhash64("set_id"), F.col("cuts")))
    nodes = homes.join(sizes.withColumnRenamed("home", "h"), F.col("home").eqNullSafe(F.col("h")))
    return nodes.select("set_id", "home", node.alias("node"))


def _needed(shingles: DataFrame, partners: DataFrame) -> DataFrame:
    """``shingles`` of the sets in ``partners`` (set_id, ...) and of a few more, so that the others are not shuffled."""
    bits = shingles.sparkSession.sparkContext.broadcast(slot_bits(partners.select(slot_of("set_id").alias("slot"))))

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = has_bit(bits.value, batch.column("slot").to_numpy())
            yield batch.select(["s", "shingles"]).filter(pa.array(hit))

    return in_arrow(shingles.withColumn("slot", slot_of("s")), run, "s long, shingles binary")


def _linked(partners: DataFrame, shingles: DataFrame, find: Callable) -> DataFrame:
    """(a, b): what ``find`` makes of the sets of each ``pair`` in ``partners`` (set_id, pair, ...)."""
    # Neither side's size is known beforehand: the same join at every size.
    rows = partners.join(shingles.hint("merge"), F.col("set_id").eqNullSafe(F.col("s"))).drop("s")
    return in_arrow(rows.repartition("pair").sortWithinPartitions("pair"), find, "a long, b long")


def _contracted(nodes: DataFrame, shingles: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links inside nodes and between their representatives; (set_id, node, label) by these links.

    Sets with one label are known to be linked. Every round gathers one set of each
    label and home into nodes anew, so a group of near copies has one label after a number of
    rounds that grows with the logarithm of its size, and few sets are sent for it. Homes
    whose representatives have all met in one node are settled and not gathered again.
    """
    alone = nodes.select("set_id", F.col("node").alias("pair"))
    links = stored(_linked(alone, shingles, lambda batches: _stars(batches, percent)), "jaccard-stars")
    labels = nodes.join(links.select(F.col("a").alias("s"), F.col("b").alias("label")), F.expr("set_id <=> s")).drop("s")
    labels = stored(labels, "jaccard-labels")
    spread = nodes.groupBy("home").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    unsettled = spread.where("low < high").select(F.col("home").alias("u"))
    for step in range(_ROUNDS):
        left = labels.join(unsettled, F.expr("home <=> u"), "left_semi").select("home", "label").distinct()
        several = left.groupBy("home").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        several = stored(several.select(F.col("home").alias("h"), F.ceil(F.col("n") / _NODE_SETS).alias("cuts")), "jaccard-homes")
        most = several.agg(F.max("cuts")).first()[0]
        if most is None:
            break
        place = F.pmod(F.xxhash64("label", F.lit(step)), F.col("cuts"))
        met = left.join(several, F.expr("home <=> h")).select(F.col("label").alias("set_id"), F.xxhash64("home", place, F.lit(step)).alias("pair"))
        met = stored(met, "jaccard-met")
        found = stored(_linked(met, _needed(shingles, met), lambda batches: _stars(batches, percent)).where("a <> b"), "jaccard-stars")
        links = links.union(found)
        labels = labels.join(found.select(F.col("a").alias("s"), F.col("b").alias("next")), F.expr("label <=> s"), "left")
        labels = stored(labels.select("set_id", "home", "node", F.coalesce("next", "label").alias("label")), "jaccard-labels")
        if most == 1:
            break  # all representatives of a home have met
        unsettled = several.where("cuts > 1").select(F.col("h").alias("u"))
    return links, labels


def _crossing(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(set_id, pair, other): for pairs of nodes, the sets of either that may link with one of another label in the other.

    Two sets that link share as many keys of one class as either needs there, see
    ``block_keys``; so each of them shares as many with the node of the other.
    """
    places = labels.select(F.col("set_id").alias("s"), "node", "label")
    keyed = (
        shared.join(places, F.col("set_id").eqNullSafe(F.col("s")))
        .selectExpr(
            "key",
            "set_id",
            "class_need",
            "node",
            "label",
            "min(node) OVER (PARTITION BY key) < max(node) OVER (PARTITION BY key) AS apart",
            "min(label) OVER (PARTITION BY key) < max(label) OVER (PARTITION BY key) AS unlike",
        )
        # A key all of whose sets have one and the same node or label asks for nothing.
        .where("apart AND unlike")
        .drop("apart", "unlike")
    )
    keyed = stored(keyed, "jaccard-keyed")
    others = keyed.groupBy(F.col("key").alias("k"), F.col("node").alias("m")).agg(F.min("label").alias("low"), F.max("label").alias("high"))
    across = keyed.join(others, F.expr("key <=> k AND node <> m AND NOT (low = high AND low = label)"))
    enough = (
        across.groupBy("set_id", "class_need", "node", "m")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= F.pmod("class_need", F.lit(_CLASS)))
    )
    pair = F.xxhash64(F.least("node", "m"), F.greatest("node", "m"))
    sides = enough.select("set_id", pair.alias("pair"), (F.col("node") > F.col("m")).cast("int").alias("other"))
    return stored(sides.distinct(), "jaccard-pairs")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    Rows link when the Jaccard of their shingle sets of ``width`` words is at
    least ``percent`` %; component_id is the smallest doc_id reachable by links.
    """
    counts = stored(shingle_counts(docs, width), "jaccard-counts")
    sets = counts.where("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles")
    )
    shared = stored(_shared_keys(_keys(docs, width, percent)), "jaccard-shared")
    nodes = stored(_nodes(shared, sets), "jaccard-nodes")
    wanted = sets.join(nodes.select("set_id"), "set_id", "left_semi")
    shingles = stored(_shingles_of(docs, wanted, width).withColumnRenamed("set_id", "s"), "jaccard-shingles")
    inside, labels = _contracted(nodes, shingles, percent)
    pairs = _crossing(shared, labels)
    between = _linked(pairs, _needed(shingles, pairs), lambda batches: _links(batches, percent))
    reached = components(inside.union(between), "a", "b", "jaccard-links")
    named = (
        reached.join(sets, F.col("id").eqNullSafe(F.col("set_id")))
        .groupBy("component")
        .agg(F.min("doc_id").alias("component_id"))
    )
    reached = reached.join(named, "component").select("id", "component_id")
    firsts = sets.join(reached, F.col("set_id").eqNullSafe(F.col("id")), "left").select(
        F.col("set_id").alias("s"), F.coalesce("component_id", "doc_id").alias("reached_id")
    )
    return counts.join(firsts, F.expr("set_id <=> s AND n_shingles > 0"), "left").select(
        "doc_id", "n_shingles", F.coalesce("reached_id", "doc_id").alias("component_id")
    )
