"""Passages that repeat across documents, exactly or nearly, by collinear chaining.

1. Seeds. Of every ``_WINDOW`` consecutive k-mers of ``_SEED`` words the one with
   the smallest hash is a seed, so that any two texts that agree in
   ``_SEED + _WINDOW - 1`` words in a row share one.
2. Join. Every occurrence of a seed is matched with its first one (smallest doc_id,
   then position): as many matches as occurrences, however often a seed occurs. The
   first ones are aggregated map-side and joined back, so a hot seed can be split.
   Where neighbouring seeds of a document lead to different documents, its passage may
   stand whole in a further one, whose own seeds lead astray alike. Such a seam is
   looked up by the ordered pair of seeds around it, up to ``_SEAM`` apart, and matched
   with the first document that has the same seam: again one match per occurrence.
3. Chains. The matches of two documents, merged along diagonals, are chained in
   ascending order of both positions. A gap costs ``_GAP_COST`` a word on either
   side; a Fenwick tree over the second position holds the best chain that can be
   continued. Chains are cut where a gap exceeds ``_LARGEST_GAP`` words.
4. Alignment. Only words of documents with chains are fetched. Gaps are filled by a
   longest common subsequence, both ends are extended while they agree well enough;
   the similarity is the share of matched words on the longer side. A chain that
   falls short is split where most words are unmatched, down to its exact runs.
5. The rest. A run of ``least_words`` that a document shares with one that is not the
   first for its seeds may be left in pieces, as its seeds lead elsewhere. In every
   document that has it all its seeds are matched, so it lies in stretches of matches
   at most ``_WINDOW - _SEED`` words apart, and up to ``_WINDOW - 1`` words around
   them. Windows of ``least_words`` there that no passage holds yet are looked up, by
   hash, among all windows there: each is matched with the first document that has it.
6. An alignment counts if it has ``least_words`` words by itself. Those of one document
   that overlap, whatever they were matched with, are reported as one. The document
   with the smallest id keeps its passage and is not reported.

Words are compared in lower case. Edge cases: null, empty and short texts have no
seeds; rows with a null id are not compared; rows with one id count as one document,
so repeats inside a document are not reported. Of documents that have a passage alike
the one with the smallest id is its source. Texts are read whole; an empty table has no
passages. Extra columns are kept by ``cut_passages`` and ignored otherwise, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.llm.common import Batches, fresh_name, has_bit, in_arrow, key_runs, slot_bits, slot_of, split_by
from veritable.llm.words import _ODD, U64, mix, slices, windows, words_of
from veritable.sources.scratch import stored

_SEED = 8
_WINDOW = 16
_GAP_COST = 0.5
_LARGEST_GAP = 40
_LEAST_CHAIN = _SEED  # words matched by seeds
_REACH = 64  # words looked at beyond either end
_OVERLAP = 8  # words two passages share that count as one
_SEAM, _SEAM_WORDS = 3, 48  # seeds apart, and words apart


def seeds_of(hashes: np.ndarray, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Positions in ``hashes`` of the smallest one of each window inside one text."""
    n = len(hashes) - _WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    inside = np.flatnonzero(owner[at[:n]] == owner[at[_WINDOW - 1 :]])
    # Doubling: minima of 2, 4, 8 and 16 hashes, with the position in the low bits lost ones break ties by.
    best = np.arange(len(hashes))
    span = 1
    while span < _WINDOW:
        left, right = best[: len(best) - span], best[span:]
        best = np.where(hashes[right] < hashes[left], right, left)
        span *= 2
    return np.unique(best[inside])


def _seeds(docs: DataFrame) -> DataFrame:
    """(seed, doc_id, at): where each document has which seed."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words = words_of(piece.column("text"))
                owner = words.owner
                value, at = windows(words, _SEED)
                value = mix(value ^ U64(_SEED))
                found = seeds_of(value, at, owner)
                first = at[found]
                yield pa.record_batch(
                    {
                        "seed": value[found].astype(np.int64),
                        "doc_id": piece.column("doc_id").take(pa.array(owner[first])),
                        "at": (first - words.first[owner[first]]).astype(np.int32),
                    }
                )

    return in_arrow(docs, run, "seed long, doc_id long, at int")


def _matches(seeds: DataFrame) -> DataFrame:
    """(doc_id, source_id, x, y): every occurrence of a seed with its first one, those in one
    document included, and of a seam with its first one."""
    firsts = (
        seeds.groupBy("seed")
        .agg(F.min(F.struct("doc_id", "at")).alias("least"), F.max("doc_id").alias("last"))
        .where("last > least.doc_id")
        .select(F.col("seed").alias("s"), F.col("least.doc_id").alias("source_id"), F.col("least.at").alias("y"))
    )
    met = stored(
        seeds.join(firsts, F.expr("seed <=> s AND doc_id >= source_id")).select("seed", "doc_id", "source_id", F.col("at").alias("x"), "y"),
        "passage-matches",
    )
    return met.drop("seed").union(_seams(met))


def _seams(met: DataFrame) -> DataFrame:
    """(doc_id, source_id, x, y): both seeds of every seam, matched with the first document that has it."""
    following = [
        f"struct(lead(seed, {n}) OVER here AS seed, lead(x, {n}) OVER here AS x, lead(source_id, {n}) OVER here AS source_id)"
        for n in range(1, _SEAM + 1)
    ]
    met = met.selectExpr("seed", "doc_id", "source_id", "x", f"array({', '.join(following)}) AS following".replace(
        "OVER here", "OVER (PARTITION BY doc_id ORDER BY x, seed)"
    ))
    seams = met.selectExpr("seed AS one", "doc_id", "source_id AS source_one", "x AS x_one", "inline(following) AS (two, x_two, source_two)")
    seams = seams.where(F.expr(f"source_one <> source_two AND x_two - x_one <= {_SEAM_WORDS}"))
    seams = stored(seams.select("one", "two", "doc_id", "x_one", "x_two"), "passage-seams")
    firsts = (
        seams.groupBy("one", "two")
        .agg(F.min(F.struct("doc_id", "x_one", "x_two")).alias("least"), F.max("doc_id").alias("last"))
        .where("last > least.doc_id")
        .selectExpr("one AS o", "two AS t", "least.doc_id AS source_id", "least.x_one AS y_one", "least.x_two AS y_two")
    )
    again = seams.join(firsts, F.expr("one <=> o AND two <=> t AND doc_id > source_id"))
    return again.selectExpr("doc_id", "source_id", "inline(array(struct(x_one AS x, y_one AS y), struct(x_two AS x, y_two AS y)))").distinct()


class Fenwick:
    """Prefix maxima over positions 0 .. size - 1, each with who holds it."""

    def __init__(self, size: int) -> None:
        self.best = [(-np.inf, -1)] * (size + 1)

    def put(self, position: int, value: float, who: int) -> None:
        position += 1
        while position < len(self.best):
            if value > self.best[position][0]:
                self.best[position] = (value, who)
            position += position & -position

    def upto(self, position: int) -> tuple[float, int]:
        """The largest value at positions below ``position``."""
        found = (-np.inf, -1)
        while position > 0:
            if self.best[position][0] > found[0]:
                found = self.best[position]
            position -= position & -position
        return found


def segments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Matches merged along diagonals: rows (x, y, words), each an exact run of words."""
    order = np.lexsort((x, x - y))
    x, y = x[order].astype(np.int64), y[order].astype(np.int64)
    # Seeds that overlap or touch on one diagonal cover an exact run.
    new = np.concatenate(([True], (np.diff(x - y) != 0) | (np.diff(x) > _SEED)))
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(x)) - 1
    return np.stack((x[begin], y[begin], x[end] - x[begin] + _SEED), axis=1)


def chains(parts: np.ndarray) -> list[list[int]]:
    """Disjoint chains of segments, best first; a chain lists segments in order."""
    if len(parts) == 1:
        return [[0]]
    x, y, size = parts.T
    ends = np.unique(y + size)
    after = np.searchsorted(ends, y, "right").tolist()  # ends up to y may precede
    rank = np.searchsorted(ends, y + size).tolist()
    by_start, by_end = np.argsort(x, kind="stable").tolist(), np.argsort(x + size, kind="stable").tolist()
    x, y, size = x.tolist(), y.tolist(), size.tolist()
    tree = Fenwick(len(ends))
    score, before = [0.0] * len(x), [-1] * len(x)
    done = 0
    for i in by_start:
        while done < len(by_end) and x[by_end[done]] + size[by_end[done]] <= x[i]:
            j = by_end[done]
            tree.put(rank[j], score[j] + _GAP_COST * (x[j] + size[j] + y[j] + size[j]), j)
            done += 1
        value, j = tree.upto(after[i])
        value -= _GAP_COST * (x[i] + y[i])
        score[i] = size[i] + max(0.0, value)
        before[i] = j if value > 0 else -1
    used = [False] * len(x)
    found = []
    for i in sorted(range(len(x)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            found.append(chain[::-1])
    return found


def _pairs(batches: Batches) -> Iterator[pa.Table]:
    """Matches of one pair of documents after the other."""
    for own in key_runs(batches, "doc_id"):
        source = own.column("source_id").to_numpy()
        cuts = [0, *(np.flatnonzero(source[1:] != source[:-1]) + 1).tolist(), len(source)]
        for low, high in zip(cuts, cuts[1:]):
            yield own.slice(low, high - low)


def _chained(batches: Batches) -> Iterator[pa.RecordBatch]:
    """(doc_id, source_id, x0, x1, y0, y1, parts) of every chain; of a document with itself, where it has seeds, without parts."""
    rows: list[tuple] = []
    for run in _pairs(batches):
        doc, source = run.column("doc_id")[0].as_py(), run.column("source_id")[0].as_py()
        if doc == source:
            at = np.unique(run.column("x").to_numpy())
            for near in np.split(at, np.flatnonzero(np.diff(at) > _WINDOW) + 1):
                rows.append((doc, doc, near[0], near[-1] + _SEED, near[0], near[-1] + _SEED, b""))
            continue
        parts = segments(run.column("x").to_numpy(), run.column("y").to_numpy())
        for chain in chains(parts):
            own = parts[chain]
            gaps = np.maximum(own[1:, 0] - own[:-1, 0] - own[:-1, 2], own[1:, 1] - own[:-1, 1] - own[:-1, 2])
            for piece in np.split(own, np.flatnonzero(gaps > _LARGEST_GAP) + 1):
                if piece[:, 2].sum() >= _LEAST_CHAIN:
                    (x0, y0, _), (x1, y1, size) = piece[0], piece[-1]
                    rows.append((doc, source, x0, x1 + size, y0, y1 + size, piece.astype(np.int32).tobytes()))
        if len(rows) >= 4096:
            yield _chain_batch(rows)
            rows = []
    if rows:
        yield _chain_batch(rows)


def _chain_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ("doc_id", "source_id", "x0", "x1", "y0", "y1", "parts")
    kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([int(v) if i < 6 else v for v in column], kind) for i, (column, kind) in enumerate(zip(zip(*rows), kinds))], names)


def _words_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, words) of the documents in ``ids`` and a few more: 4-byte hashes of all words.

    A filter of 1 MB, whatever the input, keeps the other texts from being shuffled.
    """
    bits = docs.sparkSession.sparkContext.broadcast(slot_bits(ids.select(slot_of("id").alias("slot"))))

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = has_bit(bits.value, batch.column("slot").to_numpy())
            for piece in slices(batch.filter(pa.array(hit)), "text"):
                words = words_of(piece.column("text"))
                packed = (words.hash >> U64(32)).astype(np.uint32)
                yield pa.record_batch(
                    {
                        "id": piece.column("doc_id"),
                        "words": pa.array([packed[a:b].tobytes() for a, b in zip(words.first, words.first[1:])], pa.binary()),
                    }
                )

    return in_arrow(docs.withColumn("slot", slot_of("doc_id")), run, "id long, words binary")


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence; gaps are short, see ``_LARGEST_GAP``."""
    if not len(a) or not len(b):
        return 0
    row = np.zeros(len(b) + 1, np.int64)
    for word in a:
        step = row.copy()
        step[1:] = np.maximum(row[1:], np.where(b == word, row[:-1] + 1, 0))
        row = np.maximum.accumulate(step)
    return int(row[-1])


def extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How far two runs agree from their first word on: (words, matched).

    A match scores one, a mismatch costs two; where the score was highest it ends.
    """
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 1, -2))
    best = int(score.argmax())
    return (best + 1, int(same[: best + 1].sum())) if score[best] > 0 else (0, 0)


def exact(a: np.ndarray, b: np.ndarray) -> int:
    """Number of words two runs have in common before the first difference."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _ends(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Ways to go on from an end, (words, matched): as long as the runs agree well enough, or exactly."""
    return [extend(a, b), (same := exact(a, b), same)]


def alignments(parts: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> Iterator[tuple]:
    """(x0, x1, y0, y1, share) of a chain, or of its parts where the whole is less similar.

    What falls short is split where most words are unmatched, in the end into single
    exact runs, which always qualify: each segment is in one alignment.
    """
    x, y, size = parts.T
    x_end, y_end = x + size, y + size
    filled = np.array([common_words(a[x_end[i] : x[i + 1]], b[y_end[i] : y[i + 1]]) for i in range(len(parts) - 1)], np.int64)
    lost = np.maximum(x[1:] - x_end[:-1], y[1:] - y_end[:-1]) - filled
    matched = np.concatenate(([0], np.cumsum(size)))
    between = np.concatenate(([0], np.cumsum(filled)))
    todo = [(0, len(parts) - 1)]
    while todo:
        i, j = todo.pop()
        own = int(matched[j + 1] - matched[i] + between[j] - between[i])
        long = int(max(x_end[j] - x[i], y_end[j] - y[i]))
        lefts = _ends(a[max(0, x[i] - _REACH) : x[i]][::-1], b[max(0, y[i] - _REACH) : y[i]][::-1])
        rights = _ends(a[x_end[j] : x_end[j] + _REACH], b[y_end[j] : y_end[j] + _REACH])
        ways = sorted(((l + r, l, r, (own + m + n) / (long + l + r)) for l, m in lefts for r, n in rights), reverse=True)
        for _, left, right, share in ways:
            if share >= similarity:
                yield int(x[i]) - left, int(x_end[j]) + right, int(y[i]) - left, int(y_end[j]) + right, share
                break
        else:
            cut = i + int(lost[i:j].argmax())
            todo += [(i, cut), (cut + 1, j)]


def _words_at(column: pa.Array, first: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """``_REACH`` words of each list from ``first`` on, forwards or backwards, and which of them exist."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // 4
    flat = np.frombuffer(column.buffers()[2], np.uint8)
    flat = flat[: len(flat) // 4 * 4].view(np.uint32)
    at = first[:, None] + step * np.arange(_REACH)
    there = (at >= 0) & (at < np.diff(offsets)[:, None])
    return flat[np.where(there, at + offsets[:-1, None], 0)] if len(flat) else np.zeros(at.shape, np.uint32), there


def single_alignments(rows: pa.RecordBatch, similarity: float) -> list[pa.Array]:
    """What ``alignments`` makes of chains of one segment, for many of them at once."""
    parts = np.array([np.frombuffer(p, np.int32) for p in rows.column("parts").to_pylist()], np.int64)
    x, y, size = parts[:, 0], parts[:, 1], parts[:, 2]
    low, high = (rows.column(name).to_numpy().astype(np.int64) for name in ("a_from", "b_from"))
    reach = []  # per end: words and matched words of either way to go on, see _ends
    for step, a_first, b_first in ((-1, x - low - 1, y - high - 1), (1, x - low + size, y - high + size)):
        a, there = _words_at(rows.column("a"), a_first, step)
        b, b_there = _words_at(rows.column("b"), b_first, step)
        there &= b_there
        same = there & (a == b)
        score = np.where(there, np.cumsum(np.where(same, 1, -2), axis=1), np.iinfo(np.int64).min)
        best = score.argmax(axis=1)
        far = np.where(score[np.arange(len(best)), best] > 0, best + 1, 0)
        met = np.where(np.arange(_REACH) < far[:, None], same, False).sum(axis=1)
        alike = np.where(same.all(axis=1), _REACH, (~same).argmax(axis=1))
        reach.append(((far, met), (alike, alike)))
    chosen = np.full(len(x), -1, np.int64)
    left, right, share = (np.zeros(len(x)) for _ in range(3))
    for to_left, met_left in reach[0]:
        for to_right, met_right in reach[1]:
            own = (size + met_left + met_right) / (size + to_left + to_right)
            # The longest way; of equals the one that goes further to the left.
            key = np.where(own >= similarity, (to_left + to_right) * 1000 + to_left, -1)
            better = (key > chosen) | (key == chosen) & (own > share)
            for kept, new in ((chosen, key), (left, to_left), (right, to_right), (share, own)):
                kept[better] = new[better]
    ends = (x - left, x + size + right, y - left, y + size + right)
    return [*(pa.array(end.astype(np.int32)) for end in ends), pa.array(share)]


def _aligned(batches: Batches, similarity: float) -> Iterator[pa.RecordBatch]:
    names = ("doc_id", "source_id", "start_word", "end_word", "source_start", "source_end", "similarity")
    kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.float64())
    for whole in batches:
        alone = pc.equal(pc.binary_length(whole.column("parts")), 12)
        single = whole.filter(alone)
        if single.num_rows:
            yield pa.RecordBatch.from_arrays(
                [single.column("doc_id"), single.column("source_id"), *single_alignments(single, similarity)], names
            )
        rows = []
        for r in whole.filter(pc.invert(alone)).to_pylist():
            a, b = np.frombuffer(r["a"], np.uint32), np.frombuffer(r["b"], np.uint32)
            low, high = r["a_from"], r["b_from"]
            parts = np.frombuffer(r["parts"], np.int32).reshape(-1, 3).astype(np.int64) - (low, high, 0)
            for x0, x1, y0, y1, share in alignments(parts, a, b, similarity):
                rows.append((r["doc_id"], r["source_id"], x0 + low, x1 + low, y0 + high, y1 + high, share))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(map(float if k == pa.float64() else int, c)), k) for c, k in zip(zip(*rows), kinds)], names)


def _side(rows: DataFrame, words: DataFrame, key: str, low: str, high: str, name: str) -> DataFrame:
    """``rows`` with the words of ``key`` from ``_REACH`` before ``low`` to ``_REACH`` behind ``high``."""
    begin = F.greatest(F.col(low) - _REACH, F.lit(0))
    joined = rows.join(words, F.col(key).eqNullSafe(F.col("id")))
    return joined.withColumn(f"{name}_from", begin).withColumn(
        name, F.expr(f"substring(words, 4 * {name}_from + 1, 4 * ({high} + {_REACH} - {name}_from))")
    ).drop("id", "words")


def _alignments(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All alignments, see ``fuzzy_passages``; (doc_id, start_word, end_word) of seeds in the
    first document that has them; (id, words) of the documents that share a seed."""
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), F.lower(F.col("text").cast("string")).alias("text"))
    seeds = stored(_seeds(texts), "passage-seeds")
    dealt = _matches(seeds).repartition("doc_id", "source_id").sortWithinPartitions("doc_id", "source_id")
    found = in_arrow(dealt, _chained, "doc_id long, source_id long, x0 int, x1 int, y0 int, y1 int, parts binary")
    found = stored(found, "passage-chains")
    words = _words_of(texts, found.selectExpr("inline(array(struct(doc_id AS id), struct(source_id AS id)))"))
    # Rows that share an id would multiply the chains.
    words = stored(words.groupBy("id").agg(F.max_by("words", F.length("words")).alias("words")), "passage-words")
    own = found.where("doc_id = source_id").selectExpr("doc_id", "x0 AS start_word", "x1 AS end_word")
    both = _side(_side(found.where("doc_id > source_id"), words, "doc_id", "x0", "x1", "a"), words, "source_id", "y0", "y1", "b")
    both = both.select("doc_id", "source_id", "parts", "a", "a_from", "b", "b_from")
    schema = "doc_id long, source_id long, start_word int, end_word int, source_start int, source_end int, similarity double"
    return in_arrow(both, lambda batches: _aligned(batches, similarity), schema), own, words


def fuzzy_passages(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(doc_id, source_id, start_word, end_word, source_start, source_end, similarity) of all alignments.

    ``source_id`` is a document with a smaller id that has the passage as well.
    """
    return _alignments(docs, similarity)[0]


def run_hashes(packed: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words of one text, put together from runs of 1, 2, 4, ... words."""
    n = len(packed) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    own, span, done = mix(packed.astype(U64)), 1, 0
    value = np.zeros(n, U64)
    while True:
        if width & span:
            value = mix(value * _ODD + own[done : done + n])
            done += span
        if 2 * span > width:
            return value.view(np.int64)
        own = mix(own[: len(own) - span] * _ODD + own[span:])
        span *= 2


def _grouped(rows: DataFrame, apart: int, name: str) -> DataFrame:
    """``rows`` with a number ``name``, one for spans of a document that begin at most ``apart`` words behind the others' ends."""
    by_place = "PARTITION BY doc_id ORDER BY start_word, end_word"
    reached = f"max(end_word) OVER ({by_place} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    marked = rows.selectExpr("*", f"CASE WHEN start_word - {apart} <= {reached} THEN 0 ELSE 1 END AS new")
    return marked.selectExpr(
        "*", f"sum(new) OVER ({by_place} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {name}"
    ).drop("new")


def _islands(rows: DataFrame) -> DataFrame:
    """(doc_id, start_word, end_word, source_id, similarity): overlapping passages as one."""
    placed = _grouped(rows, -_OVERLAP, "island")
    return placed.groupBy("doc_id", "island").agg(
        F.min("start_word").alias("start_word"),
        F.max("end_word").alias("end_word"),
        F.min("source_id").alias("source_id"),
        F.min("similarity").alias("similarity"),
    ).drop("island")


def _shared_windows(aligned: DataFrame, counted: DataFrame, own: DataFrame, words: DataFrame, width: int) -> DataFrame:
    """(doc_id, source_id, start_word, end_word, similarity): windows that no passage holds, but an earlier document does."""
    around = _WINDOW - 1
    spans = aligned.select("doc_id", "start_word", "end_word").union(own).withColumn("passage", F.lit(False))
    passages = _islands(counted).select("doc_id", "start_word", "end_word", F.lit(True).alias("passage"))
    placed = _grouped(spans.union(passages), _WINDOW - _SEED, "stretch")
    stretches = placed.groupBy("doc_id", "stretch").agg(
        F.greatest(F.min("start_word") - around, F.lit(0)).alias("low"),
        (F.max("end_word") + around).alias("high"),
        F.collect_list(F.when(F.col("passage"), F.struct("start_word", "end_word"))).alias("known"),
    )
    stretches = stretches.where(F.col("high") - F.col("low") >= width)
    joined = stretches.join(words, F.col("doc_id").eqNullSafe(F.col("id")))
    texts = joined.select("doc_id", "low", "known", F.expr("substring(words, 4 * low + 1, 4 * (high - low))").alias("words"))

    def laid(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                value = run_hashes(np.frombuffer(r["words"], np.uint32), width)
                at = np.arange(len(value)) + r["low"]
                free = np.ones(len(value), bool)
                for k in r["known"]:
                    free &= (at < k["start_word"]) | (at + width > k["end_word"])
                rows.append((value, np.full(len(value), r["doc_id"], np.int64), at.astype(np.int32), free))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], ["hash", "doc_id", "at", "free"])

    windows = stored(in_arrow(texts, laid, "hash long, doc_id long, at int, free boolean"), "passage-windows")
    firsts = (
        windows.groupBy("hash")
        .agg(F.min("doc_id").alias("source_id"), F.max("doc_id").alias("last"), F.max("free").alias("asked"))
        .where("asked AND last > source_id")
        .select(F.col("hash").alias("h"), "source_id")
    )
    met = windows.where("free").join(firsts, F.expr("hash <=> h AND doc_id > source_id"))
    return met.select("doc_id", "source_id", F.col("at").alias("start_word"), (F.col("at") + width).alias("end_word"), F.lit(1.0).alias("similarity"))


def repeated_passages(docs: DataFrame, least_words: int = 51, similarity: float = 0.8) -> DataFrame:
    """(doc_id, start_word, end_word, n_words, source_id, similarity): what a document repeats.

    Words ``start_word`` up to ``end_word`` (from 0, the end not included) are also
    found in documents with smaller ids; ``source_id`` is the smallest of them,
    ``similarity`` the lowest of the alignments.
    """
    aligned, own, words = _alignments(docs, similarity)
    aligned = stored(aligned, "passage-alignments")
    rows = aligned.select("doc_id", "source_id", "start_word", "end_word", "similarity")
    # What counts has to be found with one document; pieces of several make no passage.
    counted = rows.where(F.col("end_word") - F.col("start_word") >= least_words)
    return (
        _islands(counted.union(_shared_windows(rows, counted, own, words, least_words)))
        .withColumn("n_words", F.col("end_word") - F.col("start_word"))
        .select("doc_id", "start_word", "end_word", "n_words", "source_id", "similarity")
    )


def cut_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` without the words of ``passages`` (doc_id, start_word, end_word); all else is kept as it is.

    A document that loses all its words keeps its row. Only documents that lose
    something are shuffled.
    """
    doubtful, clear = split_by(docs, "doc_id", passages.select("doc_id"))
    cut_id, cut_spans = fresh_name("cut_id"), fresh_name("cut_spans")
    spans = passages.groupBy(F.col("doc_id").alias(cut_id)).agg(F.collect_list(F.struct("start_word", "end_word")).alias(cut_spans))
    joined = doubtful.join(spans, F.col("doc_id").eqNullSafe(F.col(cut_id)), "left").drop(cut_id)
    names = docs.columns

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = batch.column(cut_spans).to_pylist()
            for i in [i for i, s in enumerate(spans) if s and texts[i]]:
                words = words_of(pa.array([texts[i]], pa.string()))
                raw, kept, at = texts[i].encode(), [], 0
                for low, high in sorted((s["start_word"], s["end_word"]) for s in spans[i]):
                    if low < len(words.start):
                        kept.append(raw[at : words.start[low]])
                        at = max(at, int(words.end[min(high, len(words.end)) - 1]))
                texts[i] = b"".join([*kept, raw[at:]]).decode()
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    cut = in_arrow(joined, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
    return clear.union(cut)
