"""Phrase collocations, mined from stripes.

A stripe is an associative counter of next words, under the words before them: the
empty prefix has the counts of all words, a prefix of one word those of its pairs, a
prefix of two words those of its triples. Every task counts megabytes of text at a
time into stripes (so a pair that makes up a third of the corpus leaves a task as one
entry), and stripes of one prefix are merged elementwise after one shuffle. Everything
else is read off the merged stripes: extensions are their entries, prefix totals are
the entries of the stripe one word shorter, and the greatest entry of a stripe, and
of all stripes that a pair ends, is what decides whether a pair is subsumed.

The texts are read once for each length of prefix. A phrase can only be frequent if what
it begins and ends with is, so a pass counts only what extends frequent entries of the
pass before. These are known by a filter of ``2 ** SLOT_BITS`` bits, 1 MB whatever the
input; when it is full it lets everything through, and more is counted than needed.

Hot prefixes. The empty prefix, and prefixes made only of words that are at least one
in ``HOT_SHARE`` of all words, of which there are at most ``HOT_SHARE``, are split into
segments by the hash of the next word, so that neither their merging nor their size
lies with one task. Merging holds the distinct next words of one segment.

Texts are lower-cased in A-Z, cut into pieces at ``.,;:!?`` and LF to CR, and pieces
into words at spaces and tabs. A long text is counted in parts that end with a piece;
a piece longer than a part is cut between words, and the next part starts with the
last two words again, which are not counted twice.

Scores are exact: products are decimals of 38 digits, good for phrases that occur up
to 10^16 times, and the division is one of whole numbers.

Edge cases: a null text is an empty one, a null language is ``und``. Rows that repeat
count as often as they are there. Extra columns are ignored, whatever their names. An
empty table, or one without a frequent phrase, gives an empty result. Equal scores are
ordered by the phrase's count, then by the bytes of the phrase, so ranks are unique.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritable.llm.common import SLOT_BITS, Batches, has_bit, in_arrow, slot_bits
from veritable.llm.words import mix, slices
from veritable.sources.scratch import stored

UNKNOWN = "und"
HOT_SHARE = 1024
_PART_BYTES = 2 << 20
_MERGED_ENTRIES = 1 << 18
_ROWS_AT_ONCE = 1 << 16
#: Segments of a hot prefix of no, one and two words.
_SEGMENTS = (256, 64, 16)
#: The best of a language are found in this many parts of it first.
_SALTS = 256

# What ends a piece, and what separates words within it.
BREAKS = b".,;:!?\n\v\f\r"
GAPS = b" \t"

_KEYS = ("lang", "prefix", "segment")
_STRIPES = "lang string, prefix string, segment int, next array<string>, n array<int>"
_WIDE = pa.schema(
    {"lang": pa.string(), "prefix": pa.string(), "segment": pa.int32(), "next": pa.list_(pa.string()), "n": pa.list_(pa.int64())}
)

_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
_APART = _BREAK.copy()
_APART[list(GAPS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _parts(text: bytes, most: int) -> Iterator[tuple[bytes, int]]:
    """The text in parts of about ``most`` bytes, each with the number of first words counted before."""
    low, skip, width = 0, 0, most
    while len(text) - low > width:
        cut = max(text.rfind(bytes([byte]), low + 1, low + width) for byte in BREAKS)
        if cut > low:
            yield text[low:cut], skip
            low, skip, width = cut, 0, most
            continue
        gap = min((at for byte in BREAKS + GAPS if (at := text.find(bytes([byte]), low + width)) >= 0), default=-1)
        if gap < 0:
            break
        solid = ~_APART[np.frombuffer(text, np.uint8, gap - low, low)]
        starts = np.flatnonzero(np.diff(solid, prepend=False).astype(bool) & solid)
        if len(starts) < 3:
            width *= 2
            continue
        yield text[low:gap], skip
        low, skip, width = low + int(starts[-2]), 2, most
    yield text[low:], skip


def _texts(batches: Batches, most: int) -> Iterator[tuple[str, bytes, int]]:
    """(language, text, words counted before); texts of a language are joined up to ``most`` bytes."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in (part for whole in batches for part in slices(whole, "text", most)):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            raw = text.encode()
            if len(raw) > most:
                for part, skip in _parts(raw, most):
                    yield lang, part, skip
                continue
            held.setdefault(lang, []).append(raw)
            size += len(raw)
            if size >= most:
                yield from ((name, b"\n".join(texts), 0) for name, texts in held.items())
                held, size = {}, 0
    yield from ((name, b"\n".join(texts), 0) for name, texts in held.items())


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Per word its number and that of its piece; and the words by number."""
    raw = np.frombuffer(text, np.uint8)
    solid = ~_APART[raw]
    edges = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.string())
    piece = np.searchsorted(np.flatnonzero(_BREAK[raw]), start)
    offsets = np.concatenate(([0], np.cumsum(end - start)))
    letters = _LOWER[raw[solid]]
    words = pa.Array.from_buffers(
        pa.large_string(), len(start), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(letters.tobytes())]
    ).dictionary_encode()
    return words.indices.to_numpy().astype(np.int64), piece, words.dictionary.cast(pa.string())


def _runs(*values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    new = np.zeros(len(values[0]), bool)
    new[:1] = True
    for value in values:
        new[1:] |= value[1:] != value[:-1]
    return np.append(np.flatnonzero(new), len(new))


def _codes(words: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(word.as_buffer()) for word in words), np.uint64, len(words))


def _slots(*codes: np.ndarray) -> np.ndarray:
    """A number below 2 ** SLOT_BITS for each run of words, from their codes."""
    value = np.zeros(len(codes[0]), np.uint64)
    for code in codes:
        value = mix(value + code)
    return (value & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def _stripes(lang: str, text: bytes, skip: int, depth: int, hot: list[str], bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Stripes of one text with prefixes of ``depth`` words.

    What ends before word ``skip`` has been counted before. ``bits`` tell the frequent
    phrases of ``depth`` words.
    """
    ids, piece, names = _words(text)
    if len(ids) <= skip:
        return
    size = len(names)
    code = _codes(names)
    is_hot = pc.is_in(names, value_set=pa.array(hot, pa.string())).to_numpy(zero_copy_only=False)
    at = np.arange(skip, len(ids))
    if depth:
        at = np.flatnonzero(piece[depth:] == piece[:-depth])
        at = at[at + depth >= skip]
        if bits is not None:
            first = [code[ids[at + k]] for k in range(depth + 1)]
            at = at[has_bit(bits, _slots(*first[:-1])) & has_bit(bits, _slots(*first[1:]))]
    if depth == 2:
        pair, prefix = np.unique(ids[at] * size + ids[at + 1], return_inverse=True)
        one, two = pair // size, pair % size
        words = pc.binary_join_element_wise(names.take(pa.array(one)), names.take(pa.array(two)), " ")
        split = is_hot[one] & is_hot[two]
    elif depth == 1:
        prefix, words, split = ids[at], names, is_hot
    else:
        prefix, words, split = np.zeros(len(at), np.int64), pa.array([""]), np.ones(1, bool)
    entry, n = np.unique(prefix * size + ids[at + depth], return_counts=True)
    prefix, following = entry // size, entry % size
    segment = (code[following] % np.where(split, _SEGMENTS[depth], 1).astype(np.uint64)[prefix]).astype(np.int32)
    order = np.lexsort((segment, prefix))
    prefix, following, n, segment = prefix[order], following[order], n[order], segment[order]
    cuts = _runs(prefix, segment)
    for low in range(0, len(cuts) - 1, _ROWS_AT_ONCE):
        part = cuts[low : low + _ROWS_AT_ONCE + 1]
        inside = slice(part[0], part[-1])
        offsets = pa.array(part - part[0], pa.int32())
        yield pa.record_batch(
            {
                "lang": pa.array([lang] * (len(part) - 1), pa.string()),
                "prefix": words.take(pa.array(prefix[part[:-1]])),
                "segment": pa.array(segment[part[:-1]], pa.int32()),
                "next": pa.ListArray.from_arrays(offsets, names.take(pa.array(following[inside]))),
                "n": pa.ListArray.from_arrays(offsets, pa.array(n[inside], pa.int32())),
            }
        )


def _merged(rows: list[pa.RecordBatch]) -> tuple[pa.Table, pa.Table]:
    """Keys of adjacent rows, each once, and their counters added up: (run, next, n)."""
    table = pa.concat_tables([pa.Table.from_batches([batch]).cast(_WIDE) for batch in rows]).combine_chunks()
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in _KEYS:
        column = table.column(key)
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, max(0, len(column) - 1))).to_numpy()
    run = np.cumsum(new) - 1
    lists = table.column("next").combine_chunks()
    owner = pc.list_parent_indices(lists).to_numpy()
    entries = pa.table(
        {"run": run[owner], "next": pc.list_flatten(lists), "n": pc.list_flatten(table.column("n").combine_chunks())}
    )
    entries = entries.group_by(["run", "next"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["run", "next", "n"])
    return table.select(list(_KEYS)).filter(pa.array(new)), entries


def _counted(texts: DataFrame, depth: int, least: int, hot: dict[str, list[str]], bits: np.ndarray | None) -> DataFrame:
    """(lang, prefix, next, n): entries with ``n >= least`` of the merged stripes of one length of prefix.

    For the empty prefix, rows without a next word add up to the number of all words.
    """

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        for lang, text, skip in _texts(batches, _PART_BYTES):
            yield from _stripes(lang, text, skip, depth, hot.get(lang, []), bits)

    def merge(batches: Batches) -> Iterator[pa.RecordBatch]:
        rows: list[pa.RecordBatch] = []
        entries, full = 0, _MERGED_ENTRIES
        for batch in batches:
            if not batch.num_rows:
                continue
            rows.append(batch)
            entries += len(batch.column("next").flatten())
            if entries < full:
                continue
            keys, counters = _merged(rows)
            last = keys.num_rows - 1
            yield kept(keys, counters.filter(pc.less(counters.column("run"), last)))
            # The last key may go on in the next batch: its counter stays, merged so far.
            own = counters.filter(pc.equal(counters.column("run"), last))
            offsets = pa.array([0, own.num_rows], pa.int32())
            held = {key: keys.column(key).combine_chunks()[last:] for key in _KEYS}
            for name in ("next", "n"):
                held[name] = pa.ListArray.from_arrays(offsets, own.column(name).combine_chunks())
            rows, entries = [pa.record_batch(held)], own.num_rows
            full = max(_MERGED_ENTRIES, 2 * entries)
        if rows:
            yield kept(*_merged(rows))

    def kept(keys: pa.Table, counters: pa.Table) -> pa.RecordBatch:
        frequent = counters.filter(pc.greater_equal(counters.column("n"), least))
        runs, following, n = (frequent.column(name).combine_chunks() for name in ("run", "next", "n"))
        if not depth:
            totals = counters.group_by(["run"], use_threads=False).aggregate([("n", "sum")])
            runs = pa.concat_arrays([runs, totals.column("run").combine_chunks()])
            following = pa.concat_arrays([following, pa.nulls(totals.num_rows, pa.string())])
            n = pa.concat_arrays([n, totals.column("n_sum").combine_chunks()])
        made = {name: keys.column(name).combine_chunks().take(runs) for name in ("lang", "prefix")}
        return pa.record_batch(made | {"next": following, "n": n})

    dealt = in_arrow(texts, count, _STRIPES).repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    return in_arrow(dealt, merge, "lang string, prefix string, next string, n long")


def _frequent_bits(phrases: DataFrame) -> np.ndarray:
    """The filter that tells ``phrases`` (one column, words separated by spaces)."""

    def slots(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pc.split_pattern(batch.column(0), " ")
            width = len(words[0]) if len(words) else 1
            codes = _codes(words.flatten()).reshape(-1, width)
            yield pa.record_batch({"slot": _slots(*codes.T)})

    return slot_bits(in_arrow(phrases, slots, "slot long"))


def _score(a: str, left: str, right: str) -> Column:
    exact = "CAST({} AS DECIMAL(16, 0))".format
    return F.expr(f"1000000BD * {exact(a)} * {exact(a)} div ({exact(left)} * {exact(right)})")


def collocations(docs: DataFrame, least: int = 10, subsumed_percent: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of ``docs`` (lang, text) in each language.

    ``least`` is the count a phrase needs, ``subsumed_percent`` the share of a phrase's
    count that a longer one needs to take its place, ``top`` the ranks reported.
    """
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    single = stored(_counted(texts, 0, least, {}, None), "stripes")
    totals = single.where("next IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    words = single.where("next IS NOT NULL").select("lang", F.col("next").alias("word"), F.col("n").alias("f"))
    every = totals.agg(F.sum("n")).first()[0] or 0
    hot: dict[str, list[str]] = {}
    for row in words.where(F.col("f") * HOT_SHARE >= every).collect():
        hot.setdefault(row["lang"], []).append(row["word"])
    entries = stored(_counted(texts, 1, least, hot, _frequent_bits(words.select("word"))), "stripes")
    bits = _frequent_bits(entries.select(F.concat_ws(" ", "prefix", "next")))
    pairs = entries.selectExpr("lang", "prefix AS w", "next AS x", "n AS a")
    pairs = (
        pairs.join(words.selectExpr("lang", "word AS w", "f AS l"), ["lang", "w"])
        .join(words.selectExpr("lang", "word AS x", "f AS r"), ["lang", "x"])
        .selectExpr("lang", "concat(w, ' ', x) AS phrase", "a", "l", "r")
    )
    pairs = stored(pairs, "pairs")
    triples = stored(_counted(texts, 2, least, hot, bits), "stripes").selectExpr(
        "lang", "prefix AS head", "concat(substring_index(prefix, ' ', -1), ' ', next) AS rest", "n AS a",
        "concat(prefix, ' ', next) AS phrase",
    )
    # A pair is subsumed through the greatest entry of its own stripe, and of those that end with it.
    longer = triples.selectExpr("lang", "inline(array(struct(head AS phrase, a), struct(rest AS phrase, a)))")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    own = pairs.join(longer, ["lang", "phrase"], "left").where(
        F.expr(f"longer IS NULL OR CAST(longer AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * {subsumed_percent}")
    )
    own = own.select("lang", "phrase", "a", "l", "r", _score("a", "l", "r").alias("score"))
    cut = (
        triples.join(pairs.selectExpr("lang", "phrase AS head", "l AS first", "a AS head_n"), ["lang", "head"])
        .join(pairs.selectExpr("lang", "phrase AS rest", "r AS last", "a AS rest_n"), ["lang", "rest"])
        .withColumn("early", _score("a", "first", "rest_n"))
        .withColumn("late", _score("a", "head_n", "last"))
        .selectExpr(
            "lang", "phrase", "a",
            "CASE WHEN early <= late THEN first ELSE head_n END AS l",
            "CASE WHEN early <= late THEN rest_n ELSE last END AS r",
            "least(early, late) AS score",
        )
    )
    best = "ORDER BY score DESC, a DESC, phrase"
    found = own.unionByName(cut).withColumn("salt", F.expr(f"pmod(xxhash64(phrase), {_SALTS})"))
    # Ranks within parts first: then no language is sorted whole in one task.
    found = found.withColumn("place", F.expr(f"row_number() OVER (PARTITION BY lang, salt {best})")).where(F.col("place") <= top)
    ranked = found.withColumn("rank", F.expr(f"CAST(row_number() OVER (PARTITION BY lang {best}) AS BIGINT)"))
    ranked = ranked.where(F.col("rank") <= top).join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
