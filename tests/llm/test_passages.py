"""Repeated passages: parts of the method, recall against all pairs, awkward tables."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import words
from tests.llm.test_operators import prose
from veritable.llm.passages import Fenwick, alignments, chains, cut_passages, repeated_passages, segments, single_alignments

TEXT = "doc_id long, text string"


def reported(spark, docs):
    return repeated_passages(spark.createDataFrame(docs, TEXT)).collect()


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(f"changed{rng.randint(0, 10**6)}" if rng.random() < share else word for word in text.split())


@pytest.mark.parametrize("share", [0.0, 0.06, 0.1])
@pytest.mark.parametrize("pieces", [False, True])
def test_fuzzy_recall(spark, share, pieces):
    """A passage of 90 words and its edited copy; its three pieces may each stand in an earlier document."""
    docs, wanted = [], set()
    for n in range(120):
        passage = prose(10_000 + n, 90).split()
        parts = [" ".join(passage[i : i + 30]) for i in (0, 30, 60)]
        if pieces:
            docs += [(10 * n + i, f"{prose(20_000 + 10 * n + i, 40)} {part} {prose(30_000 + 10 * n + i, 40)}") for i, part in enumerate(parts)]
        for i, changed in ((5, 0.0), (6, share)):
            docs.append((10 * n + i, f"{prose(40_000 + 10 * n + i, 40)} {edited(' '.join(passage), changed, n)} {prose(50_000 + 10 * n + i, 40)}"))
        wanted.add(10 * n + 6)
    found = {r["doc_id"] for r in reported(spark, docs)}
    assert not {d for d in found if d % 10 < 5}
    # All-pairs chaining needs 51 words at a similarity of 0.8, which random edits do not always
    # leave; where every tenth word is changed, so are many seams.
    least = {0.0: 1.0, 0.06: 0.9, 0.1: 0.65 if pieces else 0.8}[share]
    assert len(found & wanted) >= least * len(wanted)


def test_pieces_that_no_document_has_together_are_not_reported(spark):
    docs = []
    for n in range(30):
        text = prose(60_000 + n, 70).split()
        one, two = " ".join(text[:45]), " ".join(text[30:])  # 45 and 40 words, 15 of them in both
        docs += [(3 * n, f"{prose(61_000 + n, 30)} {one} {prose(62_000 + n, 30)}"), (3 * n + 1, f"{prose(63_000 + n, 30)} {two} {prose(64_000 + n, 30)}")]
        docs.append((3 * n + 2, f"{prose(65_000 + n, 30)} {' '.join(text)} {prose(66_000 + n, 30)}"))
    assert reported(spark, docs) == []


def exact_windows(docs, width=51):
    """(doc, first word) of every run of ``width`` words that a document with a smaller id has."""
    places = defaultdict(list)
    for d, text in docs:
        own = words(text)
        for i in range(len(own) - width + 1):
            places[tuple(own[i : i + width])].append((d, i))
    return [(d, i) for held in places.values() for d, i in held if min(held)[0] < d]


def test_no_exact_run_of_the_sample_is_missed(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    spans = defaultdict(list)
    for r in reported(spark, docs):
        spans[r["doc_id"]].append((r["start_word"], r["end_word"]))
    lowered = [(d, (t or "").lower()) for d, t in docs]
    missed = [(d, i) for d, i in exact_windows(lowered) if not any(a <= i and i + 51 <= b for a, b in spans[d])]
    assert not missed


def test_fenwick_holds_prefix_maxima():
    rng = random.Random(1)
    tree, values = Fenwick(40), [-np.inf] * 40
    for who in range(300):
        at, value = rng.randrange(40), rng.random()
        tree.put(at, value, who)
        values[at] = max(values[at], value)
        upto = rng.randrange(41)
        assert tree.upto(upto)[0] == max([-np.inf, *values[:upto]])


def test_chains_score_as_the_best_of_all_subsets():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = int(rng.integers(2, 8))
        parts = np.stack([rng.integers(0, 80, n), rng.integers(0, 80, n), rng.integers(8, 14, n)], axis=1)

        def score(chain, parts=parts):
            total = 0.0
            for k, i in enumerate(chain):
                x, y, size = parts[i]
                total += size
                if k:
                    px, py, ps = parts[chain[k - 1]]
                    if px + ps > x or py + ps > y:
                        return -np.inf
                    total -= 0.5 * (x - px - ps + y - py - ps)
            return total

        every = (sorted(c, key=lambda i: parts[i, 0]) for k in range(1, n + 1) for c in combinations(range(n), k))
        assert abs(max(score(c) for c in every) - max(score(c) for c in chains(parts))) < 1e-9
        assert sorted(i for c in chains(parts) for i in c) == list(range(n))


def test_segments_are_runs_on_diagonals():
    x, y = np.array([10, 4, 12, 40, 41, 7]), np.array([30, 24, 32, 60, 100, 90])
    assert sorted(map(tuple, segments(x, y).tolist())) == [(4, 24, 16), (7, 90, 8), (40, 60, 8), (41, 100, 8)]


def test_single_alignments_are_those_of_the_plain_way():
    rng = np.random.default_rng(4)
    rows = {"a": [], "b": [], "a_from": [], "b_from": [], "parts": []}
    expected = []
    for n in range(400):
        size = int(rng.integers(8, 30))
        left, right = int(rng.integers(0, 65)), int(rng.integers(0, 65))
        other_left, other_right = int(rng.integers(0, 65)), int(rng.integers(0, 65))
        kinds = [1, 2, 50][n % 3]
        core = rng.integers(0, 9, size)
        a = np.concatenate([rng.integers(0, kinds, left), core, rng.integers(0, kinds, right)]).astype(np.uint32)
        b = np.concatenate([rng.integers(0, kinds, other_left), core, rng.integers(0, kinds, other_right)]).astype(np.uint32)
        a_from, b_from = int(rng.integers(0, 100)), int(rng.integers(0, 100))
        part = np.array([[a_from + left, b_from + other_left, size]], np.int32)
        for name, value in (("a", a.tobytes()), ("b", b.tobytes()), ("a_from", a_from), ("b_from", b_from), ("parts", part.tobytes())):
            rows[name].append(value)
        (found,) = alignments(part.astype(np.int64) - (a_from, b_from, 0), a, b, 0.8)
        expected.append((found[0] + a_from, found[1] + a_from, found[2] + b_from, found[3] + b_from, found[4]))
    kinds = {"a": pa.binary(), "b": pa.binary(), "parts": pa.binary(), "a_from": pa.int32(), "b_from": pa.int32()}
    for cut in (0, 7):
        batch = pa.record_batch({name: pa.array(values, kinds[name]) for name, values in rows.items()}).slice(cut)
        got = list(zip(*(column.to_pylist() for column in single_alignments(batch, 0.8))))
        assert got == expected[cut:]


def test_awkward_tables(spark):
    shared = prose(1, 80)
    docs = [(1, f"{prose(2, 20)} {shared}"), (1, f"{prose(2, 20)} {shared}"), (None, shared), (3, None), (4, ""), (5, f"{shared} {prose(3, 9)}"), (5, f"{shared} {prose(3, 9)}"), (6, prose(4, 50))]
    df = spark.createDataFrame(docs, TEXT)
    for name in ("cut_spans", "cut_id", "_slot", "_gone", "slot", "start_word", "id", "words"):
        df = df.withColumn(name, F.lit("kept"))
    found = repeated_passages(df)
    assert [(r["doc_id"], r["start_word"], r["end_word"], r["source_id"]) for r in found.collect()] == [(5, 0, 80, 1)]
    cut = cut_passages(df, found).collect()
    assert len(cut) == len(docs) and all(r["cut_id"] == r["_slot"] == "kept" for r in cut)
    assert sorted(r["text"].strip() for r in cut if r["doc_id"] == 5) == [prose(3, 9)] * 2
    assert {r["text"] for r in cut if r["doc_id"] is None} == {shared}
    assert repeated_passages(df.limit(0)).collect() == [] == cut_passages(df.limit(0), found).collect()


def test_a_long_text_and_many_copies(spark):
    long = prose(7, 6000)
    docs = [(0, long)] + [(i, f"{prose(100 + i, 30)} {' '.join(long.split()[100 * i : 100 * i + 70])}") for i in range(1, 40)]
    found = {r["doc_id"]: (r["start_word"], r["end_word"]) for r in reported(spark, docs)}
    assert found == {i: (30, 100) for i in range(1, 40)}
