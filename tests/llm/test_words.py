import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from veritable.llm.words import shingle_sets, slices, windows, words_of

TEXTS = ["", None, "One two\tTHREE\x0bone two three", " ", "x", "É é ß a B b　", "w" * 40 + " " + "w" * 41]


def plain(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", lowered)


def check(texts):
    words = words_of(pa.array(texts, pa.string()))
    table = {}
    for i, text in enumerate(texts):
        span = slice(words.first[i], words.first[i + 1])
        expected = plain(text)
        raw = (text or "").encode()
        assert len(words.hash[span]) == len(expected)
        for h, s, e, w in zip(words.hash[span], words.start[span], words.end[span], expected):
            assert raw[s:e].lower() == w.encode().lower()
            assert table.setdefault(w, h) == h
    assert len(set(table.values())) == len(table)


def test_words_positions_and_hashes():
    check(TEXTS)
    sliced = pa.array(["zzz", *TEXTS, "yyy"], pa.string()).slice(1, len(TEXTS))
    assert np.array_equal(words_of(sliced).hash, words_of(pa.array(TEXTS, pa.string())).hash)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \n\t "))))
def test_words_of_any_texts(texts):
    check(texts)


def test_shingles_are_sets_and_short_texts_have_one():
    sets = shingle_sets(pa.array(["a b c a b c", "a b", "a", "", "a b c", "b a"]), 3)
    assert [len(s) for s in sets] == [3, 1, 1, 0, 1, 1]
    assert len({s[0] for s in (sets[1], sets[2], sets[4], sets[5])}) == 4
    assert sets[4][0] in sets[0]


def test_windows_stay_inside_a_text():
    words = words_of(pa.array(["a b", "c", "d e f"]))
    assert windows(words, 2)[1].tolist() == [0, 3, 4]
    assert windows(words, 9)[1].tolist() == []


def test_slices_cover_the_batch():
    batch = pa.record_batch({"t": pa.array(["aaaa", "b", None, "cccccccc", "d"])})
    parts = list(slices(batch, "t", 4))
    assert [row for p in parts for row in p.column("t").to_pylist()] == batch.column("t").to_pylist()
    assert max(p.num_rows for p in parts) < 5
    assert list(slices(batch.slice(0, 0), "t")) == []
