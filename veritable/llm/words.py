"""Words and shingles of whole Arrow columns, as 64-bit hashes in NumPy.

A word is a maximal run of bytes other than space and TAB..CR, with A-Z taken as
a-z. Hashes are 64 bits wide: two different words (shingles) are taken for one
with a chance of about 5e-20 a pair. Null texts count as empty ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = U64(0x9E3779B97F4A7C15)
_LOAD_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all 64 (the splitmix64 finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """Words of some texts, one after the other.

    ``first[i]:first[i + 1]`` are the words of text i; ``start`` and ``end`` are
    byte positions within that text.
    """

    hash: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins (one more entry than texts)."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most_bytes`` of text, one row at least."""
    if not batch.num_rows:
        return
    _, offsets = text_buffer(batch.column(column))
    row = 0
    while row < batch.num_rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most_bytes, "right")) - 1)
        stop = min(stop, batch.num_rows)
        yield batch.slice(row, stop - row)
        row = stop


def words_of(texts: pa.Array) -> Words:
    """All words of all texts."""
    raw, offsets = text_buffer(texts)
    size = len(raw)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, U64), np.zeros(len(offsets), np.int64), none, none)
    solid = ~_SPACE[raw]
    begins = np.zeros(size + 1, bool)
    begins[offsets] = True
    after_gap = np.ones(size, bool)
    after_gap[1:] = ~solid[:-1]
    start = np.flatnonzero(solid & (after_gap | begins[:-1]))
    before_gap = np.ones(size, bool)
    before_gap[:-1] = ~solid[1:]
    end = np.flatnonzero(solid & (before_gap | begins[1:])) + 1
    first = np.searchsorted(start, offsets)
    padded = np.zeros(size + 8, np.uint8)
    padded[:size] = _LOWER[raw]
    loads = np.ndarray((size + 1,), "<u8", padded.data, strides=(1,))
    length = end - start
    value = mix(length.astype(U64) * _ODD)
    todo, at = np.arange(len(start)), start.copy()
    while len(todo):
        left = np.minimum(end[todo] - at, 8)
        value[todo] = mix(value[todo] * _ODD + (loads[at] & _LOAD_MASK[left]))
        at += 8
        more = at < end[todo]
        todo, at = todo[more], at[more]
    base = np.repeat(offsets[:-1], np.diff(first))
    return Words(value, first, start - base, end - base)


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside one text, and their first words."""
    n = len(words.hash) - width + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    value = words.hash[:n]
    for step in range(1, width):
        value = mix(value * _ODD + words.hash[step : n + step])
    owner = words.owner
    inside = np.flatnonzero(owner[:n] == owner[width - 1 :])
    return value[inside], inside


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Per text its distinct shingles in ascending order.

    A text of fewer words than ``width`` has its whole sequence as the one
    shingle; a text without words has none.
    """
    words = words_of(texts)
    value, at = windows(words, width)
    value = mix(value ^ U64(width))
    cuts = np.searchsorted(at, words.first)
    found = []
    for i in range(len(words.first) - 1):
        if cuts[i] < cuts[i + 1]:
            found.append(np.unique(value[cuts[i] : cuts[i + 1]]))
            continue
        own = words.hash[words.first[i] : words.first[i + 1]]
        if len(own):
            whole = own[:1]
            for word in own[1:]:
                whole = mix(whole * _ODD + word)
            own = mix(whole ^ U64(len(own)))
        found.append(own)
    return found
