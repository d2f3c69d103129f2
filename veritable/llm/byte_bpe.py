"""Byte-level BPE with the tokenizers library, over Arrow batches.

Encoding. The pattern that splits a text before the merges never joins across a
space that stands between two characters other than white space: the space
belongs to what follows it. Texts are cut at such spaces, equal pieces of a batch
are encoded once, in one go, and the ids gathered again. Pieces at either end of
a text are encoded by themselves. The ids are those of the whole text.

Byte-to-character mapping. The library writes every byte as a printable
character; ``byte_table`` turns the vocabulary back into bytes. Token offsets in
characters follow from the number of bytes of each token: a token starts at the
character that its first byte belongs to, and ends after the one its last byte
belongs to, also where a character is split between tokens.

Decoding gathers the bytes of the ids. What is returned as text has U+FFFD where
the ids end, or begin, inside a character; the bytes are exact.

Edge cases: null and empty texts have no ids and decode to nothing; null or empty
id lists decode to nothing; ids outside the vocabulary are an error. Strings that
look like special tokens are ordinary text. Texts of any length are taken whole.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.llm.common import Batches, in_arrow
from veritable.llm.words import slices, text_buffer

VOCABULARY = "byte_bpe_50k.json"
_PIECE_BYTES = 1 << 15
_SLICE_BYTES = 4 << 20
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E), 0x1C, 0x1D, 0x1E, 0x1F]] = True
# First bytes of the multi-byte characters that are white space.
_WIDE_WHITE = np.zeros(256, bool)
_WIDE_WHITE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


@lru_cache(maxsize=2)
def tokenizer(name: str = VOCABULARY):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(public_tokenizers.path(name))
    loaded.encode_special_tokens = True
    return loaded


@lru_cache(maxsize=2)
def byte_table(name: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all tokens one after the other, and where each id's begin."""
    # Fixed rule: printable bytes stand for themselves, the others follow from U+0100 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}
    tokens = [b""] * tokenizer(name).get_vocab_size()
    for token, number in tokenizer(name).get_vocab(with_added_tokens=False).items():
        tokens[number] = bytes(byte_of[c] for c in token)
    begins = np.concatenate(([0], np.cumsum([len(t) for t in tokens])))
    return np.frombuffer(b"".join(tokens), np.uint8), begins


def _gather(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the runs begins[i] .. begins[i] + lengths[i], one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.repeat(begins - ends + lengths, lengths) + np.arange(ends[-1])


def _pieces(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of all texts begin, and which lie at neither end of a text."""
    white = _WHITE[raw]
    cut = np.zeros(len(raw) + 1, bool)
    if len(raw) > 2:
        inner = (raw[1:-1] == 0x20) & ~white[:-2] & ~white[2:] & ~_WIDE_WHITE[raw[2:]]
        # White space of several bytes before it ends in a byte from 0x80 on.
        for back in (2, 3):
            inner[back - 1 :] &= ~((raw[back:-1] == 0x20) & (raw[back - 1 : -2] >= 0x80) & _WIDE_WHITE[raw[: -back - 1]])
        cut[1 : len(raw) - 1] = inner
    cut[offsets] = True
    begins = np.flatnonzero(cut[:-1])
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    ends = np.append(begins[1:], len(raw))
    return begins, ~(edge[begins] | edge[ends])


def encode_texts(texts: pa.Array, name: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and where each text's begin."""
    raw, offsets = text_buffer(texts)
    if not len(raw):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    begins, inner = _pieces(raw, offsets)
    ends = np.append(begins[1:], len(raw))
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(np.append(begins, len(raw))), pa.py_buffer(raw)]
    )
    model = tokenizer(name)
    known = pieces.filter(pa.array(inner)).dictionary_encode()
    # Inner pieces begin with a space and end in something else, so they may follow each other.
    joined, at = text_buffer(known.dictionary.cast(pa.large_string()))
    sizes = np.diff(byte_table(name)[1])
    piece_ids, piece_begins = [], np.zeros(len(at), np.int64)
    total = low = 0
    while low < len(at) - 1:
        high = max(low + 1, int(np.searchsorted(at, at[low] + _PIECE_BYTES, "right")) - 1)
        ids = np.array(model.encode(joined[at[low] : at[high]].tobytes().decode(), add_special_tokens=False).ids, np.int32)
        ends_at = np.concatenate(([0], np.cumsum(sizes[ids])))
        piece_begins[low : high + 1] = total + np.searchsorted(ends_at, at[low : high + 1] - at[low])
        piece_ids.append(ids)
        total += len(ids)
        low = high
    outer = np.flatnonzero(~inner)
    outer_texts = [raw[b:e].tobytes().decode() for b, e in zip(begins[outer], ends[outer])]
    outer_ids = [e.ids for e in model.encode_batch_fast(outer_texts, add_special_tokens=False)]
    flat = np.concatenate([*piece_ids, np.array([i for ids in outer_ids for i in ids], np.int32)])
    first, count = np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64)
    index = known.indices.to_numpy()
    first[inner], count[inner] = piece_begins[index], np.diff(piece_begins)[index]
    outer_counts = np.array([len(ids) for ids in outer_ids], np.int64)
    first[outer], count[outer] = total + np.cumsum(outer_counts) - outer_counts, outer_counts
    ids = flat[_gather(first, count)]
    before = np.concatenate(([0], np.cumsum(count)))
    return ids, before[np.searchsorted(begins, offsets)]


def decode_ids(ids: np.ndarray, first: np.ndarray, name: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all id lists one after the other, and where each list's begin."""
    table, begins = byte_table(name)
    if len(ids) and (ids.min() < 0 or ids.max() >= len(begins) - 1):
        raise ValueError("ids outside the vocabulary")
    sizes = np.diff(begins)[ids]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return table[_gather(begins[ids], sizes)], ends[first]


def character_spans(raw: np.ndarray, ids: np.ndarray, name: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token of one text, and the one after its last."""
    ends = np.cumsum(np.diff(byte_table(name)[1])[ids])
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else ends
    return char[starts], char[ends - 1] + 1


def encode(docs: DataFrame, column: str = "text", offsets: bool = False) -> DataFrame:
    """``docs`` with ``ids``, and with ``starts`` and ``ends`` in characters if asked for.

    Columns of these names are replaced.
    """
    made = ["ids", "starts", "ends"] if offsets else ["ids"]
    kept = docs.drop(*made)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, column, _SLICE_BYTES):
                ids, first = encode_texts(piece.column(column))
                lists = {"ids": ids}
                if offsets:
                    raw, at = text_buffer(piece.column(column))
                    spans = [
                        character_spans(raw[at[i] : at[i + 1]], ids[first[i] : first[i + 1]])
                        for i in range(piece.num_rows)
                    ]
                    lists["starts"], lists["ends"] = (np.concatenate(x).astype(np.int32) for x in zip(*spans))
                arrays = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x)) for x in lists.values()]
                yield pa.RecordBatch.from_arrays([*piece.columns, *arrays], [*piece.schema.names, *made])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return in_arrow(kept, run, ", ".join([schema, *(f"{name} array<int>" for name in made)]))


def decode(tokens: DataFrame, column: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded`` (bytes) and ``decoded_text``; columns of these names are replaced."""
    kept = tokens.drop("decoded", "decoded_text")

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(column).fill_null([]) if batch.column(column).null_count else batch.column(column)
            first = lists.offsets.to_numpy().astype(np.int64)
            raw, at = decode_ids(lists.flatten().to_numpy(zero_copy_only=False), first - first[0])
            found = [raw[at[i] : at[i + 1]].tobytes() for i in range(batch.num_rows)]
            texts = pa.array([x.decode(errors="replace") for x in found], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary()), texts],
                [*batch.schema.names, "decoded", "decoded_text"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return in_arrow(kept, run, f"{schema}, decoded binary, decoded_text string")


@lru_cache(maxsize=1)
def _numbers(count: int) -> list[bytes]:
    return [str(i).encode() for i in range(count)]


def round_trip(docs: DataFrame, slice_bytes: int = _SLICE_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded and decoded in one pass over the texts.

    Texts are taken in slices of ``slice_bytes``: smaller ones need less memory and more time.
    """

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        number = _numbers(tokenizer().get_vocab_size()).__getitem__
        for batch in batches:
            for piece in slices(batch, "text", slice_bytes):
                ids, first = encode_texts(piece.column("text"))
                raw, at = decode_ids(ids, first)
                listed, rows = ids.tolist(), range(piece.num_rows)
                yield pa.record_batch(
                    {
                        "doc_id": piece.column("doc_id"),
                        "n_tokens": pa.array(np.diff(first)),
                        "ids_sha256": pa.array(
                            [hashlib.sha256(b" ".join(map(number, listed[first[i] : first[i + 1]]))).hexdigest() for i in rows], pa.string()
                        ),
                        "decoded_sha256": pa.array(
                            [hashlib.sha256(raw[at[i] : at[i + 1]]).hexdigest() for i in rows], pa.string()
                        ),
                    }
                )

    kept = docs.select(F.col("doc_id").cast("long"), "text")
    return in_arrow(kept, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
