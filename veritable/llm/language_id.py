"""Language identification of mixed-language text, word by word.

Model. Letters are taken with their neighbours inside the word (trigrams, words
bounded), hashed into ``FEATURES`` buckets; a language is the smoothed logarithm of
its bucket frequencies, and the scripts its training words are written in. It is
fitted on a bounded sample: ``SAMPLE_ROWS`` documents of each language at most, drawn
by the hash of their id. The model has ``FEATURES`` numbers per language,
however large the corpus is; only its counts come to the driver: ``FEATURES`` numbers
and a few for each language, 0.5 MB a language as learned.

Prediction. The script of a word narrows its candidates to the languages written
in it. Viterbi over the words, with ``SWITCH_PENALTY`` for each change of language,
labels spans; it runs over many documents side by side. The language of a document
is the one whose spans have the most letters (the alphabetically first of equals),
its score the share of the letters in these spans whose script is one of the
language's, among all letters.

Edge cases: a null text, one without letters, and any text if nothing was learned
is ``und`` with score 0. Words of a script that no language has fit any language
equally and lower the score. Texts are read whole; repeated rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritable.llm.common import Batches, in_arrow
from veritable.llm.words import slices

UNKNOWN = "und"
FEATURES = 1 << 16
SAMPLE_ROWS = 2000
SWITCH_PENALTY = 12.0
_SMOOTHING = 0.5
_LEAST_SHARE = 0.005
_WORDS_AT_ONCE = 1 << 20
_NEVER = np.float32(-1e6)

# Script ranges of Unicode, first and last code point. Letters in
# none of them belong to script 0.
SCRIPTS = (
    ("latin", ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("gurmukhi", ((0xA00, 0xA7F),)),
    ("gujarati", ((0xA80, 0xAFF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("telugu", ((0xC00, 0xC7F),)),
    ("kannada", ((0xC80, 0xCFF),)),
    ("malayalam", ((0xD00, 0xD7F),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF))),
    ("ethiopic", ((0x1200, 0x139F),)),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))),
)


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, its lower case, its script."""
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero(letter).tolist():
        small = chr(i).lower()
        if len(small) == 1:
            lower[i] = ord(small)
    script = np.zeros(0x110000, np.uint8)
    for number, (_, ranges) in enumerate(SCRIPTS, 1):
        for low, high in ranges:
            script[low : high + 1] = number
    return letter, lower, script


@dataclass
class WordFeatures:
    """Letters of some texts: one feature each, and the words they form."""

    feature: np.ndarray
    word: np.ndarray  # first letter of each word
    script: np.ndarray  # of each word, by its first letter
    first: np.ndarray  # first word of each text, and one more entry
    start: np.ndarray  # of each word, in characters of its text
    length: np.ndarray  # of each word, in letters


def word_features(texts: list[str]) -> WordFeatures:
    """Features of all words of all texts; a word is a run of letters."""
    letter, lower, script = _characters()
    joined = "\0".join(texts) + "\0"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letter[code]
    before = np.concatenate(([False], is_letter[:-1]))
    at = np.flatnonzero(is_letter)
    small = np.where(is_letter, lower[code], 0).astype(np.uint32)
    # Neighbours that are no letters count as 0; the text ends with one.
    value = small[at - 1] * np.uint32(0x9E3779B1) + small[at] * np.uint32(0x85EBCA77) + small[at + 1] * np.uint32(0xC2B2AE3D)
    value ^= value >> np.uint32(15)
    value *= np.uint32(0x2C1B3C6D)
    value ^= value >> np.uint32(13)
    starts = np.flatnonzero(is_letter & ~before)
    word = np.searchsorted(at, starts)
    ends = np.cumsum([len(t) + 1 for t in texts])
    first = np.searchsorted(starts, np.concatenate(([0], ends)))
    start = starts - np.repeat(np.concatenate(([0], ends[:-1])), np.diff(first))
    length = np.diff(np.append(word, len(at)))
    return WordFeatures((value & np.uint32(FEATURES - 1)).astype(np.int32), word, script[code[starts]], first, start, length)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # FEATURES x languages
    scripts: np.ndarray  # scripts x languages: whether the language is written in it


def sample(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(lang, text): at most ``rows`` documents of each language, drawn by the hash of their id."""
    named = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    # Thinned out by hash to about three times what is wanted before the texts are
    # shuffled; one row per language is broadcast, as many as the model has columns.
    counts = named.groupBy(F.col("lang").alias("counted")).agg((3 * rows / F.count(F.lit(1))).alias("share"))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    thinned = named.join(F.broadcast(counts), F.expr("lang <=> counted")).where(drawn < F.col("share"))
    # Ids and digests are ranked; texts are fetched for what is drawn, and never sorted.
    draw = thinned.select("lang", "doc_id", F.xxhash64("text").alias("mark"), "text")
    ranked = draw.drop("text").selectExpr(
        "lang AS l", "doc_id AS d", "mark AS m",
        "row_number() OVER (PARTITION BY lang ORDER BY xxhash64(doc_id, 1), doc_id, mark) AS position",
    )
    # Equal rows are drawn together, each as often as it was ranked.
    drawn_rows = ranked.where(F.col("position") <= rows).groupBy("l", "d", "m").agg(F.count(F.lit(1)).alias("times"))
    again = draw.dropDuplicates(["lang", "doc_id", "mark"]).join(drawn_rows, F.expr("lang <=> l AND doc_id <=> d AND mark <=> m"))
    return again.select("lang", "text", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).select("lang", "text")


def learn(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit the model on a bounded sample of ``labelled`` (doc_id, text, lang)."""

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in slices(batch, "text"):
                found = word_features(piece.column("text").to_pylist())
                letters = np.append(found.word, len(found.feature))[found.first]
                for i, lang in enumerate(piece.column("lang").to_pylist()):
                    total = totals.setdefault(lang, np.zeros(FEATURES + len(SCRIPTS) + 1, np.int64))
                    total[:FEATURES] += np.bincount(found.feature[letters[i] : letters[i + 1]], minlength=FEATURES)
                    total[FEATURES:] += np.bincount(found.script[found.first[i] : found.first[i + 1]], minlength=len(SCRIPTS) + 1)
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.record_batch({"lang": pa.array([lang] * len(used), pa.string()), "slot": used.astype(np.int32), "n": total[used]})

    counted = in_arrow(sample(labelled, rows), count, "lang string, slot int, n long")
    # One number per language and feature: bounded by the model, not by the corpus.
    counts = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    languages = sorted(counts["lang"].unique())
    table = np.zeros((FEATURES + len(SCRIPTS) + 1, len(languages)))
    table[counts["slot"], np.searchsorted(languages, counts["lang"])] = counts["n"]
    smooth = table[:FEATURES] + _SMOOTHING
    weights = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
    scripts = table[FEATURES:] >= np.maximum(_LEAST_SHARE * table[FEATURES:].sum(axis=0), 1)
    return Model([str(x) for x in languages], weights, scripts)


def word_scores(found: WordFeatures, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Per word a score for each language, and which languages are candidates."""
    allowed = model.scripts[found.script]
    if not len(found.word):
        return np.zeros((0, len(model.languages)), np.float32), allowed
    scores = np.add.reduceat(model.weights[found.feature], found.word, axis=0)
    return np.where(allowed, scores, np.where(allowed.any(axis=1, keepdims=True), _NEVER, np.float32(0))), allowed


def label_words(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best language of each word, by Viterbi over each text; all texts step together."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begins, counts = first[:-1][order], counts[order]
    steps = int(counts[0]) if len(counts) else 0
    number = np.min_scalar_type(max(scores.shape[1] - 1, 0)) if scores.ndim > 1 else np.uint8
    labels = np.zeros(len(scores), number)
    if not steps:
        return labels
    # How many texts have more than t words.
    active = np.searchsorted(-counts, -np.arange(steps), "left")
    stays = np.zeros(scores.shape, bool)
    source = np.zeros(len(scores), number)
    best = scores[begins[: active[0]]].copy()
    for t in range(1, steps):
        n = active[t]
        best = best[:n]
        at = begins[:n] + t
        top = best.argmax(axis=1)
        moved = (best[np.arange(n), top] - np.float32(penalty))[:, None]
        stays[at] = best >= moved
        source[at] = top
        best = np.maximum(best, moved) + scores[at]
        # Only differences matter; this keeps single precision exact enough.
        best -= best.max(axis=1, keepdims=True)
        if t + 1 == steps or active[t + 1] < n:
            last = n if t + 1 == steps else active[t + 1]
            done = np.arange(0 if t + 1 == steps else last, n)
            labels[at[done]] = best[done].argmax(axis=1)
    single = np.flatnonzero(counts == 1)
    labels[begins[single]] = scores[begins[single]].argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        at = begins[: active[t]] + t
        now = labels[at]
        labels[at - 1] = np.where(stays[at, now], now, source[at])
    return labels


def _predictions(texts: list[WordFeatures], scored: list, model: Model) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, labels and first words of all texts of several chunks."""
    scores = np.concatenate([s for s, _ in scored])
    allowed = np.concatenate([a for _, a in scored])
    length = np.concatenate([x.length for x in texts])
    shifts = np.cumsum([0, *(len(x.word) for x in texts)])
    first = np.concatenate([[0], *(x.first[1:] + shift for x, shift in zip(texts, shifts))]).astype(np.int64)
    labels = label_words(scores, first)
    count = len(first) - 1
    owner = np.repeat(np.arange(count), np.diff(first))
    kinds = len(model.languages)
    letters = np.bincount(owner * kinds + labels, length, count * kinds).reshape(count, kinds)
    fitting = length * allowed[np.arange(len(labels)), labels]
    fitted = np.bincount(owner * kinds + labels, fitting, count * kinds).reshape(count, kinds)
    top = letters.argmax(axis=1)
    total = letters.sum(axis=1)
    share = fitted[np.arange(count), top] / np.maximum(total, 1)
    return [model.languages[i] if n else UNKNOWN for i, n in zip(top, total)], share, labels, first


def identify(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with ``lang_pred`` and ``score``.

    ``spans`` adds ``lang_spans``: (lang, start, end) in characters, from the
    first letter of a span to the one after its last. Columns of these names are
    replaced.
    """
    made = {"lang_pred": "string", "score": "double"}
    if spans:
        made["lang_spans"] = "array<struct<lang: string, start: int, end: int>>"
    kept = docs.drop(*made)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, WordFeatures, tuple]] = []
        words = 0
        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                found = word_features([t or "" for t in piece.column("text").to_pylist()])
                held.append((piece, found, word_scores(found, shared.value)))
                words += len(found.word)
                if words >= _WORDS_AT_ONCE:
                    yield from answer(held)
                    held, words = [], 0
        if held:
            yield from answer(held)

    def answer(held: list) -> Iterator[pa.RecordBatch]:
        known = shared.value
        if known.languages:
            langs, share, labels, first = _predictions([f for _, f, _ in held], [s for _, _, s in held], known)
        row = 0
        for piece, found, _ in held:
            n = piece.num_rows
            if not known.languages:
                columns = [pa.array([UNKNOWN] * n, pa.string()), pa.array([0.0] * n)]
                listed: list = [[] for _ in range(n)]
            else:
                columns = [pa.array(langs[row : row + n], pa.string()), pa.array(share[row : row + n])]
                listed = []
                for i in range(n) if spans else ():
                    low, high = first[row + i], first[row + i + 1]
                    listed.append(_spans(labels[low:high], found, i, known))
            if spans:
                columns.append(pa.array(listed, pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))))
            yield pa.RecordBatch.from_arrays([*piece.columns, *columns], [*piece.schema.names, *made])
            row += n

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return in_arrow(kept, run, ", ".join([schema, *(f"{name} {kind}" for name, kind in made.items())]))


def _spans(labels: np.ndarray, found: WordFeatures, text: int, model: Model) -> list[dict]:
    if not len(labels):
        return []
    low = found.first[text]
    cuts = np.flatnonzero(labels[1:] != labels[:-1]) + 1
    begins, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(labels)]
    return [
        {
            "lang": model.languages[labels[b]],
            "start": int(found.start[low + b]),
            "end": int(found.start[low + e - 1] + found.length[low + e - 1]),
        }
        for b, e in zip(begins, ends)
    ]


def held_out() -> Column:
    """Whether a document is kept from training: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def identify_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with lang_pred and score, learned from the rows that are not held out."""
    return identify(docs, learn(docs.where(~held_out())))
