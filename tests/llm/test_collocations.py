"""Collocations against a plain version; parts of long texts; awkward tables."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from veritable.llm.collocations import _merged, _parts, _stripes, collocations

ROWS = "doc_id long, text string, lang string"


def plain(rows, least=10, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    found = []
    for lang, f in counts.items():
        longer = Counter()
        for phrase, a in f.items():
            if len(phrase) == 3 and a >= least:
                for part in (phrase[:2], phrase[1:]):
                    longer[part] = max(longer[part], a)
        kept = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least or (len(phrase) == 2 and 100 * longer[phrase] >= 50 * a and longer[phrase]):
                continue
            cuts = [(1000000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def result(df, **options):
    return sorted(tuple(r) for r in collocations(df, **options).collect())


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gamma", "é", "x\x0by", "D,", "e.", "f\t", "\n", "g!h", "\U0001f600", "delta", "of", "the", "THE"]
    return [
        (i, " ".join(rng.choices(words, k=rng.randint(0, 60))), rng.choice(["en", "de", None])) for i in range(n)
    ]


@pytest.mark.parametrize("top", [5, 2000])
def test_equals_a_plain_version(spark, top):
    rows = [*corpus(1, 300), (900, None, "en"), (901, "", None), (902, " . , ", "fr"), (903, "only", "fr")]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    assert result(df, top=top) == plain(rows, top=top)
    assert result(df.union(df), top=top) == plain(rows + rows, top=top)


def test_a_common_pair_and_a_hot_word(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["hot pair"] * 40 + [f"hot w{rng.randint(0, 900)} z"] * 2 + ["hot hot"] * 3), "en") for i in range(400)]
    assert result(spark.createDataFrame(rows, ROWS).repartition(7)) == plain(rows)


def test_subsumption_counts_longer_phrases_however_they_are_cut(spark):
    text = ". ".join(["new york city"] * 20 + ["york city hall"] * 12 + ["new york"] * 30 + ["city hall"] * 9)
    rows = [(1, text, "en")]
    found = result(spark.createDataFrame(rows, ROWS))
    assert found == plain(rows)
    assert "york city" not in {r[2] for r in found} and "new york" in {r[2] for r in found}


def counted(text, most):
    entries = Counter()
    for part, skip in _parts(text, most):
        for depth in range(3):
            for batch in _stripes("en", part, skip, depth, ["of"], None):
                keys, counters = _merged([batch])
                for run, following, n in zip(*(counters.column(c).to_pylist() for c in ("run", "next", "n"))):
                    row = keys.slice(run, 1).to_pylist()[0]
                    entries[depth, row["prefix"], row["segment"], following] += n
    return entries


@pytest.mark.parametrize("most", [16, 50, 1000])
@pytest.mark.parametrize("seed", range(4))
def test_parts_of_a_long_text_count_as_the_whole(most, seed):
    rng = random.Random(seed)
    breaks = [" ", " ", "\t ", ". "] if seed % 2 else [" ", "  "]
    text = "".join(rng.choice(["a", "Of", "of", "bc", "d" * 30, "é"]) + rng.choice(breaks) for _ in range(400)).encode()
    assert counted(text, most) == counted(text, 1 << 30)


def test_awkward_tables(spark):
    assert result(spark.createDataFrame([], ROWS)) == []
    assert result(spark.createDataFrame([(1, None, None)], ROWS)) == []
    rows = [(1, "a b " * 20, "en")]
    df = spark.createDataFrame(rows, ROWS)
    for name in ("n", "next", "prefix", "a", "score", "segment"):
        df = df.withColumn(name, F.lit(7))
    assert result(df) == plain(rows)


def test_scores_whose_products_pass_64_bits(spark):
    from veritable.llm.collocations import _score

    a, left, right = 3 * 10**14, 9 * 10**14 + 7, 5 * 10**14 + 3
    row = spark.range(1).selectExpr(f"{a}L AS a", f"{left}L AS l", f"{right}L AS r").select(_score("a", "l", "r")).first()
    assert row[0] == 1000000 * a * a // (left * right)
