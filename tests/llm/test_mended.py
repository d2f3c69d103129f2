"""WARC payloads, URL filters and languages in cases that the sample tables do not hold."""

import gzip
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import plan
from veritable.llm.language_id import identify, label_words, learn, sample
from veritable.llm.url_filter import filter_urls
from veritable.llm.warc import content, derivatives, derive, head_fields, parse_head, record, responses, unchunked

HTML = "<p>Grüße &amp; more</p>".encode()
TEXT = "doc_id long, text string"


def chunked(data, size=5):
    parts = [data[i : i + size] for i in range(0, len(data), size)]
    return b"".join(b"%x;ext=1\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\nTrailer: x\r\n\r\n"


def raw_deflate(data):
    made = zlib.compressobj(wbits=-15)
    return made.compress(data) + made.flush()


def answered(payload, *fields, end="\r\n"):
    block = end.join(["HTTP/1.1 200 OK", *fields, "", ""]).encode() + payload
    made = derive(record({"WARC-Type": "response", "WARC-Record-ID": "<urn:x>"}, block))
    kinds = {r["record_type"]: parse_head(r["record"])[2] for r in made}
    return kinds.get("conversion"), kinds["metadata"].decode()


@pytest.mark.parametrize(
    ("payload", "fields"),
    [
        (HTML, []),
        (gzip.compress(HTML), ["Content-Encoding: gzip"]),
        (gzip.compress(HTML[:9]) + gzip.compress(HTML[9:]), ["content-encoding: X-GZIP"]),
        (zlib.compress(HTML), ["Content-Encoding: deflate"]),
        (raw_deflate(HTML), ["Content-Encoding: deflate"]),
        (chunked(HTML), ["Transfer-Encoding: chunked"]),
        (chunked(gzip.compress(HTML)), ["Content-Encoding: gzip", "Transfer-Encoding: chunked"]),
        (gzip.compress(gzip.compress(HTML)), ["Content-Encoding: gzip, gzip"]),
        (HTML, ["Content-Encoding: identity"]),
        (HTML, ["Content-Encoding: gzip", "Transfer-Encoding: chunked"]),  # stored without either
    ],
)
@pytest.mark.parametrize("end", ["\r\n", "\n"])
def test_codings_are_undone(payload, fields, end):
    text, about = answered(payload, "Content-Type: text/html; charset=utf-8", *fields, end=end)
    assert text == "Grüße & more".encode() + b"\r\n\r\n"
    assert all(f"source-http-header: {f}" in about for f in fields) and "conversion:" not in about


def test_payloads_that_break_off_are_read_as_far_as_they_go():
    long = b"<p>" + b" ".join(b"word%d" % i for i in range(5000))
    for payload, coding in ((gzip.compress(long)[:-900], "gzip"), (zlib.compress(long)[:-900], "deflate")):
        text, _ = answered(payload, f"Content-Encoding: {coding}")
        assert text.startswith(b"word0 word1 word2 ") and len(text) > 1000
    assert unchunked(chunked(HTML)[:20]) == HTML[: len(unchunked(chunked(HTML)[:20]))] != b""


@pytest.mark.parametrize("kind", ["image/png", "application/pdf", "video/mp4", "application/octet-stream", "font/woff2"])
def test_what_is_not_text_has_no_conversion(kind):
    text, about = answered(b"\x89PNG\x00\xff" * 9, f"Content-Type: {kind}")
    assert text is None and "conversion: none: the payload is not text" in about


def test_unknown_codings_have_no_conversion():
    text, about = answered(b"\x01\x02", "Content-Type: text/html", "Content-Encoding: br")
    assert text is None and "none: unknown coding" in about
    assert content(b"x", [("Transfer-Encoding", "zstd")]) is None


@pytest.mark.parametrize("kind", ["text/plain", "application/json", "application/ld+json; charset=utf-8", "image/svg+xml"])
def test_text_of_other_types_is_kept(kind):
    assert answered(b'{"a": "<b>"}', f"Content-Type: {kind}")[0].startswith(b'{"a": "<b>"}')


def test_awkward_records(spark):
    good = record({"WARC-Type": "response"}, b"HTTP/1.1 200 OK\r\n\r\nHi")
    other = record({"WARC-Type": "request"}, b"GET / HTTP/1.1\r\n\r\n")
    rows = [(1, good), (1, good), (2, other), (3, None), (4, b""), (5, b"\x00\xff no record"), (None, good), (6, b"WARC/1.0\n\n")]
    df = spark.createDataFrame(rows, "page_id long, record binary")
    for name in ("record_type", "record_id", "block_digest"):
        df = df.withColumn(name, F.lit("x"))
    made = derivatives(df).collect()
    assert sorted((r["page_id"] or 0, r["record_type"]) for r in made) == [(0, "conversion"), (0, "metadata"), (1, "conversion"), (1, "conversion"), (1, "metadata"), (1, "metadata")]
    assert len({r["record_id"] for r in made}) == 2
    assert derivatives(df.limit(0)).collect() == []
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert derivatives(responses(pages)).collect() == []
    assert head_fields(b"A\nb: 1\n c\n\nrest") == ("A", [("b", "1 c")], b"rest")


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.example.net", "/en/x", "block"), ("org", "", "block")]
URLS = [f"http://{h}.{d}{p}" for h in ("a.example", "b.example", "x", "example") for d in ("net", "org", "com") for p in ("", "/", "/en/", "/en/x/y?q")]


def judged(urls, rules):
    found = []
    for url in urls:
        host, path = re.fullmatch("[^:]*://([^/?#]*)([^?#]*).*", url).groups()
        fits = [(len(h) + len(p), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        found.append(max(fits)[1:] if fits else (None, "allow"))
    return found


@pytest.mark.parametrize("prefix_chars", [1, 2, 8])
def test_false_candidates_of_a_short_prefix_are_rejected(spark, prefix_chars):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    pages = spark.createDataFrame(list(enumerate(URLS * 2)), "page_id long, url string")
    rows = filter_urls(pages, rules, prefix_chars=prefix_chars).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"]) for r in rows] == judged(URLS * 2, RULES)


def test_only_the_prefix_is_a_key_of_the_join(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    shown = plan(filter_urls(spark.createDataFrame([(1, URLS[0])], "page_id long, url string"), rules))
    keys = re.findall(r"Left keys \[\d+\]: \[([^\]]*)\]", shown)
    assert any(key.startswith("prefix#") and "," not in key for key in keys)
    assert not any("digest" in key for key in keys)


def test_awkward_urls(spark):
    rules = spark.createDataFrame(RULES * 2 + [(None, "/", "block"), ("", "/", "block")], "host string, path string, action string")
    pages = spark.createDataFrame([(1, URLS[0], "j"), (1, URLS[0], "j"), (None, None, "j")], "page_id long, url string, judged_host string")
    for name in ("judged_path", "judged_rule", "judged_action", "prefix", "digest", "action"):
        pages = pages.withColumn(name, F.lit("x"))
    rows = filter_urls(pages, rules).collect()
    assert len(rows) == 3 and {r["judged_host"] for r in rows} == {"j"} and rows[0].__fields__[:9] == pages.columns
    assert filter_urls(pages.limit(0), rules).collect() == []
    nothing = filter_urls(pages, rules.limit(0)).collect()
    assert {(r["rule"], r["verdict"]) for r in nothing} == {(None, "allow")}


def language(n):
    """Words of a language of its own."""
    rng = random.Random(n)
    syllables = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(12)]
    return lambda k, seed: " ".join("".join(random.Random(f"{n} {seed} {i}").choices(syllables, k=2)) for i in range(k))


def test_many_languages(spark):
    spoken = {f"l{n:03d}": language(n) for n in range(300)}
    rows = [(100 * i + k, say(60, k), name) for i, (name, say) in enumerate(spoken.items()) for k in range(4)]
    model = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(i, say(30, "asked")) for i, say in enumerate(spoken.values())], TEXT)
    got = {r["doc_id"]: r["lang_pred"] for r in identify(asked, model).collect()}
    assert sum(got[i] == name for i, name in enumerate(spoken)) >= 297


def test_viterbi_equals_trying_all_labels():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n, kinds = int(rng.integers(1, 6)), int(rng.integers(1, 4))
        scores = rng.normal(size=(n, kinds)).astype(np.float32) * 2

        def value(path, scores=scores):
            return sum(scores[i, k] for i, k in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))

        paths = np.array(np.meshgrid(*[range(kinds)] * n)).reshape(n, -1).T
        best = max(value(path) for path in paths)
        assert abs(value(label_words(scores, np.array([0, n]), 1.5)) - best) < 1e-3


def test_spans_of_mixed_text(spark):
    one, two = language(1), language(2)
    rows = [(i, one(60, i), "aa") for i in range(20)] + [(50 + i, two(60, i), "bb") for i in range(20)]
    model = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    first, second = one(25, "x"), two(40, "x")
    text = f"{first} {second}"
    row = identify(spark.createDataFrame([(1, text)], TEXT), model, spans=True).first()
    assert [s["lang"] for s in row["lang_spans"]] == ["aa", "bb"] and row["lang_pred"] == "bb"
    assert row["lang_spans"][0]["start"] == 0 and row["lang_spans"][1]["end"] == len(text)
    assert abs(row["lang_spans"][1]["start"] - len(first) - 1) <= 14
    assert 0.5 < row["score"] < 0.75


def test_languages_of_awkward_tables(spark):
    rows = [(1, "word one", "aa"), (1, "word one", "aa"), (None, "two words", "bb"), (2, None, "aa"), (3, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(tuple(r) for r in sample(df).collect()) == [("aa", "word one"), ("aa", "word one"), ("bb", "two words")]
    assert len(sample(df, 1).collect()) == 2
    nothing = learn(df.limit(0))
    named = df.withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit("x"))
    assert {(r["lang_pred"], r["score"]) for r in identify(named, nothing).collect()} == {("und", 0.0)}
    assert identify(named.limit(0), learn(df)).collect() == []
