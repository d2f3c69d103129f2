"""Small tables with awkward rows, against plain versions."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.llm import brute
from veritable.llm.byte_bpe import decode, encode, round_trip
from veritable.llm.decontaminate import find_leaks
from veritable.llm.embedding_pairs import near_duplicates
from veritable.llm.language_id import identify, learn
from veritable.llm.main_text import main_text
from veritable.llm.passages import cut_passages, repeated_passages
from veritable.llm.sharding import shard_documents
from veritable.llm.url_filter import filter_urls
from veritable.llm.warc import derivatives, derive, head_fields, parse_head, record, responses

TEXT = "doc_id long, text string"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(n))


def test_byte_bpe_is_that_of_the_ranks(spark):
    lines = map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "Hello  world's <|endoftext|>\n", "é 中文 😀 x", "a" * 5000, prose(1, 3000)]
    rows = {r["doc_id"]: r for r in round_trip(spark.createDataFrame(list(enumerate(texts)), TEXT)).collect()}
    for i, text in enumerate(texts):
        ids = plain.encode_ordinary(text or "")
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    again = decode(encode(spark.createDataFrame(list(enumerate(texts)), TEXT), offsets=True)).collect()
    assert [r["decoded_text"] for r in again] == [t or "" for t in texts]


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 12))
    rows = [(i, (base[i % 40] + rng.normal(size=12) * 0.15).tolist()) for i in range(160)]
    rows += [(900, rows[0][1]), (901, None), (902, [0.0] * 12), (903, [float("nan")] * 12), (904, [])]
    got = {r["vec_id"]: r for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    good = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if v and np.isfinite(v).all() and any(v)}
    union = brute.Union()
    for i, a in good.items():
        near = [j for j, b in good.items() if j != i and a @ b >= 0.95 - 1e-12]
        assert got[i]["n_links"] == len(near)
        for j in near:
            union.join(i, j)
    assert all(r["component_id"] == (union.root(i) if i in good else i) for i, r in got.items())


def test_passages_are_kept_once(spark):
    shared = prose(5, 90)
    docs = [(i, f"{prose(10 + i, 40)} {shared} {prose(50 + i, 40)}") for i in range(1, 6)] + [(9, prose(99, 200)), (10, None), (11, "")]
    df = spark.createDataFrame(docs, TEXT)
    found = repeated_passages(df)
    assert {r["doc_id"]: (r["start_word"], r["end_word"]) for r in found.collect()} == {i: (40, 130) for i in range(2, 6)}
    cut = {r["doc_id"]: r["text"] for r in cut_passages(df, found).collect()}
    assert shared in cut[1] and not any(shared in (cut[i] or "") for i in range(2, 6)) and cut[9] == docs[5][1]


def uncovered(found, doc, spans):
    """Those of ``spans`` that are in none of the passages of ``doc``."""
    own = [(r["start_word"], r["end_word"]) for r in found if r["doc_id"] == doc]
    return [s for s in spans if not any(low <= s[0] and s[1] <= high for low, high in own)]


def test_exact_runs_of_a_poor_chain_are_reported(spark):
    docs, wanted = [], {}
    for n in range(40):
        runs = [prose(1000 + 10 * n + i, 55) for i in range(3)]
        gap = [prose(5000 + 10 * n + i, 28 + n % 12) for i in range(2)]
        docs += [(2 * n, f"{runs[0]} {gap[0]} {runs[1]} {gap[1]} {runs[2]}"), (2 * n + 1, " ".join(runs))]
        wanted[2 * n + 1] = [(0, 55), (55, 110), (110, 165)]
    found = repeated_passages(spark.createDataFrame(docs, TEXT)).collect()
    assert not {d: lost for d, spans in wanted.items() if (lost := uncovered(found, d, spans))}


def test_runs_whose_seeds_lead_elsewhere_are_found(spark):
    docs, wanted = [], {}
    for n in range(60):
        one, two = prose(20000 + n, 26 + n % 10), prose(21000 + n, 26 + n % 15)
        apart = [f"{prose(22000 + n, 60)} {one} {prose(23000 + n, 60)}", f"{prose(24000 + n, 60)} {two} {prose(25000 + n, 60)}"]
        both = [f"{prose(26000 + 10 * n + i, 30)} {one} {two} {prose(27000 + 10 * n + i, 30)}" for i in range(2)]
        docs += [(4 * n + i, text) for i, text in enumerate(apart + both)]
        wanted[4 * n + 3] = [(30, 30 + len(f"{one} {two}".split()))]
    found = repeated_passages(spark.createDataFrame(docs, TEXT)).collect()
    assert not {d: lost for d, spans in wanted.items() if (lost := uncovered(found, d, spans))}
    assert {r["doc_id"] for r in found} == set(wanted)


def test_leaks(spark):
    items = [(1, prose(1, 30)), (2, prose(2, 3)), (3, None), (4, "")]
    docs = [(1, f"x {items[0][1].upper()} y"), (2, prose(7, 100)), (3, None), (4, f"a {items[1][1]} b"), (5, "")]
    found = find_leaks(spark.createDataFrame(docs, TEXT), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (4, 2)}


def test_leaks_at_the_bound_are_found(spark):
    items, docs = [], []
    for n in range(300):
        words = prose(40000 + n, 29 + n % 6).split()
        items.append((n, " ".join(words)))
        words[8 + n % 12] = "changed"  # in 5 of 25 to 30 shingles
        docs.append((n, f"{prose(41000 + n, 20)} {' '.join(words)} {prose(42000 + n, 20)}"))
    found = find_leaks(spark.createDataFrame(docs, TEXT), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(n, n) for n in range(300)}


@pytest.mark.parametrize("n", [0, 5, 100])
def test_shards_are_even_and_gapless(spark, n):
    docs = [(i, f"text {i % 30}" if i % 3 else None) for i in range(n)]
    rows = shard_documents(spark.createDataFrame(docs, TEXT), 7).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == n and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) in (n // 7, n // 7 + 1) for s in slots.values())


def test_language(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(30)] + [(50 + i, "кот и собака", "ru") for i in range(30)]
    model = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(1, "the dog"), (2, "собака и кот"), (3, None), (4, "12 !")], TEXT)
    assert [r["lang_pred"] for r in identify(asked, model, spans=True).orderBy("doc_id").collect()] == ["en", "ru", "und", "und"]


def test_urls(spark):
    urls = ["HTTP://A.Example.NET/en/x?q", "http://example.net", "x.net/en/", None, "http://example.net/fr/", "http://b.org/fr/#f"]
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow")], "host string, path string, action string")
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = [(r["host"], r["rule"], r["verdict"]) for r in filter_urls(pages, rules).orderBy("page_id").collect()]
    assert found == [
        ("a.example.net", "example.net/en/", "allow"), ("example.net", None, "allow"), ("", None, "allow"),
        ("", None, "allow"), ("example.net", "net/", "block"), ("b.org", None, "allow"),
    ]


def test_main_text():
    page = "<nav><a>Menu</a></nav><article><h1>T</h1><p>One &amp; two<br>three.<p>Four five six.</article><footer>F</footer>"
    assert main_text(page) == "T\n\nOne & two three.\n\nFour five six."
    assert main_text(None) == main_text("") == main_text("<script>x</script>") == ""


LONG = " ".join(["many words of running text without any tag"] * 40)


def test_main_text_keeps_all_of_a_lopsided_article():
    page = f"<nav><a>Menu</a></nav><article><h1>T</h1><p>Intro.</p><div>{LONG}</div><section>Last.</section></article><div>Imprint</div>"
    assert main_text(page) == f"T\n\nIntro.\n\n{LONG}\n\nLast."
    for tag, item in (("ul", "li"), ("blockquote", "p"), ("section", "article")):
        page = f"<main><h1>T</h1><p>Intro.</p><{tag}><{item}>{LONG}</{item}></{tag}><p>Last.</p></main>"
        assert main_text(page) == f"T\n\nIntro.\n\n{LONG}\n\nLast."
    assert main_text(f"<div><h1>T</h1><div>{LONG}</div></div>") == f"T\n\n{LONG}"


def test_main_text_of_pages_without_optional_end_tags():
    article = f"<article><h1>T</h1><p>{LONG}</article>"
    for head in ("<head><title>x</title><body>", "<head><meta charset=utf-8><title>x</title>", "<head><title>x</title><div>", "<head><title>x</title></head><body><nav><a>Menu</a>"):
        assert main_text(f"<html>{head}{article}") == f"T\n\n{LONG}"
    assert main_text(f"<head><title>x</title>{LONG}") == LONG
    assert main_text(f"<body><p>{LONG}</p><nav><a>Menu</a></nav><footer>x") == LONG


def test_main_text_names_are_whole_tokens_and_never_hide_the_article():
    inner = f'<div class="article-header"><h1>T</h1></div><h2 class="section-header">S</h2><p class="share-price">9 up</p><p>{LONG}</p><div class="ad">Buy</div>'
    wanted = f"T\n\nS\n\n9 up\n\n{LONG}"
    for name in ('class="content with-sidebar"', 'id="no-sidebar"', 'class="widget-content"', 'class="widget"', 'id="Modal"'):
        assert main_text(f"<body><div {name}><article>{inner}</article></div><div class='x ad'>Buy</div></body>") == wanted
        assert main_text(f"<body><div {name}>{inner}</div></body>") == wanted
    assert main_text(f'<div class="widget"><p>{LONG}</p></div>') == LONG
    assert main_text(f'<div class="ad">{LONG}</div><article><h1>T</h1><p>Few words.</article>') == "T\n\nFew words."


def test_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<p>Hi &lt;</p>"), (2, None, None)], "page_id long, url string, html string")
    sources = {r["page_id"]: parse_head(bytes(r["record"]))[1] for r in responses(pages).collect()}
    made = derivatives(responses(pages)).collect()
    assert len(made) == 4
    for r in made:
        assert r["refers_to"] == sources[r["page_id"]]["warc-record-id"]
        assert r["payload_digest"] == sources[r["page_id"]]["warc-payload-digest"]
        if r["record_type"] == "conversion":
            assert parse_head(bytes(r["record"]))[2] == (b"Hi <" if r["page_id"] == 1 else b"") + b"\r\n\r\n"


def test_warc_metadata_has_all_http_fields_in_their_order():
    sent = [("Date", "today"), ("Set-Cookie", "a=1"), ("ETag", '"x:y"'), ("Set-Cookie", "b=2"), ("Content-Type", "text/plain"), ("Location", "/n")]
    block = "\r\n".join(["HTTP/1.1 301 Moved", *(f"{k}: {v}" for k, v in sent), "", "Hi"]).encode()
    source = record({"WARC-Type": "response", "WARC-Record-ID": "<urn:x>"}, block)
    about = next(parse_head(r["record"])[2] for r in derive(source) if r["record_type"] == "metadata")
    fields = head_fields(b"about\r\n" + about)[1]
    assert [v for k, v in fields if k == "source-http-header"] == [f"{k}: {v}" for k, v in sent]
    assert dict(fields)["source-content-type"] == "text/plain"
