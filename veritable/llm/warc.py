"""WARC derivatives: response records turned into metadata and plain-text records.

``responses`` wraps pages as WARC/1.0 response records; ``derivatives`` reads any
response records and makes two records of each that keep a link to it:

* ``metadata``: warcinfo-fields with the source's target, date, digests, HTTP status
  and headers, all of them in their order as ``source-http-header``;
* ``conversion``: the text of the payload as ``text/plain``. Transfer and content codings
  (chunked, gzip, deflate) are undone first; a payload that breaks off is read as far as
  it goes, one that is stored without its coding as it is. A payload whose type is not
  text, or with another coding, has no conversion record, which its metadata says.

Both have ``WARC-Refers-To`` with the source's record id, its target URI and date,
digests of their own block, and ids derived from the source's, so that a lost task
run again writes the same records. Every row is made from one row: nothing is
shuffled, and records are as large as their page.

Edge cases: a null page is an empty payload, a null URL an empty target. Records of
another type, and rows that are no WARC record, have no derivatives. A header that
is missing is missing in the derivative. Payloads that are not UTF-8 are read with
U+FFFD for what cannot be decoded; a missing type counts as HTML. Lines of a head may
end in LF alone. Repeated rows have equal records, an empty table has none.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.llm.common import Batches, in_arrow

# The format's version, line end and the fields taken over.
VERSION = "WARC/1.0"
CRLF = b"\r\n"
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:veritable:warc")
# Media types that hold text without being called text.
_TEXTUAL = ("application/json", "application/xml", "application/xhtml+xml", "application/javascript", "application/ld+json", "application/rss+xml", "application/atom+xml")
_HIDDEN = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)")
_BLOCK = re.compile(
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html"
    r"|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
)
_HEAD_END = re.compile(rb"\r?\n\r?\n")
_TAG = re.compile(r"<[/!?a-zA-Z][^>]*>?")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join(parts))}>"


def record(fields: dict[str, str | None], block: bytes) -> bytes:
    """One record: version, named fields, an empty line, the block, two line ends."""
    named = [f"{name}: {_single_line(value)}" for name, value in fields.items() if value is not None]
    head = CRLF.join(line.encode() for line in [VERSION, *named, f"Content-Length: {len(block)}"])
    return head + CRLF + CRLF + block + CRLF + CRLF


def _single_line(value: str) -> str:
    return " ".join(value.split("\n")).replace("\r", " ")


def head_fields(data: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """First line, all fields in their order, and what follows the empty line."""
    ended = _HEAD_END.search(data)
    head, rest = (data[: ended.start()], data[ended.end() :]) if ended else (data, b"")
    first, *lines = re.split("\r?\n", head.decode(errors="replace"))
    fields: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and fields:
            name, value = fields[-1]
            fields[-1] = name, f"{value} {line.strip()}"
            continue
        name, colon, value = line.partition(":")
        if colon:
            fields.append((name.strip(), value.strip()))
    return first, fields, rest


def parse_head(data: bytes) -> tuple[str, dict[str, str], bytes]:
    """First line, fields by lower-case name, and what follows the empty line."""
    first, fields, rest = head_fields(data)
    return first, {name.lower(): value for name, value in fields}, rest


def response(url: str | None, body: str | None, key: str) -> bytes:
    """A response record of a page, with HTTP head."""
    payload = (body or "").encode()
    head = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload)]
    block = CRLF.join(head) + CRLF + CRLF + payload
    fields = {
        "WARC-Type": "response",
        "WARC-Record-ID": record_id("response", key, url or "", digest(payload)),
        "WARC-Date": DATE,
        "WARC-Target-URI": url or "",
        "WARC-Payload-Digest": digest(payload),
        "WARC-Block-Digest": digest(block),
        "Content-Type": "application/http; msgtype=response",
    }
    return record(fields, block)


def plain_text(payload: bytes, content_type: str = "text/html") -> str:
    """Text of a payload: markup dropped, references decoded, one line per block, no empty lines."""
    charset = re.search(r"charset=[\"']?([\w-]+)", content_type, re.IGNORECASE)
    try:
        text = payload.decode(charset[1] if charset else "utf-8", errors="replace")
    except LookupError:
        text = payload.decode(errors="replace")
    if "html" in content_type.lower():
        text = _TAG.sub("", _BLOCK.sub("\n", _HIDDEN.sub(" ", text)))
        text = html.unescape(text)
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def unchunked(payload: bytes) -> bytes:
    """The data of a chunked payload, as far as it goes; one that is not chunked (any more) stays as it is."""
    parts, at = [], 0
    while True:
        end = payload.find(b"\n", at)
        size = re.fullmatch(rb"([0-9a-fA-F]+)[ \t]*(?:;.*)?\r?", payload[at:end]) if end >= 0 else None
        if size is None:
            return b"".join(parts) if parts else payload
        length = int(size[1], 16)
        if not length:
            return b"".join(parts)
        parts.append(payload[end + 1 : end + 1 + length])
        at = end + 1 + length
        at += 2 if payload[at : at + 2] == CRLF else payload[at : at + 1] == b"\n"


def inflated(payload: bytes, coding: str) -> bytes | None:
    """The data of a gzip or deflate payload, as far as it goes; None for a coding that is not known."""
    if coding in ("", "identity"):
        return payload
    if coding not in ("gzip", "x-gzip", "deflate"):
        return None
    # Deflate is sent with and without its header; data may be stored inflated already.
    for bits in (47, -15) if coding == "deflate" else (47,):
        reader, made, rest = zlib.decompressobj(bits), b"", payload
        try:
            made = reader.decompress(rest)
            while reader.eof and reader.unused_data[:2] == b"\x1f\x8b":  # members follow each other
                rest, reader = reader.unused_data, zlib.decompressobj(bits)
                made += reader.decompress(rest)
            return made + reader.flush()
        except zlib.error:
            if made:
                return made
    return payload


def content(payload: bytes, fields: list[tuple[str, str]]) -> bytes | None:
    """The payload without its transfer and content codings, or None if one is not known."""

    def codings(name: str) -> list[str]:
        listed = ",".join(value for key, value in fields if key.lower() == name)
        return [coding.strip().lower() for coding in listed.split(",") if coding.strip()]

    # Each list is in the order applied, transfer codings after content codings.
    for coding in reversed(codings("content-encoding") + codings("transfer-encoding")):
        decoded = unchunked(payload) if coding == "chunked" else inflated(payload, coding)
        if decoded is None:
            return None
        payload = decoded
    return payload


def is_text(content_type: str) -> bool:
    media = content_type.partition(";")[0].strip().lower()
    return media.startswith("text/") or media in _TEXTUAL or media.endswith(("+json", "+xml"))


def derive(source: bytes | None) -> list[dict]:
    """The metadata and the conversion record of one response record."""
    version, fields, rest = parse_head(source or b"")
    if not version.startswith("WARC/") or fields.get("warc-type") != "response":
        return []
    size = fields.get("content-length", "")
    block = rest[: int(size)] if size.isdigit() else rest.removesuffix(CRLF + CRLF)
    status, sent, payload = head_fields(block)
    http = {name.lower(): value for name, value in sent}
    refers = fields.get("warc-record-id")
    linked = {
        "WARC-Date": fields.get("warc-date"),
        "WARC-Target-URI": fields.get("warc-target-uri"),
        "WARC-Refers-To": refers,
        "WARC-Refers-To-Target-URI": fields.get("warc-target-uri"),
        "WARC-Refers-To-Date": fields.get("warc-date"),
    }
    media = http.get("content-type") or "text/html"
    body = content(payload, sent) if is_text(media) else None
    kept = {
        "source-status": status,
        "source-content-type": http.get("content-type"),
        "source-content-length": str(len(payload)),
        "source-payload-digest": fields.get("warc-payload-digest") or digest(payload),
        "source-block-digest": fields.get("warc-block-digest") or digest(block),
        "source-last-modified": http.get("last-modified"),
        "source-language": http.get("content-language"),
        "conversion": None if body is not None else "none: the payload is not text" if not is_text(media) else "none: unknown coding",
    }
    named = [(k, v) for k, v in kept.items() if v is not None] + [("source-http-header", f"{k}: {v}") for k, v in sent]
    about = CRLF.join(f"{k}: {_single_line(v)}".encode() for k, v in named) + CRLF
    made = []
    wanted = [("metadata", "application/warc-fields", about)]
    if body is not None:
        wanted.append(("conversion", "text/plain", plain_text(body, media).encode()))
    for kind, media, body in wanted:
        own = {
            "WARC-Type": kind,
            "WARC-Record-ID": record_id(kind, refers or digest(block)),
            **linked,
            "WARC-Block-Digest": digest(body),
            "Content-Type": media,
        }
        made.append(
            {
                "record_type": kind,
                "record_id": own["WARC-Record-ID"],
                "refers_to": refers,
                "target_uri": linked["WARC-Target-URI"],
                "payload_digest": kept["source-payload-digest"],
                "block_digest": own["WARC-Block-Digest"],
                "content_length": len(body),
                "record": record(own, body),
            }
        )
    return made


def responses(pages: DataFrame) -> DataFrame:
    """(page_id, record): pages (page_id, url, html) as response records."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")))
            made = [response(url, body, str(key)) for key, url, body in rows]
            yield pa.record_batch({"page_id": batch.column("page_id"), "record": pa.array(made, pa.binary())})

    kept = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return in_arrow(kept, run, "page_id long, record binary")


_DERIVED = {
    "record_type": pa.string(),
    "record_id": pa.string(),
    "refers_to": pa.string(),
    "target_uri": pa.string(),
    "payload_digest": pa.string(),
    "block_digest": pa.string(),
    "content_length": pa.int64(),
    "record": pa.binary(),
}


def derivatives(records: DataFrame, key: str = "page_id") -> DataFrame:
    """The linked records of response ``records`` (``key``, record): key, type, ids, digests, record.

    The ``record`` column holds whole records, ready to be written one after another.
    """

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                piece = batch.slice(low, 256)
                made = [(i, r) for i, raw in enumerate(piece.column("record").to_pylist()) for r in derive(raw)]
                if made:
                    columns = [pa.array([r[name] for _, r in made], kind) for name, kind in _DERIVED.items()]
                    keys = piece.column(key).take(pa.array([i for i, _ in made]))
                    yield pa.RecordBatch.from_arrays([keys, *columns], [key, *_DERIVED])

    kept = records.select(key, "record")
    schema = ", ".join(f"{n} {'long' if k == pa.int64() else 'binary' if k == pa.binary() else 'string'}" for n, k in _DERIVED.items())
    return in_arrow(kept, run, f"`{key}` {kept.schema[0].dataType.simpleString()}, {schema}")
