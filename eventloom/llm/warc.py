"""WARC derivatives: plain-text conversion and metadata records for response records.

A response row has ``record_id`` (a WARC-Record-ID without its angle brackets), ``target_uri``, ``date``, ``block`` (the HTTP
message as bytes), ``block_digest`` and ``payload_digest`` (``sha1:`` and base 32). For each response there are

* a ``metadata`` record (application/warc-fields) with every HTTP header of the source, its digests as they
  were given, whether they hold, and the identifier of the conversion, and
* for a textual payload, a ``conversion`` record with the page's plain text.

Both refer to the response by WARC-Refers-To, its URI and date; the metadata record also names the conversion by
WARC-Concurrent-To. Identifiers follow from the response's, so a second run gives the same records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.pages import plain_text
from eventloom.llm.shared import prepare

DATE = "1970-01-01T00:00:00Z"
RESPONSES = (
    "page_id long, record_id string, target_uri string, date string, block binary, block_digest string, payload_digest string"
)
_FIELDS = [
    ("page_id", pa.int64()),
    ("record_id", pa.string()),
    ("type", pa.string()),
    ("refers_to", pa.string()),
    ("concurrent_to", pa.string()),
    ("target_uri", pa.string()),
    ("date", pa.string()),
    ("content_type", pa.string()),
    ("block", pa.binary()),
    ("block_digest", pa.string()),
    ("source_block_digest", pa.string()),
    ("source_payload_digest", pa.string()),
    ("record", pa.binary()),
]
DERIVED = (
    "page_id long, record_id string, type string, refers_to string, concurrent_to string, target_uri string, date string, "
    "content_type string, block binary, block_digest string, source_block_digest string, source_payload_digest string, "
    "record binary"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def identifier(*parts: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, "\0".join(parts)).urn


def clean(value: str) -> str:
    """A header's value on one line."""
    return " ".join(value.split())


def serialise(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One WARC/1.1 record; headers without a value are left out."""
    lines = ["WARC/1.1", *(f"{k}: {clean(v)}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of consecutive records, gzipped or not."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(headers["Content-Length"])
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 8 + size


def message(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP message; one without a header end is all payload."""
    head, found, payload = block.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"HTTP/"):
        return "", [], block
    status, *lines = head.decode("latin-1").split("\r\n")
    headers = [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in lines) if k.strip()]
    return status, headers, payload


def decoded(payload: bytes, headers: dict[str, str]) -> bytes:
    """The payload without transfer and content encoding, as far as it can be undone."""
    if "chunked" in headers.get("transfer-encoding", "").lower():
        out, at = [], 0
        while (end := payload.find(b"\r\n", at)) >= 0:
            try:
                size = int(payload[at:end].split(b";")[0], 16)
            except ValueError:
                break
            if not size:
                break
            out.append(payload[end + 2 : end + 2 + size])
            at = end + 4 + size
        payload = b"".join(out)
    coding = headers.get("content-encoding", "").lower()
    if coding in ("gzip", "x-gzip", "deflate"):
        reader = zlib.decompressobj(47 if "gzip" in coding else 15)
        try:
            payload = reader.decompress(payload) + reader.flush()
        except zlib.error:
            return b""
    return payload


def _responses(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "record_id", "target_uri", "date", "block", "block_digest", "payload_digest"]
        for batch in batches:
            rows = []
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                payload = html.encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                block, own = head.encode() + payload, digest(payload)
                rows.append((page, identifier("response", str(page), url or "", own), url, date, block, digest(block), own))
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            kinds = [pa.int64(), *[pa.string()] * 3, pa.binary(), *[pa.string()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of web pages (``page_id, url, html``). Null html is an empty payload; a null url stays null."""
    prepare(pages.sparkSession)
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"),
    )
    return rows.mapInArrow(_responses(date), RESPONSES)


def _derive(row: dict) -> Iterator[tuple]:
    source, block = row["record_id"] or "", row["block"] or b""
    status, headers, payload = message(block)
    kinds = {k.lower(): v for k, v in headers}
    kind = kinds.get("content-type", "" if headers else "text/html")
    link = f"<{source}>"
    common = [
        ("WARC-Refers-To", link),
        ("WARC-Refers-To-Target-URI", row["target_uri"]),
        ("WARC-Refers-To-Date", row["date"]),
        ("WARC-Target-URI", row["target_uri"]),
        ("WARC-Date", row["date"]),
    ]

    def record(name: str, type_: str, content: str, data: bytes, with_: str | None) -> tuple:
        own = digest(data)
        lines = [("WARC-Type", type_), ("WARC-Record-ID", f"<{name}>"), *common]
        lines += [("WARC-Concurrent-To", with_ and f"<{with_}>"), ("WARC-Block-Digest", own), ("Content-Type", content)]
        whole = serialise(lines, data)
        place = (row["target_uri"], row["date"])
        given = (row["block_digest"], row["payload_digest"])
        return (row["page_id"], name, type_, source, with_, *place, content, data, own, *given, whole)

    text = None
    if kind.split(";")[0].strip().lower() in ("text/html", "application/xhtml+xml", "text/plain"):
        charset = kind.lower().partition("charset=")[2].split(";")[0].strip(" \"'") or "utf-8"
        try:
            text = decoded(payload, kinds).decode(charset, "replace")
        except LookupError:
            text = decoded(payload, kinds).decode("utf-8", "replace")
        if not kind.lower().startswith("text/plain"):
            text = plain_text(text)
    conversion = identifier("conversion", source) if text is not None else None
    fields = [
        ("refers-to", link),
        ("conversion", conversion and f"<{conversion}>"),
        ("source-block-digest", row["block_digest"]),
        ("source-payload-digest", row["payload_digest"]),
        ("source-block-digest-holds", row["block_digest"] and str(row["block_digest"] == digest(block)).lower()),
        ("source-payload-digest-holds", row["payload_digest"] and str(row["payload_digest"] == digest(payload)).lower()),
        ("source-content-length", str(len(block))),
        ("source-status", status or None),
        *((f"source-header-{k}", v) for k, v in headers),
    ]
    data = "".join(f"{k}: {clean(v)}\r\n" for k, v in fields if v is not None).encode()
    yield record(identifier("metadata", source), "metadata", "application/warc-fields", data, conversion)
    if text is not None:
        yield record(conversion, "conversion", "text/plain; charset=utf-8", text.encode(), None)


def _derived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            rows = [x for row in batch.slice(at, 100).to_pylist() for x in _derive(row)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(_FIELDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, (_, k) in zip(columns, _FIELDS, strict=True)], [n for n, _ in _FIELDS]
            )


def derivatives(found: DataFrame) -> DataFrame:
    """Metadata and conversion records of response rows, as columns and as ``record``, the WARC bytes.

    A null block is empty; it has a metadata record and an empty conversion. Null digests, dates and URIs are left out of
    the records. A payload that is not text, or whose encoding cannot be undone, has no or an empty
    conversion. Repeated responses give repeated records. No responses: no rows. Other columns are ignored.
    """
    prepare(found.sparkSession)
    names = ["page_id", "record_id", "target_uri", "date", "block", "block_digest", "payload_digest"]
    return found.select(*(found[n] for n in names)).mapInArrow(_derived, DERIVED)
