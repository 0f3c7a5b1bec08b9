"""WARC derivatives: a metadata and a conversion record for each response.

A response (URL and HTML, with optional headers and date) becomes two records
that refer to it: ``metadata`` with the page's title, language, links and the
source's headers, and ``conversion`` with its plain text. Both keep the
response's record id, target URI, date and payload digest, and carry digests of
their own blocks. One Arrow pass; no shuffle.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm import common

#: The date of responses that have none.
NO_DATE = "1970-01-01T00:00:00Z"
_OPENS = re.compile(r"<!--|<(script|style|noscript|template)\b[^<>]*>", re.I)
_CLOSES = {kind: re.compile(rf"</{kind}\s*>", re.I) for kind in ("script", "style", "noscript", "template")}
_BREAK = re.compile(r"<(?:br|hr)\b[^<>]*>|</?(?:p|div|h[1-6]|li|ul|ol|table|tr|article|section|nav|header|footer|blockquote|pre|title|body|head)\b[^<>]*>", re.I)
_CELL = re.compile(r"</?t[dh]\b[^<>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z!?][^<>]*>")
_BLANK, _LINES = re.compile(r"[^\S\n]+"), re.compile(r"\s*\n\s*")
_TITLE, _TITLE_END = re.compile(r"<title\b[^<>]*>", re.I), re.compile(r"</title\s*>", re.I)
_HTML_LANG = re.compile(r"<html\b[^<>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I)
_LINK = re.compile(r"<a\b[^<>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122


def sha1(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def seen(page: str) -> str:
    """The page without comments, scripts, styles, templates and what is for readers without scripts.

    Comments, scripts and styles that are not closed go on to the end; of a
    template or noscript element that is not closed only the tag is unseen. Each
    part of the page is looked at once for each kind of element at most.
    """
    out, at, endless = [], 0, set()
    while m := _OPENS.search(page, at):
        kind = m[1].lower() if m[1] else None
        if kind is None:  # a comment may be as short as <!-->
            end = page.find("-->", m.start() + 2)
            end = end + 3 if end >= 0 else len(page)
        else:
            close = None if kind in endless else _CLOSES[kind].search(page, m.end())
            if close is None:
                endless.add(kind)
            end = close.end() if close else len(page) if kind in ("script", "style") else m.end()
        out.append(page[at : m.start()])
        at = end
    return " ".join([*out, page[at:]])


def plain_text(page: str) -> str:
    """What a reader of the page sees, blocks on lines of their own."""
    page = _BREAK.sub("\n", seen(page))
    page = entities.unescape(_TAG.sub("", _CELL.sub(" ", page)))
    return _LINES.sub("\n", _BLANK.sub(" ", page)).strip()


def _line(value: str) -> str:
    """A value that can stand in one header line."""
    return re.sub(r"\s+", " ", value).strip()


def response_id(page_id: int | None, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id} {url}')}>"


def derive(page_id: int | None, url: str | None, html: str | None, headers: str | None = None, date: str | None = None, record_id: str | None = None, payload_digest: str | None = None) -> list[dict]:
    """The two records of one response; the digest of its payload, if it is not given, is that of the page in UTF-8."""
    url, page, date = _line(url or ""), html or "", date or NO_DATE
    payload = page.encode("utf-8", "surrogatepass")
    source, payload_digest = record_id or response_id(page_id, url), payload_digest or sha1(payload)
    visible = seen(page)
    title = visible[m.end() : end.start()] if (m := _TITLE.search(visible)) and (end := _TITLE_END.search(visible, m.end())) else ""
    lang = m[1] if (m := _HTML_LANG.search(visible)) else ""
    fields = [("title", _line(entities.unescape(_TAG.sub("", title)))), ("language", lang), ("payload-length", str(len(payload)))]
    fields += [("source-header", _line(h)) for h in (headers or "").splitlines() if h.strip()]
    fields += [("outlink", _line(entities.unescape(a or b or c))) for a, b, c in _LINK.findall(visible)]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields)
    out = []
    for kind, content_type, block in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", plain_text(page))):
        raw = block.encode("utf-8", "surrogatepass")
        out.append(
            {
                "page_id": page_id, "record_type": kind, "record_id": f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{source} {kind}')}>", "refers_to": source, "target_uri": url, "warc_date": date,
                "content_type": content_type, "content_length": len(raw), "block_digest": sha1(raw), "source_payload_digest": payload_digest, "block": block,
            }
        )
    return out


def to_bytes(record: dict) -> bytes:
    """A record as it stands in a WARC 1.1 file."""
    block = record["block"].encode("utf-8", "surrogatepass")
    head = [
        ("WARC-Type", record["record_type"]), ("WARC-Record-ID", record["record_id"]), ("WARC-Date", record["warc_date"]), ("WARC-Target-URI", record["target_uri"]),
        ("WARC-Refers-To", record["refers_to"]), ("WARC-Refers-To-Target-URI", record["target_uri"]), ("WARC-Refers-To-Date", record["warc_date"]),
        ("WARC-Source-Payload-Digest", record["source_payload_digest"]), ("WARC-Block-Digest", record["block_digest"]), ("Content-Type", record["content_type"]), ("Content-Length", str(len(block))),
    ]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(stream: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record in WARC bytes."""
    at = 0
    while at < len(stream):
        end = stream.index(b"\r\n\r\n", at)
        version, *lines = stream[at:end].decode().split("\r\n")
        if not version.startswith("WARC/1."):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
        size = int(head["Content-Length"])
        yield head, stream[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def pages_of(stream: bytes) -> Iterator[dict]:
    """The responses in WARC bytes (plain, or gzip members), as rows for :func:`derivatives`."""
    if stream[:2] == b"\x1f\x8b":
        stream = gzip.decompress(stream)
    for head, block in parse(stream):
        head = {k.lower(): v for k, v in head.items()}
        if head.get("warc-type") != "response":
            continue
        top, _, payload = block.partition(b"\r\n\r\n")
        _, *headers = top.decode("latin-1").split("\r\n")
        declared = next((m[1] for h in headers if h.lower().startswith("content-type:") and (m := re.search(r"charset=[\"']?([\w-]+)", h, re.I))), "utf-8")
        try:
            page = payload.decode(declared, "replace")
        except LookupError:  # no such character set
            page = payload.decode("utf-8", "replace")
        yield {
            "page_id": None, "url": head.get("warc-target-uri", "").strip("<>"), "html": page, "headers": "\r\n".join(headers), "date": head.get("warc-date"), "record_id": head.get("warc-record-id"),
            "payload_digest": head.get("warc-payload-digest") or sha1(payload),
        }


_PAGES = "page_id long, url string, html string, headers string, date string, record_id string, payload_digest string"


def responses(files: DataFrame) -> DataFrame:
    """The responses in WARC files (``content``, as the binaryFile source reads them), as pages for :func:`derivatives`.

    Payloads are decoded by the character set that their headers name, else as
    UTF-8; bytes that can't be decoded are replaced. Record ids, dates, headers
    and payload digests are kept; other kinds of records are passed over. A file
    that is no WARC file fails the job.
    """
    kinds = [pa.int64()] + [pa.string()] * 6
    names = [x.split()[0] for x in _PAGES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in common.column(batch, "content"):
                rows = list(pages_of(content.as_py() or b""))
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, kinds, strict=True)], names=names)

    return files.select("content").mapInArrow(run, _PAGES)


_SCHEMA = "page_id long, record_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, content_length long, block_digest string, source_payload_digest string, block string"
_ARROW = [(x.split()[0], pa.int64() if x.endswith("long") else pa.string()) for x in _SCHEMA.split(", ")]


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, "html"):
        rows = [r for x in batch.to_pylist() for r in derive(**x)]
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in _ARROW], names=[n for n, _ in _ARROW])


def derivatives(pages: DataFrame) -> DataFrame:
    """Two records for each row of ``pages`` (page_id, url, html; headers, date, record_id and payload_digest if there are any).

    A response without a record id gets one from its page_id and URL, the same
    each time; without a date it gets ``NO_DATE``. Null URLs and pages count as
    empty: their records are there, with an empty block. Repeated rows make
    repeated records. White space within header values becomes one space, so
    that no value breaks out of its line. Pages are read whole; unclosed
    scripts, styles and comments are no text. Other columns are ignored.
    """
    common.lean(pages.sparkSession)
    optional = [F.col(c).cast("string").alias(c) if c in pages.columns else F.lit(None).cast("string").alias(c) for c in ("headers", "date", "record_id", "payload_digest")]
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", *optional).mapInArrow(_derive, _SCHEMA)
