"""WARC derivative builder: response records to metadata and conversion records.

Sources are either captured pages (``derive_records``), of which each becomes
a ``response`` record of HTTP headers and the page's bytes, or a table of WARC
response records (``derive_from_responses``), whose ids, dates, HTTP headers
and digests are kept as they are. From a response the builder derives, row by
row and without a shuffle,

* a ``metadata`` record (``application/warc-fields``): title, language,
  outlinks (absolute, in page order), and the source's HTTP status, headers,
  payload digest and length;
* a ``conversion`` record (``text/plain``): the visible text of the page.

The response is part of the output, and both others name it in
``WARC-Refers-To`` and keep its target URI, date and payload digest. Record ids
are UUIDs taken from a hash of the record type, page_id, URL and payload (for
given responses: of the type and the response's id), so a rerun or a retried
task gives the same records.

Pages are scanned in linear time: one pass over the tags, attributes inside
each tag, and end marks found by searches that never look back.

Edge cases: a null or empty page gives an empty payload, an empty text and no
links; a null URL is written as an empty target URI, and links stay as they
are; a null page_id counts as the empty text in the ids; unclosed tags,
comments and scripts end with the page; rows that repeat page_id, URL and page
are the same capture and give equal records; a response without an id gets one
from its content, one without a payload digest gets the digest of its payload,
a null or malformed response record gives no rows; an empty table gives no
records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.llm.common import ship_package

CAPTURE_DATE = "1970-01-01T00:00:00Z"
HTTP_HEADERS = (("Content-Type", "text/html; charset=utf-8"),)
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tributary:warc")

#: A comment's start, or the start of a tag up to its name.
_START = re.compile(r"<(?:(!--)|(/?)([A-Za-z][^\s/>]*)|[!?/])")
#: One attribute; every character of a tag belongs to one match.
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>\"'][^\s>]*)))?|[\s=/\"'>]+")
_LANGUAGE_NAME = re.compile(r"[A-Za-z0-9-]+")
_HIDDEN = ("script", "style", "noscript", "template")
_ENDS = {n: re.compile(rf"</{n}\s*+>", re.I) for n in (*_HIDDEN, "title")}
_BREAKS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section table td th tr ul title".split()
)


class _Ends:
    """First end mark of a kind at or after a place; places only grow, so each
    kind searches the page once in all."""

    def __init__(self, page: str):
        self.page = page
        self.found: dict[str, tuple[int, int]] = {}

    def after(self, name: str, at: int) -> tuple[int, int]:
        place = self.found.get(name)
        if place is None or place[0] < at:
            if name in _ENDS:
                end = _ENDS[name].search(self.page, at)
                place = end.span() if end else (len(self.page), len(self.page))
            else:
                start = self.page.find(name, at)
                place = (start, start + len(name)) if start >= 0 else (len(self.page), len(self.page))
            self.found[name] = place
        return place


def scan(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, content) of a page in order: ``text`` with the text between
    tags, ``open`` and ``close`` with a tag's attributes, ``hidden`` for
    comments, scripts and the like."""
    ends, at = _Ends(page), 0
    while at < len(page):
        tag = _START.search(page, at)
        if tag is None:
            yield "text", "", page[at:]
            return
        if tag.start() > at:
            yield "text", "", page[at : tag.start()]
        if tag[1]:
            at = ends.after("-->", tag.end())[1]
            yield "hidden", "!--", ""
            continue
        close = ends.after(">", tag.end())
        name, at = (tag[3] or "").lower(), close[1]
        if tag[2] or not name:
            yield "close", name, ""
        elif name in _HIDDEN:
            at = ends.after(name, at)[1]
            yield "hidden", name, ""
        else:
            yield "open", name, page[tag.end() : close[0]]


def attribute(tag: str, name: str) -> str | None:
    """The first value of an attribute of a tag's text."""
    for found in _ATTRIBUTE.finditer(tag):
        if found[1] and found[1].lower() == name and found.lastindex > 1:
            return found[found.lastindex]
    return None


def page_text(page: str) -> str:
    """Visible text: one line per block, blanks collapsed, entities decoded."""
    parts = []
    for kind, name, content in scan(page):
        if kind == "text":
            parts.append(content)
        elif kind == "hidden":
            parts.append(" ")
        elif name in _BREAKS:
            parts.append("\n")
    shown = "".join(parts)
    if "&" in shown:
        shown = html.unescape(shown)
    return "\n".join(line for line in (" ".join(x.split()) for x in shown.split("\n")) if line)


def _one_line(text: str) -> str:
    return " ".join(html.unescape(text).split())


def _absolute(base: str, link: str) -> str:
    try:
        return urljoin(base, link)
    except ValueError:
        return link  # not a URL that can be joined


def page_fields(page: str, url: str) -> tuple[str, str, list[str]]:
    """Title, language and outlinks of a page."""
    title, language, links, inside = None, None, [], False
    for kind, name, content in scan(page):
        if kind == "text" and inside:
            title.append(content)
        elif kind == "open" and name == "a":
            link = attribute(content, "href")
            if link is not None:
                links.append(_absolute(url, _one_line(link)))
        elif kind == "open" and name == "html" and language is None:
            code = _LANGUAGE_NAME.match(attribute(content, "lang") or "")
            language = code[0] if code else None
        elif name == "title":
            inside = kind == "open" and title is None
            title = [] if inside else title
    return _one_line("".join(title or ())), language or "", links


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()  # noqa: S324 - the format's digest


def record_id(kind: str, page_id: object, url: str, payload_digest: str) -> str:
    name = f"{kind}|{'' if page_id is None else page_id}|{url}|{payload_digest}"
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>"


def serialise(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC/1.1 record."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def http_block(payload: bytes) -> bytes:
    headers = [*HTTP_HEADERS, ("Content-Length", str(len(payload)))]
    return ("HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n").encode() + payload


def response(page_id: object, url: str | None, page: str | None, date: str = CAPTURE_DATE) -> dict:
    """The response record of a captured page."""
    url, payload = " ".join((url or "").split()), (page or "").encode()
    block, payload_digest = http_block(payload), digest(payload)
    rid = record_id("response", page_id, url, payload_digest)
    headers = [
        ("WARC-Type", "response"), ("WARC-Record-ID", rid), ("WARC-Target-URI", url), ("WARC-Date", date),
        ("WARC-Payload-Digest", payload_digest), ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return {
        "record_id": rid, "url": url, "date": date, "headers": headers, "block": block, "page_id": page_id,
        "payload_digest": payload_digest,
    }


def parse_response(record: bytes | None, page_id: object = None) -> dict | None:
    """The response of a WARC record's bytes, with its headers as they are;
    None for records of other types and what is not a record."""
    head, mark, rest = (record or b"").partition(b"\r\n\r\n")
    lines = head.decode("utf-8", errors="replace").split("\r\n")
    headers = [(k.strip(), v.strip()) for k, colon, v in (x.partition(":") for x in lines[1:]) if colon]
    told = {k.lower(): v for k, v in headers}
    size = told.get("content-length", "")
    if not mark or not lines[0].startswith("WARC/") or told.get("warc-type") != "response" or not size.isdecimal():
        return None
    block = rest[: int(size)]
    if len(block) < int(size):
        return None
    url = told.get("warc-target-uri", "").removeprefix("<").removesuffix(">")
    payload_digest = told.get("warc-payload-digest") or digest(block.partition(b"\r\n\r\n")[2])
    rid = told.get("warc-record-id") or record_id("response", page_id, url, payload_digest)
    return {
        "record_id": rid, "url": url, "date": told.get("warc-date", CAPTURE_DATE), "block": block, "page_id": page_id,
        "headers": [h for h in headers if h[0].lower() != "content-length"], "payload_digest": payload_digest, "given": True,
    }


def derivatives(source: dict) -> list[dict]:
    """The response record and its metadata and conversion records."""
    head, _, payload = source["block"].partition(b"\r\n\r\n")
    page = payload.decode("utf-8", errors="replace")
    payload_digest = source["payload_digest"]
    title, language, links = page_fields(page, source["url"])
    fields = [("title", title), ("language", language)]
    status, *http = head.decode("utf-8", errors="replace").split("\r\n")
    fields += [("source-http-status", status)]
    fields += [("source-http-header", line) for line in http]
    fields += [("source-payload-digest", payload_digest), ("source-payload-length", str(len(payload)))]
    fields += [("outlink", link) for link in links]
    text = page_text(page)
    same = {"page_id": source["page_id"], "target_uri": source["url"], "source_payload_digest": payload_digest, "n_links": len(links)}
    out = [
        same | {
            "record_type": "response", "record_id": source["record_id"], "refers_to": None,
            "block_digest": digest(source["block"]), "content_length": len(source["block"]),
            "record": serialise(source["headers"], source["block"]),
        }
    ]
    for kind, content_type, block in (
        ("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields).encode()),
        ("conversion", "text/plain; charset=utf-8", text.encode()),
    ):
        if source.get("given"):
            rid = f"<urn:uuid:{uuid.uuid5(_NAMESPACE, kind + '|' + source['record_id'])}>"
        else:
            rid = record_id(kind, source["page_id"], source["url"], payload_digest)
        headers = [
            ("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Refers-To", source["record_id"]),
            ("WARC-Target-URI", source["url"]), ("WARC-Date", source["date"]),
            *([("WARC-Source-Payload-Digest", payload_digest)] if kind == "conversion" else []),
            ("WARC-Block-Digest", digest(block)), ("Content-Type", content_type),
        ]
        out.append(
            same | {
                "record_type": kind, "record_id": rid, "refers_to": source["record_id"], "block_digest": digest(block),
                "content_length": len(block), "record": serialise(headers, block),
            }
        )
    return out


def derive_records(pages: DataFrame, date: str = CAPTURE_DATE, digests_only: bool = False) -> DataFrame:
    """Three rows per page (response, metadata, conversion): the record's headers
    as columns and, as ``record``, its bytes; with ``digests_only`` the bytes are
    replaced by ``record_sha256``. ``date`` is the captures' date."""
    return _derived(pages.select("page_id", "url", "html"), lambda i, u, h: response(i, u, h, date), digests_only)


def derive_from_responses(records: DataFrame, digests_only: bool = False) -> DataFrame:
    """The same for a table of WARC records (page_id, record): three rows per response."""
    return _derived(records.select("page_id", "record"), lambda i, r: parse_response(r, i), digests_only)


def _derived(sources: DataFrame, made: Callable[..., dict | None], digests_only: bool) -> DataFrame:
    ship_package(sources.sparkSession)
    kind = dict(sources.dtypes)["page_id"]
    last = "record_sha256 string" if digests_only else "record binary"
    schema = f"page_id {kind}, record_type string, record_id string, refers_to string, target_uri string, source_payload_digest string, block_digest string, content_length long, n_links int, {last}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        for batch in batches:
            types = types or [batch.schema.types[0], *[pa.string()] * 6, pa.int64(), pa.int32(), pa.string() if digests_only else pa.binary()]
            found = (made(*(c.as_py() for c in cells)) for cells in zip(*batch.columns, strict=True))
            rows = [r for source in found if source is not None for r in derivatives(source)]
            names = ["page_id", "record_type", "record_id", "refers_to", "target_uri", "source_payload_digest", "block_digest", "content_length", "n_links"]
            columns = [[r[c] for r in rows] for c in names]
            if digests_only:
                columns.append([hashlib.sha256(r["record"]).hexdigest() for r in rows])
            else:
                columns.append([r["record"] for r in rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=[*names, "record_sha256" if digests_only else "record"],
            )

    return sources.mapInArrow(run, schema)
