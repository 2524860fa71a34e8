"""WARC derivatives: linked metadata and plain-text conversion records of HTTP responses.

Every response gives two records of WARC/1.1: a ``metadata`` record (title, links, source headers, digests, and the
identifier of the conversion) and a ``conversion`` record with the page's plain text. Both carry ``WARC-Refers-To`` with
the response's identifier, its target URI and date, and the digest of the payload that they were made from. Identifiers
are name-based UUIDs of the response's identifier and the record's kind, so that a retried task writes the same record.

The work is a narrow pass in bounded batches: no shuffle, and nothing of the table's size on the driver. Pages are read
by one scanner that moves forward only, so that hostile markup costs no more than its length.

Defined results: a null payload counts as empty and gives an empty text; a null URL leaves ``WARC-Target-URI`` and the
links' base out; a response without a date leaves ``WARC-Refers-To-Date`` out, and its records have the date that
``made`` gives, or none; repeated responses (ties) give repeated records with the same identifiers; null keys are carried;
payloads of any length are read whole; columns that are not asked for, and their names, do not matter; an empty table
gives no records. Markup that is not closed hides what follows only as the HTML standard has it: comments, scripts and
styles run to the end of the page; an unclosed tag is dropped.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks

VERSION = "WARC/1.1"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # for names that are URLs
#: Elements whose content is no text (fixed values of HTML), and those that stand on lines of their own.
HIDDEN = ("script", "style", "noscript", "template")
BLOCKS = frozenset(
    "address article aside blockquote br caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr li "
    "main nav ol p pre section table tbody td tfoot th thead title tr ul".split()
)

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_PLAIN = re.compile(r"[^=>]*")  # of a tag, up to a value or its end
_BLANK = re.compile(r"\s*")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in (*HIDDEN, "title")}
_SPACE = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Place after the ``>`` that closes the tag, outside of quoted values; -1 if there is none.

    ``last``: of each mark, its last place in the page; a quote after it is not closed and stands for itself.
    """
    while True:
        at = _PLAIN.match(page, at).end()
        if at >= len(page):
            return -1
        if page[at] == ">":
            return at + 1
        at = _BLANK.match(page, at + 1).end()
        if page[at : at + 1] in ("'", '"') and at < last[page[at]]:
            at = page.index(page[at], at + 1) + 1


def scan(page: str) -> Iterator[tuple[str, str, str]]:
    """The page in order as (kind, name, content): text; open and close tags, with the tag's inside.

    Comments, declarations and the content of ``HIDDEN`` elements are left out, each as one blank.
    """
    at, n = 0, len(page)
    last = {c: page.rfind(c) for c in "'\">"}
    closed: dict[str, int] = {}  # of each kind of end mark: no such mark from this place on

    def find_close(kind: str, start: int) -> tuple[int, int]:
        if kind not in closed:
            if kind == "-->":
                place = page.find("-->", start)
                if place >= 0:
                    return place, place + 3
            elif m := _CLOSE[kind].search(page, start):
                return m.start(), m.end()
            closed[kind] = start
        return -1, -1

    while at < n:
        mark = page.find("<", at)
        if mark < 0:
            yield "text", "", page[at:]
            return
        if mark > at:
            yield "text", "", page[at:mark]
        after = page[mark + 1 : mark + 2]
        if page.startswith("<!--", mark):
            _, at = find_close("-->", mark + 4)
            if at < 0:
                return
            yield "text", "", " "
        elif after in ("!", "?"):
            end = page.find(">", mark) if mark < last[">"] else -1
            if end < 0:
                return
            at = end + 1
        elif (m := _NAME.match(page, mark + 1 + (after == "/"))) is None:
            yield "text", "", "<"
            at = mark + 1
        else:
            name, kind = m[0].lower(), "close" if after == "/" else "open"
            end = _tag_end(page, m.end(), last) if mark < last[">"] else -1
            if end < 0:
                return
            inside = page[m.end() : end - 1]
            at = end
            if kind == "open" and name in HIDDEN and not inside.endswith("/"):
                close, _ = find_close(name, at)
                if close < 0:
                    return
                yield "text", "", " "
                end = _tag_end(page, close, last) if close < last[">"] else -1
                if end < 0:
                    return
                at = end
            else:
                yield kind, name, inside


@dataclass
class Page:
    title: str | None
    links: list[str]
    text: str


def read(page: str) -> Page:
    """Title, link targets and visible text of a page, in one pass; entities decoded, a line for every block."""
    text: list[str] = []
    links: list[str] = []
    title: str | None = None
    title_from = -1  # where the first title's content begins in ``text``
    for kind, name, content in scan(page.replace("\n", " ")):
        if kind == "text":
            text.append(content)
            continue
        if name == "title" and title is None:
            if kind == "open" and title_from < 0:
                title_from = len(text) + 1
            elif kind == "close" and title_from >= 0:
                title = html.unescape(" ".join("".join(text[title_from:]).split()))
        if name in BLOCKS:
            text.append("\n")
        if kind == "open" and name == "a":
            for m in _ATTRIBUTE.finditer(content):
                if m[1].lower() == "href" and (value := m[2] or m[3] or m[4]) is not None:
                    links.append(html.unescape(value).strip())
                    break
    return Page(title, links, _LINES.sub("\n", _SPACE.sub(" ", html.unescape("".join(text)))).strip())


def plain_text(page: str) -> str:
    return read(page).text


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>"


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record's bytes: version, named fields (those without a value are left out), block, two line ends."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def one_line(value: str | None) -> str | None:
    """A header value without line ends, which would start another header."""
    return None if value is None else re.sub(r"[\r\n]+", " ", value)


def derive(response_id: str, uri: str | None, date: str | None, headers: dict[str, str] | None, payload: str | None, made: str | None = None) -> list[dict]:
    """The metadata and the conversion record of one response. ``made``: their date, instead of the response's."""
    page = payload or ""
    source = digest(page.encode())
    target = one_line(uri)
    ids = {kind: record_id(f"{response_id} {kind}") for kind in ("metadata", "conversion")}
    found = read(page)
    links = []
    for href in found.links:
        try:
            links.append(urljoin(target or "", href))
        except ValueError:
            links.append(href)
    about = {"title": found.title, "links": links, "http-headers": headers or {}, "payload-digest": source, "payload-length": len(page.encode()), "conversion": ids["conversion"]}
    blocks = {"metadata": ("application/json", json.dumps(about, ensure_ascii=False, sort_keys=True).encode()), "conversion": ("text/plain", found.text.encode())}
    out = []
    for kind, (content_type, block) in blocks.items():
        own = digest(block)
        fields = [("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Date", made or date), ("WARC-Refers-To", response_id), ("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", date), ("WARC-Target-URI", target), ("WARC-Source-Payload-Digest", source), ("WARC-Block-Digest", own), ("Content-Type", content_type)]
        out.append({"warc_type": kind, "record_id": ids[kind], "refers_to": response_id, "target_uri": target, "content_type": content_type, "source_digest": source, "block_digest": own, "block_length": len(block), "record": record(fields, block)})
    return out


_SCHEMA = "warc_type string, record_id string, refers_to string, target_uri string, content_type string, source_digest string, block_digest string, block_length long, record binary"
_ARROW = pa.schema([("warc_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("content_type", pa.string()), ("source_digest", pa.string()), ("block_digest", pa.string()), ("block_length", pa.int64()), ("record", pa.binary())])


def _derive_batches(made: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "payload"):
            keys, rows = [], []
            for key, rid, uri, date, headers, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = derive(rid, uri, date, dict(headers or []), payload, made)
                rows += found
                keys += [key] * len(found)
            out = pa.RecordBatch.from_pylist(rows, schema=_ARROW)
            yield pa.record_batch([pa.array(keys, batch.schema.field(0).type), *out.columns], names=["key", *_ARROW.names])

    return run


def derivatives(responses: DataFrame, key: str, made: str | None = None) -> DataFrame:
    """Two records per response. ``responses``: key, record_id, uri, date (string), headers (map), payload (string).

    ``made`` (such as 2024-01-31T00:00:00Z) is the records' ``WARC-Date``; without it they have their response's.
    """
    bounded_batches(responses.sparkSession)
    rows = responses.select(F.col(key).alias("key"), "record_id", "uri", "date", "headers", "payload")
    return rows.mapInArrow(_derive_batches(made), f"key {responses.schema[key].dataType.simpleString()}, {_SCHEMA}").withColumnRenamed("key", key)


def responses_of_pages(pages: DataFrame, date: Column | None = None) -> DataFrame:
    """Response rows of the table ``pages`` (page_id, url, html), with HTTP headers for their type and length.

    The identifier is made of key, URL and payload, so that captures of one page that differ have unlike ones; rows
    that agree in all three are one capture. ``date``: when a page was captured, as the table does not say.
    """
    payload = F.coalesce("html", F.lit(""))
    h = F.md5(F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")), F.sha1(payload)))
    rid = F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))
    headers = F.create_map(F.lit("Content-Type"), F.lit("text/html; charset=utf-8"), F.lit("Content-Length"), F.octet_length(payload).cast("string"))
    when = F.lit(None) if date is None else date
    return pages.select("page_id", rid.alias("record_id"), F.col("url").alias("uri"), when.cast("string").alias("date"), headers.alias("headers"), F.col("html").alias("payload"))
