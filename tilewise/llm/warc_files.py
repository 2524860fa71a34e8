"""Response records of WARC files, plain or compressed record by record, as rows for ``warc.derivatives``.

Each file is read as a stream by one task, in batches of bounded size; files are opened by Arrow's file systems.

Defined results: records of other types, and responses that are not HTTP, are left out; a header that stands twice has its values
joined by commas; bodies are unchunked and uncompressed (gzip, deflate) and decoded by the charset that their type names, else as
UTF-8, with replacement of what does not decode; a body whose compression is broken is taken as it is. ``digest_ok`` is null
where the record gives no SHA-1 of its payload. An empty file has no rows; one that is cut short, or is no WARC file, raises.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from base64 import b32encode
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

from .common import CHUNK_BYTES, own_worker

SCHEMA = "file string, record_id string, uri string, date string, status int, headers map<string,string>, payload string, digest_ok boolean"
_ARROW = pa.schema([("file", pa.string()), ("record_id", pa.string()), ("uri", pa.string()), ("date", pa.string()), ("status", pa.int32()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.string()), ("digest_ok", pa.bool_())])


def fields(lines: list[bytes]) -> dict[str, str]:
    """Header fields by name; folded lines go on with the value before."""
    out: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in b" \t" and last is not None:
            out[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            continue
        last = name.strip().decode("utf-8", "replace")
        text = value.strip().decode("utf-8", "replace")
        out[last] = f"{out[last]}, {text}" if last in out else text
    return out


def records(stream: BinaryIO, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields with names in lower case, block) of each record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: a WARC record expected but {line[:40]!r} found")
        lines = []
        while (line := stream.readline()).strip():
            lines.append(line.rstrip(b"\r\n"))
        head = {k.lower(): v for k, v in fields(lines).items()}
        size = int(head.get("content-length", "-1"))
        block = stream.read(size) if size >= 0 else b""
        if not line or len(block) != size:
            raise ValueError(f"{name}: a record is cut short")
        yield head, block


def unchunked(body: bytes) -> bytes:
    """The body of chunked transfer; what is no chunk ends it."""
    out, stream = [], io.BytesIO(body)
    while line := stream.readline():
        try:
            size = int(line.split(b";")[0], 16)
        except ValueError:
            break
        if size == 0:
            break
        out.append(stream.read(size))
        stream.readline()
    return b"".join(out)


def uncompressed(body: bytes, coding: str) -> bytes:
    try:
        if coding in ("gzip", "x-gzip"):
            return gzip.decompress(body)
        return zlib.decompress(body) if coding == "deflate" else body
    except (OSError, EOFError, zlib.error):
        return body


def charset(content_type: str) -> str:
    for part in content_type.split(";")[1:]:
        name, _, value = part.partition("=")
        if name.strip().lower() == "charset":
            try:
                "".encode(value.strip(" \"'"))
                return value.strip(" \"'")
            except (LookupError, ValueError):
                break
    return "utf-8"


def response(name: str, head: dict[str, str], block: bytes) -> dict | None:
    """The row of a record, or None if it is no HTTP response."""
    if head.get("warc-type", "").lower() != "response" or not block.startswith(b"HTTP/"):
        return None
    top, _, body = block.partition(b"\r\n\r\n")
    status, *lines = top.split(b"\r\n")
    own = fields(lines)
    low = {k.lower(): v for k, v in own.items()}
    wanted = head.get("warc-payload-digest", "")
    found = "sha1:" + b32encode(hashlib.sha1(body).digest()).decode()
    if "chunked" in low.get("transfer-encoding", "").lower():
        body = unchunked(body)
    body = uncompressed(body, low.get("content-encoding", "").strip().lower())
    code = status.split()[1:2]
    ok = wanted.upper() == found.upper() if wanted.lower().startswith("sha1:") else None
    return {"file": name, "record_id": head.get("warc-record-id"), "uri": head.get("warc-target-uri"), "date": head.get("warc-date"), "status": int(code[0]) if code and code[0].isdigit() else None, "headers": list(own.items()), "payload": body.decode(charset(low.get("content-type", "")), "replace"), "digest_ok": ok}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own_worker("warc files")
    for batch in batches:
        for path in batch.column(0).to_pylist():
            fs, at = pyarrow.fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
            name, held, size = path.rsplit("/", 1)[-1], [], 0
            with fs.open_input_stream(at, compression=None) as raw:
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if name.endswith(".gz") else io.BufferedReader(raw)
                for head, block in records(stream, name):
                    row = response(name, head, block)
                    if row is None:
                        continue
                    if held and size + len(block) > CHUNK_BYTES:
                        yield pa.RecordBatch.from_pylist(held, _ARROW)
                        held, size = [], 0
                    held.append(row)
                    size += len(block)
            if held:
                yield pa.RecordBatch.from_pylist(held, _ARROW)


def responses(spark: SparkSession, path: str) -> DataFrame:
    """The HTTP responses of the WARC files below ``path``: a file is one task's, as compressed records cannot be found from its middle."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc*").load(path).select("path")
    return files.repartition("path").mapInArrow(_read, SCHEMA)
