"""Real WARC files: written by hand, read as responses, and turned into derivatives."""

import gzip
import hashlib
import json
from base64 import b32encode

import pytest
from pyspark.sql import functions as F

from tilewise.llm import warc, warc_files


def sha1(body):
    return "sha1:" + b32encode(hashlib.sha1(body).digest()).decode()


def record(kind, block, **more):
    head = {"WARC-Type": kind, "WARC-Date": "2020-02-03T04:05:06Z", "Content-Length": str(len(block))} | {k.replace("_", "-"): v for k, v in more.items()}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def http(body, *lines, status="200 OK"):
    return "\r\n".join([f"HTTP/1.1 {status}", *lines]).encode() + b"\r\n\r\n" + body


PAGE = "<html><head><title>Té</title></head><body><a href='/x'>link</a> text</body></html>"


def some_records():
    latin, utf = PAGE.encode("latin-1"), PAGE.encode()
    packed = gzip.compress(utf, mtime=0)
    chunked = b"".join(f"{len(p):x};ext\r\n".encode() + p + b"\r\n" for p in (utf[:10], utf[10:])) + b"0\r\n\r\n"
    return [
        record("warcinfo", b"software: x\r\n"),
        record("request", b"GET / HTTP/1.1\r\n\r\n"),
        record("response", http(latin, "Content-Type: text/html; charset=ISO-8859-1", "X-A: 1", "X-A: 2"), WARC_Record_ID="<urn:a>", WARC_Target_URI="http://a/", WARC_Payload_Digest=sha1(latin)),
        record("response", http(packed, "Content-Type: text/html", "Content-Encoding: gzip"), WARC_Record_ID="<urn:b>", WARC_Target_URI="http://b/", WARC_Payload_Digest=sha1(utf)),
        record("response", http(chunked, "Transfer-Encoding: chunked", "X-Folded: one", "  two", status="404 Not Found"), WARC_Record_ID="<urn:c>", WARC_Target_URI="http://c/"),
        record("response", http(b"not gzip", "Content-Encoding: gzip", "Content-Type: text/plain; charset=no-such"), WARC_Record_ID="<urn:d>", WARC_Target_URI="http://d/"),
        record("response", b"\x00\x01dns", WARC_Record_ID="<urn:e>"),
        record("response", http(b""), WARC_Record_ID="<urn:f>"),
    ]


def test_responses_and_their_derivatives(spark, tmp_path):
    parts = some_records()
    (tmp_path / "deep").mkdir()
    (tmp_path / "one.warc").write_bytes(b"".join(parts[:4]))
    (tmp_path / "deep" / "two.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts[4:]))
    (tmp_path / "none.warc").write_bytes(b"")
    (tmp_path / "other.txt").write_bytes(b"no")
    rows = warc_files.responses(spark, str(tmp_path))
    got = {r.record_id: r for r in rows.collect()}
    assert {k: (r.status, r.payload, r.digest_ok, r.uri) for k, r in got.items()} == {
        "<urn:a>": (200, PAGE, True, "http://a/"),
        "<urn:b>": (200, PAGE, False, "http://b/"),
        "<urn:c>": (404, PAGE, None, "http://c/"),
        "<urn:d>": (200, "not gzip", None, "http://d/"),
        "<urn:f>": (200, "", None, None),
    }
    assert got["<urn:a>"].headers["X-A"] == "1, 2" and got["<urn:c>"].headers["X-Folded"] == "one two" and got["<urn:c>"].file == "two.warc.gz"
    made = warc.derivatives(rows.withColumn("key", F.monotonically_increasing_id()), "key").where("refers_to = '<urn:a>' and warc_type = 'metadata'").first()
    text = bytes(made.record).decode()
    assert "WARC-Refers-To-Date: 2020-02-03T04:05:06Z" in text and "WARC-Refers-To: <urn:a>" in text and made.source_digest == sha1(PAGE.encode())
    about = json.loads(text.split("\r\n\r\n")[1])
    assert about["title"] == "Té" and about["links"] == ["http://a/x"] and about["http-headers"]["X-A"] == "1, 2"


@pytest.mark.parametrize("raw", [b"no warc\r\n", some_records()[2][:-30], b"WARC/1.1\r\nWARC-Type: response\r\n\r\n", b"WARC/1.1\r\nContent-Length: 5"])
def test_broken_files_raise(spark, tmp_path, raw):
    (tmp_path / "x.warc").write_bytes(raw)
    with pytest.raises(Exception, match="cut short|expected"):
        warc_files.responses(spark, str(tmp_path)).collect()


def test_large_files_come_in_batches(spark, tmp_path, monkeypatch):
    body = b"x" * 100_000
    (tmp_path / "x.warc").write_bytes(b"".join(record("response", http(body), WARC_Record_ID=f"<urn:{i}>") for i in range(200)))
    assert warc_files.responses(spark, str(tmp_path)).agg(F.count("*"), F.sum(F.length("payload"))).first() == (200, 200 * 100_000)
