"""The registered queries: against SQL where there is some, against plain Python otherwise, on edge cases and on sf0.001."""

import hashlib
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import plain
import public_tokenizers
import pytest
from compare import assert_same, connect

from tilewise.llm.queries import ORACLES, QUERIES


def documents(spark, path):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]


def result(spark, path, name, *columns):
    return Counter(tuple(r) for r in QUERIES[name](spark, path).select(*columns).collect())


@pytest.fixture(params=["edge cases", "sf0.001"])
def path(request, tables, sf_dir):
    return tables[0] if request.param == "edge cases" else sf_dir


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, sf_dir, name):
    assert_same(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, tables, name):
    assert QUERIES[name](spark, tables[1]).count() == 0


def test_op1(spark, path):
    windows = plain.windows_of([(r.item_id, r.text) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()])
    expected = Counter()
    for doc_id, text in documents(spark, path):
        hit, items = plain.hits(text, windows)
        expected[doc_id, len(plain.words(text)), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)] += 1
    assert result(spark, path, "op1_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == expected


def test_op2(spark, path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = sorted(documents(spark, path), key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    expected, start = Counter(), 0
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        expected[doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())] += 1
        start += len(ids)
    assert result(spark, path, "op2_token_shards", "doc_id", "start", "n_tokens", "ids_crc32") == expected


def test_op3_edge_cases(spark, tables):
    got = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in QUERIES["op3_url_filter"](spark, tables[0]).collect()}
    assert got[1, "www.example.com", "/en/1"] == ("www.example.com/en/", "allow")
    assert got[2, "blog.example.com", "/en/2"] == ("example.com/en/", "block")
    assert got[3, "a.example.net", "/es/3"] == ("net/es/", "block")
    assert got[4, "xnet", "/es/3"] == (None, "allow")
    assert got[5, "", ""] == got[6, "", ""] == (None, "allow")
    assert got[7, "spam-farm.example.org", "/"] == (None, "block")
    assert got[8, "notspam-farming.example.org", "/a"] == (None, "allow")
    assert got[9, "foo.com", ""] == (None, "allow")
    assert got[10, "foo.com", "/"] == ("com/", "allow")
    assert got[11, "net", "/fr/"] == ("net/fr/", "block")
    assert got[12, "a.net", "/fr"] == got[13, "a.net:80", "/fr/"] == (None, "allow")
    assert got[14, "example.com", "/en/"] == ("example.com/en/", "block")
    assert sum(1 for _ in QUERIES["op3_url_filter"](spark, tables[0]).collect()) == len(cases.PAGES)


def test_op3_index_finds_what_running_every_rule_finds(spark, tables, sf_dir):
    import random
    import re

    from tilewise.llm import url_filter

    rng = random.Random(4)
    parts = [*url_filter.TOPICS, *url_filter.SEGMENTS, *url_filter.FILE_TYPES, "a", "news", "x-y", "com", "net", "org", "en", "es", "fr", "example", "www", "Login", "PHPSESSID", "K"]
    urls = [r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()] + [p[1] for p in cases.PAGES]
    for _ in range(3000):
        host = rng.choice([".".join(rng.choices(parts, k=rng.randint(1, 4))), "-".join(rng.choices(parts, k=2)) + ".org", "news.org", "A.x-y.info", "a.net", "foo.COM"])
        path = "".join(f"/{rng.choice(parts)}{rng.choice(['', '', '.' + rng.choice(parts), '-1'])}" for _ in range(rng.randint(0, 3))) + rng.choice(["", "/"])
        query = rng.choice(["", "", "", f"?{rng.choice(parts)}=1", "?a=b&sid=3", "?action=edit", "?x=1&action=editor", "?q=/casino/", "#/login", "?print=1#t"])
        urls.append(rng.choice(["http", "https", "HTTP"]) + "://" + host + path + query)
    rules = url_filter.BASE_RULES + url_filter.METHOD_RULES
    assert len(rules) > 130 and all(len(some) < 8 for some in url_filter.rarest_tokens(rules).values())
    got = {r.i: r.url_verdict for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "i int, url string")).collect()}
    seen = Counter()
    for i, u in enumerate(urls):
        rest = u.partition("://")[2] if u and "://" in u else ""
        host, path, query = re.fullmatch(r"([^/?#]*)([^?#]*)(\?[^#]*)?(?:#.*)?", rest, re.S).groups("")
        host = plain.ascii_lower(host)
        fits = [r for r in rules if re.search(r.pattern.replace(r"\z", r"\Z"), host + path + query if r.base else plain.ascii_lower(host + path + query))]
        best = max(fits, key=lambda r: (r.priority, r.name), default=None)
        expected = (host, path, best.name if best and best.base else None, best.verdict if best else "allow", best.name if best else None)
        assert tuple(got[i]) == expected, u
        seen[best.name.split()[0] if best else None] += 1
    assert all(seen[k] > 20 for k in ("host", "path", "file", "query", "com/", None)), dict(seen)


def test_op3_many_rules_and_a_clashing_name(spark):
    from tilewise.llm import url_filter

    rules = url_filter.BASE_RULES + tuple(url_filter.host_word_rule(f"bad{i}-site") for i in range(5000))
    pages = spark.createDataFrame([(i, f"http://a.bad{i}-site.org/") for i in range(4990, 5010)], "page_id int, url string")
    assert {r.page_id: r.v.verdict for r in url_filter.judge(pages, rules=rules, result="v").collect()} == {i: "block" if i < 5000 else "allow" for i in range(4990, 5010)}
    assert {r.v.verdict for r in url_filter.judge(pages, rules=(), result="v").collect()} == {"allow"}
    with pytest.raises(ValueError, match="column"):
        url_filter.judge(pages.withColumn("URL_verdict", pages.url))


def test_op4_records_are_linked(spark, tables):
    import base64

    rows = QUERIES["op4_warc_derivatives"](spark, tables[0]).collect()
    pages = Counter((p[0], p[1]) for p in cases.PAGES)
    assert len(rows) == 2 * len(cases.PAGES)
    html = defaultdict(set)
    for i, u, h in cases.PAGES:
        html[i, u].add("sha1:" + base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode())
    for r in rows:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        block = rest[: int(fields["Content-Length"])]
        assert len(rest) == len(block) + 4 and r.block_length == len(block)
        assert fields["WARC-Block-Digest"] == r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        assert fields["WARC-Refers-To"] == r.refers_to and fields["WARC-Type"] == r.warc_type and fields["WARC-Record-ID"] == r.record_id
        assert fields.get("WARC-Target-URI") == r.target_uri and r.source_digest in html[r.page_id, r.target_uri]
    by = Counter((r.page_id, r.target_uri, r.warc_type) for r in rows)
    assert all(by[i, u, t] == n for (i, u), n in pages.items() for t in ("metadata", "conversion"))


def test_op4_equals_a_plain_parser(spark, sf_dir):
    """Records rebuilt from the pages with the standard library's parser."""
    import base64
    import html
    import json
    import uuid
    from html.parser import HTMLParser
    from urllib.parse import urljoin

    from tilewise.llm import warc

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=False)
            self.out, self.links, self.hidden, self.title, self.in_title = [], [], 0, None, False

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in warc.HIDDEN
            self.in_title |= tag == "title"
            self.out += ["\n"] * (tag in warc.BLOCKS)
            if tag == "a" and dict(attrs).get("href") is not None:
                self.links.append(dict(attrs)["href"].strip())

        def handle_endtag(self, tag):
            self.hidden -= tag in warc.HIDDEN
            self.in_title &= tag != "title"
            self.out += ["\n"] * (tag in warc.BLOCKS)

        def add(self, text):
            if not self.hidden:
                self.out.append(text)
                if self.in_title:
                    self.title = (self.title or "") + text

        def handle_data(self, data):
            self.add(data.replace("\n", " "))

        def handle_entityref(self, name):
            self.add(html.unescape(f"&{name};"))

        def handle_charref(self, name):
            self.add(html.unescape(f"&#{name};"))

        def handle_comment(self, data):
            self.out.append(" ")

    sha1 = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    rows = QUERIES["op4_warc_derivatives"](spark, sf_dir).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == 2 * len(pages)
    for r in rows:
        page = pages[r.page_id]
        raw = (page.html or "").encode()
        name = hashlib.md5(f"{page.page_id} {page.url or ''} {hashlib.sha1(raw).hexdigest()}".encode()).hexdigest()
        assert r.refers_to == f"<urn:uuid:{uuid.UUID(name)}>" and r.source_digest == sha1(raw)
        assert r.record_id == f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{r.refers_to} {r.warc_type}')}>"
        plain = Plain()
        plain.feed(page.html or "")
        plain.close()
        body = bytes(r.record).partition(b"\r\n\r\n")[2][: r.block_length]
        assert r.block_digest == sha1(body)
        if r.warc_type == "conversion":
            assert [" ".join(x.split()) for x in "".join(plain.out).split("\n") if x.strip()] == body.decode().split("\n")
        else:
            about = json.loads(body)
            assert about["links"] == [urljoin(page.url or "", x) for x in plain.links] and about["payload-length"] == len(raw)
            assert about["title"] == (None if plain.title is None else " ".join(plain.title.split()))


def test_op4_hostile_pages_take_time_in_proportion():
    import time

    from tilewise.llm import warc

    marks = ["<!--", "<a ", "<script ", "<script>", "<a href='", "</", "<", "<!", "<title>", "<a x=", "<script></scrip ", "<p/", "<!-- -->", "<a b  ="]
    for mark in marks:
        for end in ("", ">", "'>", '">'):
            began = time.process_time()
            warc.read(mark * ((1 << 20) // len(mark)) + end)
            assert time.process_time() - began < 5
    assert warc.plain_text("a<script>b") == warc.plain_text("a<!-- b") == warc.plain_text("a<p title='") == "a"
    assert warc.plain_text("<p it's>a</p> <p title='x>y'>b") == "a\nb" and warc.plain_text("1 < 2 <3") == "1 < 2 <3"


def test_op4_captures_have_identifiers_of_their_own(spark):
    from tilewise.llm import warc

    pages = spark.createDataFrame([(1, "http://a/", "x", "r"), (1, "http://a/", "y", "s"), (1, "http://a/", "y", "t"), (None, None, None, None)], "page_id long, url string, html string, record_id string")
    rows = warc.derivatives(warc.responses_of_pages(pages), "page_id").collect()
    assert len(rows) == 8 and len({r.record_id for r in rows}) == 6
    assert all(b"WARC-Date" not in bytes(r.record) and b"WARC-Refers-To-Date" not in bytes(r.record) for r in rows)
    made = warc.derivatives(warc.responses_of_pages(pages), "page_id", "2024-01-31T00:00:00Z").collect()
    assert all(b"\r\nWARC-Date: 2024-01-31T00:00:00Z\r\n" in bytes(r.record) and b"WARC-Refers-To-Date" not in bytes(r.record) for r in made)


def test_op4_text_and_links():
    import json

    from tilewise.llm import warc

    meta, text = warc.derive("<urn:x>", cases.PAGES[0][1], None, {"Content-Type": "text/html"}, cases.PAGES[0][2])
    body = lambda r: r["record"].partition(b"\r\n\r\n")[2][: r["block_length"]].decode()
    assert body(text) == "A & B\nHi\none\ntwo\nl"
    about = json.loads(body(meta))
    assert about["links"] == ["https://www.example.com/x?a=1&b=2"] and about["title"] == "A & B"
    assert about["conversion"] == text["record_id"] and about["http-headers"] == {"Content-Type": "text/html"}
    assert warc.plain_text("plain < text > & more &lt;b&gt;") == "plain < text > & more <b>"


def test_op5_edge_cases(spark, tables):
    groups = defaultdict(list)
    for doc_id, text in documents(spark, tables[0]):
        groups[text or ""].append(doc_id)
    expected = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            kept = i == keep and first
            first = first and not kept
            expected[i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert result(spark, tables[0], "op5_exact_dedup", "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected


def test_op5_in_parts_gives_the_same(spark, path, monkeypatch):
    from tilewise.llm import exact_dedup

    expected = result(spark, path, "op5_exact_dedup", "doc_id", "keep_id", "group_size", "kept")
    monkeypatch.setattr(exact_dedup, "PART_ROWS", 12 if path.endswith("some0") else 60)
    assert result(spark, path, "op5_exact_dedup", "doc_id", "keep_id", "group_size", "kept") == expected


def test_op6(spark, path):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = Counter((i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in documents(spark, path))
    assert result(spark, path, "op6_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == expected


def test_op7(spark, path):
    import tiktoken

    from tilewise.llm.bpe_codec import read_ranks

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    expected = Counter()
    for i, t in documents(spark, path):
        ids = library.encode_ordinary(t or "")
        expected[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert result(spark, path, "op7_bpe_round_trip", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected


def test_op8_edge_cases(spark, tables):
    phrases = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
    got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in QUERIES["op8_license_scan"](spark, tables[0]).collect()}
    expected = set()
    for i, t in documents(spark, tables[0]):
        w = plain.words(t)
        at = [(k, label) for p, label in phrases for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        places = [k for k, _ in at]
        expected.add((i, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))))
    assert got == expected
    labels = {r.doc_id: r.labels for r in QUERIES["op8_license_scan"](spark, tables[0]).collect()}
    assert labels[18] == "cc-by-nc" and labels[17] == "apache,gpl,mit" and labels[7] == ""


def test_op9(spark, sf_dir, tables):
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op9_language_id"](spark, sf_dir).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == truth[r.doc_id][0] for r in rows if r.held_out]
    assert sum(held) / len(held) >= 0.97
    edge = QUERIES["op9_language_id"](spark, tables[0]).collect()
    text = dict(documents(spark, tables[0]))
    assert len(edge) == len(cases.rows())
    for r in edge:
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text[r.doc_id] or ""))


def test_op10(spark, path):
    docs = documents(spark, path)
    prints = [plain.fingerprint(t) for _, t in docs]
    roots = plain.components(prints)
    low = {}
    for (i, _), k in zip(docs, roots, strict=True):
        if i is not None:
            low[k] = min(low.get(k, i), i)
    expected = Counter((i, f"{f:016x}", low.get(k)) for (i, _), f, k in zip(docs, prints, roots, strict=True))
    assert result(spark, path, "op10_simhash", "doc_id", "fingerprint", "component_id") == expected
