"""Collocations against counts in plain dictionaries."""

import re
from collections import Counter

import cases
import pytest

from tilewise.llm import collocations
from tilewise.llm.queries import QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least=10, percent=50, top=2000):
    f, n, out = Counter(), Counter(), []
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in (1, 2, 3):
                f.update((lang or "und", tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    for lang in n:
        rows = []
        known = {p: a for (name, p), a in f.items() if name == lang and len(p) > 1 and a >= least}
        for p, a in known.items():
            if any(100 * b >= percent * a for q, b in known.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").repartition(3)


ROWS = [
    *[("en", "New York is big, new york\tIS far; the the the the the")] * 9,
    *[(None, "New York. new\nyork é x É x New York")] * 8,
    *[("fr", "a b c d. a b c d a b, a b x")] * 12,
    *[("und", "new york new york")] * 3,
    ("de", None),
    ("de", ""),
    ("de", " ,;. \t"),
    ("en", "zz " * 5000 + "yy zz"),
    ("tr\nx", "p q " * 20),
]


@pytest.mark.parametrize("units", [16 << 20, 100])
def test_counts_and_scores(spark, monkeypatch, units):
    monkeypatch.setattr(collocations, "UNIT_BYTES", units)
    assert found(collocations.collocations(frame(spark, ROWS))) == plain(ROWS)


def test_long_pieces_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LINE_WORDS", 5)
    monkeypatch.setattr(collocations, "PART_BYTES", 64)
    rows = [("en", " ".join(f"w{(i * i) % 7}" for i in range(1000))), ("en", "a a a a a a a a a a a a a a"), ("en", "w1 w2 " * 11)]
    assert found(collocations.collocations(frame(spark, rows))) == plain(rows)


def test_crowded_sketch_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CELL_BYTES", 10**9)
    monkeypatch.setattr(collocations, "LOCAL_BITS", 8)
    assert found(collocations.collocations(frame(spark, ROWS), min_count=2)) == plain(ROWS, 2)


def test_top_of_each_language(spark):
    assert found(collocations.collocations(frame(spark, ROWS), min_count=3, top=2)) == plain(ROWS, 3, top=2)


def test_query_on_edge_cases(spark, tables):
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{tables[0]}/documents.parquet").select("lang", "text").collect()]
    assert found(QUERIES["op13_collocations"](spark, tables[0])) == plain(docs)


def test_thresholds_beyond_the_counters_raise(spark):
    with pytest.raises(ValueError):
        collocations.collocations(frame(spark, ROWS), min_count=16)


def test_edge_texts_are_there():
    assert any(t and len(t) > 100000 for t in cases.TEXTS)
