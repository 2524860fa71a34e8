"""Collocations per language: counts of all phrases that may be frequent, by a sketch and automata, and their weakest cut.

1. Tasks cut texts into pieces and words and pack the pieces, equal ones once with their number, into units of bounded size.
   Each unit adds its one- to three-word phrases to a count-min sketch with one row of cells, whose number grows with the
   text; counters stop at the threshold, which changes no answer. The sketch is shuffled by sections of cells and summed.
2. Each unit gets back those of its cells whose upper bound reaches the threshold. Its phrases in such cells (of two words and
   more: single words are counted as they are met) are compiled, for
   a bounded part of the unit at a time, into a pyahocorasick automaton of phrases between delimiters, which scans the part
   and counts overlapping matches. Spark sums the counts of all units and applies the threshold to the exact sums.
3. Cuts are looked up by joins in which parts that occur in many candidates are broadcast; scores are exact decimals.

Neither sketch nor candidates reach the driver or are held whole by any task.

Defined results: null text counts as empty and gives nothing; a null language is ``und``; texts and words of any length are
read whole (a piece of over ``LINE_WORDS`` words is cut with an overlap, whose own phrases are counted once less); repeated rows count
as often as they stand; ties in score go to the larger count, then to the phrase that is first in byte order; an empty table
gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_batches, join_back, own_worker, written

MIN_WORDS, MAX_WORDS = 2, 3
MIN_COUNT = 10
COVER_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
UNIT_BYTES = 16 << 20
#: Text that one automaton covers: bounds its size, as it holds no phrase from elsewhere.
PART_BYTES = 1 << 20
LINE_WORDS = 50_000
#: Wanted bytes of text a cell, sections at least, and the most cells of a section.
CELL_BYTES, SECTIONS, SECTION_BITS = 2, 10, 22
LOCAL_BITS = 24
#: Cells to a bucket of phrases, as a power of two.
BUCKET_BITS = 20

_LINES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")
_ODD = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_WORD_BITS = 21


class _Ids(dict):
    """Numbers of words in the order in which they are met; the end of a line is word 0."""

    def __init__(self):
        super().__init__({"\n": 0})

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def lines(text: str) -> Iterator[str]:
    """The words of each piece that has some, joined by single spaces."""
    for piece in text.encode().translate(_LINES).split(b"\n"):
        words = piece.split()
        if words:
            yield b" ".join(words).decode()


def counted(text: str, into: Counter) -> int:
    """Add a text's lines; bytes of lines that were not there. Long lines are cut, and what two cuts share counts once less."""
    new = 0
    for line in lines(text):
        parts = [line]
        if len(line) > 2 * LINE_WORDS and line.count(" ") >= LINE_WORDS:
            words, over = line.split(" "), MAX_WORDS - 1
            starts = range(0, max(1, len(words) - over), LINE_WORDS)
            parts = [" ".join(words[s : s + LINE_WORDS + over]) for s in starts]
            for s in starts[1:]:
                into[" ".join(words[s : s + over])] -= 1
        for part in parts:
            if part not in into:
                new += len(part)
            into[part] += 1
    return new


def cells_of(lang: str, ids: _Ids, words: np.ndarray, bits: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(m, places, cells) of all m-word phrases of a sequence of word numbers."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    h = np.fromiter((xxhash.xxh64_intdigest(w.encode(), seed) for w in ids), np.uint64, len(ids))
    out = []
    for m in range(1, MAX_WORDS + 1):
        n = max(0, len(words) - m + 1)
        inside = np.ones(n, dtype=bool)
        mixed = np.zeros(n, np.uint64)
        for k in range(m):
            inside &= words[k : k + n] > 0
            mixed += h[words[k : k + n]] * _ODD[k]
        at = np.flatnonzero(inside)
        mixed = mixed[at]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _MIX
        mixed ^= mixed >> np.uint64(29)
        out.append((m, at, mixed >> np.uint64(64 - bits)))
    return out


def _squeezed(body: bytes) -> bytes:
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _whole(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)


def _packed(numbers: np.ndarray, most: np.ndarray | None = None) -> bytes:
    """Ascending numbers as compressed planes of their steps' bytes, with one more byte for each."""
    steps = np.diff(numbers, prepend=0).astype("<u4")
    planes = steps.view(np.uint8).reshape(-1, 4).T.tobytes()
    body = planes + (b"" if most is None else most.astype(np.uint8).tobytes())
    return _squeezed(body)


def _unpacked(raw: bytes, more: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    body = np.frombuffer(_whole(raw), np.uint8)
    n = len(body) // (5 if more else 4)
    steps = body[: 4 * n].reshape(4, n).T.copy().view("<u4").ravel()
    return np.cumsum(steps, dtype=np.int64), body[4 * n :] if more else None


def units(docs: DataFrame, text: str, lang: str, bits: int, low: int, min_count: int) -> DataFrame:
    """Rows of units: their lines (lang, times, text, n words), and their cells by section with counts up to the threshold."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text")).where(F.length("text") > 0)
    names = ["unit", "lang", "times", "text", "n", "section", "cells"]
    schema = pa.schema([("unit", pa.int64()), ("lang", pa.string()), ("times", pa.int64()), ("text", pa.binary()), ("n", pa.int64()), ("section", pa.int64()), ("cells", pa.binary())])

    def closed(unit: int, held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        packed = []
        for name, found in held.items():
            by_times: dict[int, list[str]] = {}
            for line, times in found.items():
                if times:
                    by_times.setdefault(times, []).append(line)
            for times, some in by_times.items():
                body = " \n ".join(some)
                n = times * (body.count(" ") + 1 - (len(some) - 1))
                yield pa.RecordBatch.from_pylist([{"unit": unit, "lang": name, "times": times, "text": _squeezed(f" {body} ".encode()), "n": n}], schema)
                for part in _parts(f" {body} ") if times > 0 else ():
                    ids = _Ids()
                    words = np.fromiter(map(ids.__getitem__, part.strip(" ").split(" ")), np.int64)
                    packed += [(cells << np.uint64(4)) | np.uint64(min(times, min_count)) for _, _, cells in cells_of(name, ids, words, bits)]
        if not packed:
            return
        v = np.concatenate(packed)
        del packed
        v.sort()
        cells = v >> np.uint64(4)
        first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, int)
        counts = np.minimum(np.add.reduceat((v & np.uint64(15)).astype(np.int64), first), min_count) if len(first) else first
        cells = cells[first].astype(np.int64)
        sections = cells >> low
        cuts = np.flatnonzero(np.diff(sections, prepend=-1))
        out = {"section": [], "cells": []}
        for lo, hi in zip(cuts, [*cuts[1:], len(cells)], strict=True):
            out["section"].append(int(sections[lo]))
            out["cells"].append(_packed(cells[lo:hi] & ((1 << low) - 1), counts[lo:hi]))
        none = {n: pa.nulls(len(cuts), schema.field(n).type) for n in ("lang", "times", "text", "n")}
        columns = none | {"unit": pa.array([unit] * len(cuts), pa.int64()), "section": pa.array(out["section"], pa.int64()), "cells": pa.array(out["cells"], pa.binary())}
        yield pa.RecordBatch.from_arrays([columns[n] for n in names], schema=schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("collocations")
        unit, held, size = TaskContext.get().partitionId() << 32, {}, 0
        for batch in batches:
            for name, body in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                size += counted(body.as_py(), held.setdefault(name, Counter()))
                if size >= UNIT_BYTES:
                    yield from closed(unit, held)
                    unit, held, size = unit + 1, {}, 0
        if held:
            yield from closed(unit, held)

    return rows.mapInArrow(pack, "unit bigint, lang string, times bigint, text binary, n bigint, section bigint, cells binary")


def frequent_cells(sketch: DataFrame, low: int, min_count: int) -> DataFrame:
    """Per unit and section: the unit's cells whose total over all units reaches the threshold."""

    def summed(section: pa.Table) -> pa.Table:
        total = np.zeros(1 << low, np.uint8)
        for raw in section["cells"]:
            at, counts = _unpacked(raw.as_py(), more=True)
            total[at] = np.minimum(total[at] + counts, min_count)
        out = []
        for raw in section["cells"]:
            at, _ = _unpacked(raw.as_py(), more=True)
            out.append(_packed(at[total[at] >= min_count]))
        return pa.table({"unit": section["unit"], "section": section["section"], "cells": pa.array(out, pa.binary())})

    return sketch.groupBy("section").applyInArrow(summed, "unit bigint, section bigint, cells binary")


def _parts(text: str) -> Iterator[str]:
    """The text in parts of about ``PART_BYTES`` characters, cut between lines."""
    at = 0
    while at < len(text):
        end = text.find(" \n ", at + PART_BYTES)
        end = len(text) if end < 0 else end + 1
        yield text[at:end]
        at = end + 1 if end < len(text) else end


def scan_part(lang: str, text: str, bits: int, candidate: np.ndarray) -> dict[str, int]:
    """Counts of the phrases of a text that may be frequent, by an automaton of them over the text."""
    ids = _Ids()
    words = np.fromiter(map(ids.__getitem__, text.strip(" ").split(" ")), np.int64)
    names, phrases, out = list(ids), [], {}
    low = (1 << _WORD_BITS) - 1
    for m, at, cells in cells_of(lang, ids, words, bits):
        at = at[candidate[(cells & np.uint64(len(candidate) - 1)).astype(np.int64)]]
        if m == 1:  # single words are counted as they were numbered
            numbers, counts = np.unique(words[at], return_counts=True)
            out = dict(zip([names[i] for i in numbers.tolist()], counts.tolist(), strict=True))
            continue
        key = np.zeros(len(at), np.int64)
        for k in range(m):
            key = (key << _WORD_BITS) | words[at + k]
        key = np.unique(key)
        columns = [[names[i] for i in ((key >> (_WORD_BITS * (m - 1 - k))) & low).tolist()] for k in range(m)]
        phrases += map(" ".join, zip(*columns, strict=True))
    if not phrases:
        return out
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, phrase in enumerate(phrases):
        automaton.add_word(f" {phrase} ", i)
    automaton.make_automaton()
    hits = np.bincount(np.fromiter(map(itemgetter(1), automaton.iter(text)), np.int64), minlength=len(phrases))
    return out | dict(zip(phrases, hits.tolist(), strict=True))


def phrase_counts(units_table: DataFrame, cells: DataFrame, bits: int, low: int, min_count: int) -> DataFrame:
    """lang, phrase, m and f of all phrases of one to three words that stand at least ``min_count`` times in a language."""

    buckets = 1 << max(SECTIONS, bits - BUCKET_BITS)

    def scan(body: pa.Table, passed: pa.Table) -> pa.Table:
        own_worker("collocations")
        candidate = np.zeros(1 << min(bits, LOCAL_BITS), dtype=bool)
        for section, raw in zip(passed["section"].to_pylist(), passed["cells"], strict=True):
            at, _ = _unpacked(raw.as_py())
            candidate[((section << low) | at) & (len(candidate) - 1)] = True
        total: dict[str, Counter] = {}
        for row in range(body.num_rows):
            name, times = body["lang"][row].as_py(), body["times"][row].as_py()
            found = total.setdefault(name, Counter())
            for part in _parts(_whole(body["text"][row].as_py()).decode()):
                for phrase, n in scan_part(name, part, bits, candidate).items():
                    found[phrase] += n * times
        out = {"bucket": [], "lang": [], "counts": []}
        for name, found in total.items():
            phrases = sorted(found)
            seed = xxhash.xxh64_intdigest(name.encode())
            at = np.fromiter((xxhash.xxh64_intdigest(p.encode(), seed) & (buckets - 1) for p in phrases), np.int64, len(phrases))
            order = at.argsort(kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(at[order])) + 1) if len(order) else ():
                mine = [phrases[i] for i in some.tolist()]
                out["bucket"].append(int(at[some[0]]))
                out["lang"].append(name)
                out["counts"].append(_squeezed("\n".join([*mine, ",".join([str(found[p]) for p in mine])]).encode()))
        return pa.table({"bucket": pa.array(out["bucket"], pa.int64()), "lang": pa.array(out["lang"], pa.string()), "counts": pa.array(out["counts"], pa.binary())})

    def summed(bucket: pa.Table) -> pa.Table:
        own_worker("collocations")
        parts = []
        for name, raw in zip(bucket["lang"].to_pylist(), bucket["counts"], strict=True):
            *phrases, counts = _whole(raw.as_py()).decode().split("\n")
            parts.append(pa.table({"lang": pa.repeat(pa.scalar(name), len(phrases)), "phrase": pa.array(phrases, pa.string()), "n": pa.array(list(map(int, counts.split(","))), pa.int64())}))
        total = pa.concat_tables(parts).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        total = total.filter(pc.greater_equal(total["n_sum"], min_count))
        return pa.table({"lang": total["lang"], "phrase": total["phrase"], "f": total["n_sum"]})

    # Counts travel in buckets of phrases, sorted and compressed: a third of the bytes that rows would take.
    found = units_table.groupBy("unit").cogroup(cells.groupBy("unit")).applyInArrow(scan, "bucket bigint, lang string, counts binary")
    f = found.groupBy("bucket").applyInArrow(summed, "lang string, phrase string, f bigint")
    return f.withColumn("m", F.size(F.split("phrase", " ")))


def _part(k: Column, after: bool) -> Column:
    """The words of ``phrase`` up to word k, or those after it."""
    words = F.split("phrase", " ")
    return F.array_join(F.slice(words, k + 1, F.size(words) - k) if after else F.slice(words, F.lit(1), k), " ")


def scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of candidates: of the cuts the one that scores least, then the one with fewest words before it."""
    key = lambda part: F.concat(F.col("lang"), F.lit("\n"), part)
    rows = written(candidates.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")), "cuts")
    n_rows = rows.count()
    parts = counts.where(F.col("m") < MAX_WORDS).select(key(F.col("phrase")).alias("part"), "f")
    for after, name in ((False, "l"), (True, "r")):
        keyed = rows.withColumn("part", key(_part(F.col("k"), after)))
        sized = keyed.groupBy("part").agg(F.count("*").alias("size")).join(parts.withColumnRenamed("f", name), "part")
        rows = join_back(keyed, sized, "part", "size", n_rows).drop("part", "size")
    exact = lambda c: F.col(c).cast("decimal(18,0)")
    top = (exact("a") * exact("a")).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)")
    rows = rows.withColumn("top", top).withColumn("bottom", exact("l") * exact("r")).withColumn("score", F.expr("top div bottom"))
    least = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return rows.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covered(counts: DataFrame) -> DataFrame:
    """lang, phrase and the largest count of a longer candidate around it."""
    words = F.split("phrase", " ")
    inner = [F.when((F.col("m") > n) & (F.col("m") >= n + s), F.array_join(F.slice(words, s + 1, n), " ")) for n in range(MIN_WORDS, MAX_WORDS) for s in range(MAX_WORDS - n + 1)]
    return counts.where(F.col("m") > MIN_WORDS).select("lang", F.explode(F.array_distinct(F.array_compact(F.array(*inner)))).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def best(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language, ranked; a language's rows are cut down in many tasks before they meet."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    for salts in (1024, 16, 1):
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.drop("salt")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, percent: int = COVER_PERCENT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases. Calling it runs all but the last step."""
    if not 1 <= min_count <= 15:
        raise ValueError("counters of the sketch hold thresholds from 1 to 15")
    bounded_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string"))).alias("n")).first().n or 0
    bits = max(16, (size // CELL_BYTES).bit_length())
    low = min(SECTION_BITS, bits - SECTIONS)
    table = written(units(docs, text, lang, bits, low, min_count), "units")
    cells = frequent_cells(table.where(F.col("section").isNotNull()).select("unit", "section", "cells"), low, min_count)
    lined = table.where(F.col("section").isNull())
    counts = written(phrase_counts(lined.select("unit", "lang", "times", "text"), cells, bits, low, min_count), "phrases")
    own = counts.where(F.col("m") >= MIN_WORDS).join(covered(counts), ["lang", "phrase"], "left")
    rows = scored(own.where(~F.coalesce(100 * F.col("longer") >= percent * F.col("f"), F.lit(False))), counts)
    total = lined.groupBy("lang").agg(F.sum("n").alias("n"))
    return best(rows, top).join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
