"""Benchmark decontamination with an FM-index per shard of the training texts.

A shard (a bounded slice of a batch, equal texts once) becomes one sequence of word symbols: benchmark words by number,
every other word and every end of a text as a separator. Its suffixes are sorted by prefix doubling, its
Burrows-Wheeler transform is held in a wavelet matrix, and all phrases step backward through the matrix ranks together.
Occurrences are located by walking to sampled suffix positions; the words they cover merge into removal spans.

A phrase ("window") is any ``WINDOW`` consecutive words of an item, or the whole item where it has fewer. Executors cut the
items into windows and pack those into blocks of about ``BLOCK_BYTES`` of benchmark text, by the hash of window and item, so
that no item or window is too large for a block. The driver only hands the packed blocks on, one after the other, as
broadcasts; a shard is searched for each block in turn and holds one of them.

Words are told apart by 64-bit hashes of their bytes (a chance of 10^-4 for one confusion among 10^9 different words of a
corpus and 10^6 of a benchmark).

Defined results: a null or empty text has no words and is never contaminated; an item without words has no phrases; items
without an id count as one item named ``null``, rows that repeat an item_id count as one item; repeated documents, and
documents with equal or null keys, are judged alike and each by itself; texts of any length are read whole, one longer than a
shard is a shard of its own; other columns are carried or left out and may have any name; with an empty benchmark nothing is
contaminated; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, own_worker, text_or_empty

WINDOW = 10
SAMPLE_EVERY = 32
SHARD_BYTES = 6 << 20
BLOCK_BYTES = 4 << 20

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _byte_table() -> np.ndarray:
    """Of each UTF-8 byte: itself with A-Z lower-cased if it is part of a word, else 0."""
    b = np.arange(256)
    lower = np.where((b >= 65) & (b <= 90), b + 32, b)
    is_word = (b >= 0x80) | ((lower >= 0x30) & (lower <= 0x39)) | ((lower >= 0x61) & (lower <= 0x7A))
    return np.where(is_word, lower, 0).astype(np.uint8)


_TABLE = _byte_table()


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 4096), _PRIME, dtype=np.uint64)]), dtype=np.uint64)
    return _POWERS


def hash_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of concatenated texts: (64-bit hashes, first bytes, bytes after the last). ``bounds``: ends of the texts."""
    low = _TABLE[data]
    inside = low > 0
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[0], edge[-1] = len(data) > 0 and inside[0], len(data) > 0 and inside[-1]
    if len(data) > 1:
        edge[1:-1] = inside[1:] != inside[:-1]
    cut = bounds[(bounds > 0) & (bounds < len(data))]
    joined = np.unique(cut[inside[cut] & inside[cut - 1]]) if len(cut) else cut  # words that touch where texts meet
    at = np.flatnonzero(edge)
    starts, ends = at[0::2], at[1::2]
    if len(joined):
        starts, ends = np.sort(np.concatenate([starts, joined])), np.sort(np.concatenate([ends, joined]))
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts, ends
    size = ends - starts
    flat = low[inside].astype(np.uint64)
    begins = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.arange(len(flat)) - np.repeat(begins, size)
    return _finish(np.add.reduceat((flat + np.uint64(1)) * _powers(int(size.max()) + 1)[place], begins)), starts, ends


class FMIndex:
    """Over a sequence of symbols, where 0 separates and is never searched. ``sigma``: symbols are below it."""

    def __init__(self, text: np.ndarray, sigma: int):
        self.n, self.sigma = len(text), sigma
        counts = np.bincount(text, minlength=sigma)
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])  # rows before those that begin with each symbol
        order = self._suffixes(text, counts)
        before = np.where(order > 0, text[order - 1], 0)
        self._matrix(before)
        self.before = before
        start = np.empty(self.n, dtype=bool)
        if self.n:
            start[0] = True
            start[1:] = text[:-1] == 0
        marked = start[order] | (order % SAMPLE_EVERY == 0)
        self.marked, self.marks, self.sampled = marked, np.cumsum(marked) - 1, order[marked]

    def _suffixes(self, text: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling. Each separator is unlike all others, in the order of their places."""
        n = self.n
        rank = self.first[text].astype(np.int64)
        zero = text == 0
        rank[zero] = np.arange(int(zero.sum()))
        open_ = np.flatnonzero(~zero & (counts[text] > 1))
        k = 1
        while len(open_):
            key = rank[open_] * n + rank[open_ + k]
            by = np.argsort(key)
            open_, key = open_[by], key[by]
            old = rank[open_]
            j = np.arange(len(open_))
            new_key = np.concatenate([[True], key[1:] != key[:-1]])
            new_old = np.concatenate([[True], old[1:] != old[:-1]])
            in_group = np.maximum.accumulate(np.where(new_key, j, 0)) - np.maximum.accumulate(np.where(new_old, j, 0))
            rank[open_] = old + in_group
            alone = new_key & np.concatenate([new_key[1:], [True]])
            open_ = open_[~alone]
            k *= 2
        order = np.empty(n, dtype=np.int64)
        order[rank] = np.arange(n)
        return order

    def _matrix(self, symbols: np.ndarray) -> None:
        """Wavelet matrix: for each bit, from the highest, ones before every place, and the number of zeros."""
        self.levels: list[tuple[np.ndarray, int]] = []
        x = symbols.astype(np.int32)
        for b in range(max(1, int(self.sigma - 1).bit_length()) - 1, -1, -1):
            bit = (x >> b) & 1
            ones = np.zeros(self.n + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((ones, self.n - int(ones[-1])))
            hot = bit.astype(bool)
            x = np.concatenate([x[~hot], x[hot]])
        floor = np.zeros(self.sigma, dtype=np.int64)
        self.base = self._descend(np.arange(self.sigma), floor)

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        last = len(self.levels) - 1
        for i, (ones, zeros) in enumerate(self.levels):
            up = ones[at]
            at = np.where((symbol >> (last - i)) & 1, zeros + up, at - up)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the transform before each place."""
        return self._descend(symbol, at) - self.base[symbol]

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of right-aligned phrases (rows, padded in front): first and end row of each one's matches."""
        lo, hi = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n, dtype=np.int64)
        width = phrases.shape[1]
        live = np.arange(len(phrases))
        for step in range(width):
            live = live[(sizes[live] > step) & (lo[live] < hi[live])]
            if not len(live):
                break
            s = phrases[live, width - 1 - step]
            lo[live], hi[live] = self.first[s] + self.rank(s, lo[live]), self.first[s] + self.rank(s, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of matrix rows, by steps back to the nearest sampled one."""
        at, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        live = np.flatnonzero(~self.marked[at])
        while len(live):
            s = self.before[at[live]]
            at[live] = self.first[s] + self.rank(s, at[live])
            steps[live] += 1
            live = live[~self.marked[at[live]]]
        return self.sampled[self.marks[at]] + steps


@dataclass
class Phrases:
    """One block of the benchmark: sorted word hashes, distinct windows as right-aligned rows of symbols, their items."""

    vocabulary: np.ndarray
    windows: np.ndarray
    sizes: np.ndarray
    item_at: np.ndarray  # items of window w: items[item_at[w]:item_at[w + 1]]
    items: np.ndarray
    names: list[str]


def _windows(texts: list[str], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(right-aligned rows of word hashes, words of each row, text of each row) of the windows of texts."""
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(r) for r in raw])
    hashes, starts, _ = hash_words(np.frombuffer(b"".join(raw), dtype=np.uint8), ends)
    word_ends = np.searchsorted(starts, ends)
    rows, sizes, of = [np.empty((0, window), dtype=np.uint64)], [], []
    for i, (lo, hi) in enumerate(zip([0, *word_ends[:-1]], word_ends, strict=True)):
        if hi - lo >= window:
            rows.append(np.lib.stride_tricks.sliding_window_view(hashes[lo:hi], window))
        elif hi > lo:
            rows.append(np.concatenate([np.zeros(window - (hi - lo), dtype=np.uint64), hashes[lo:hi]])[None, :])
        else:
            continue
        sizes += [min(hi - lo, window)] * len(rows[-1])
        of += [i] * len(rows[-1])
    return np.concatenate(rows), np.array(sizes, dtype=np.int64), np.array(of, dtype=np.int64)


def _phrases(rows: np.ndarray, sizes: np.ndarray, items: np.ndarray) -> Phrases:
    """A block of windows and the items that they are of."""
    window = rows.shape[1]
    valid = np.arange(window)[None, :] >= window - sizes[:, None]
    vocabulary = np.unique(rows[valid])
    symbols = np.where(valid, np.searchsorted(vocabulary, rows) + 1, 0).astype(np.int32)
    names, item = np.unique(items, return_inverse=True)
    windows, first, at = np.unique(symbols, axis=0, return_index=True, return_inverse=True)
    pairs = np.unique(np.stack([at.reshape(-1), item.reshape(-1)], axis=1), axis=0)
    item_at = np.searchsorted(pairs[:, 0], np.arange(len(windows) + 1))
    return Phrases(vocabulary, windows, sizes[first], item_at, pairs[:, 1], [str(n) for n in names])


def phrases_of(rows: list[tuple[object, str | None]], window: int = WINDOW) -> Phrases:
    """The phrases of (item, text) rows as one block."""
    found, sizes, of = _windows([t or "" for _, t in rows], window)
    names = np.array(["null" if i is None else str(i) for i, _ in rows] or [""])
    return _phrases(found, sizes, names[of])


def _search_block(hashes: np.ndarray, word_ends: np.ndarray, p: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of the block's windows in a shard: (window, first word, text) numbers. ``word_ends``: by text."""
    none = np.empty(0, dtype=np.int64)
    if not len(p.vocabulary) or not len(hashes):
        return none, none, none
    at = np.minimum(np.searchsorted(p.vocabulary, hashes), len(p.vocabulary) - 1)
    symbol = np.where(p.vocabulary[at] == hashes, at + 1, 0)
    text = np.insert(symbol, word_ends, 0)  # one separator after each text
    index = FMIndex(text, len(p.vocabulary) + 1)
    lo, hi = index.search(p.windows, p.sizes)
    many = hi - lo
    hit = np.repeat(np.arange(len(many)), np.maximum(many, 0))
    if not len(hit):
        return none, none, none
    rows = np.repeat(lo, np.maximum(many, 0)) + np.arange(len(hit)) - np.repeat(np.cumsum(np.maximum(many, 0)) - np.maximum(many, 0), np.maximum(many, 0))
    place = index.locate(rows)
    # The separators before a place are those of the texts before its own.
    of = np.searchsorted(word_ends + np.arange(len(word_ends)), place, side="right")
    of = np.minimum(of, len(word_ends) - 1)
    return hit, place - of, of


@dataclass
class ShardHits:
    n_words: np.ndarray
    n_hit: np.ndarray
    items: list[list[str]]
    spans: list[list[tuple[int, int]]]  # removal spans in words, by text
    byte_spans: list[list[tuple[int, int]]]  # the same in bytes of the text


def search_texts(texts: pa.Array, blocks: Iterator[Phrases]) -> ShardHits:
    """Words, hit words, items and merged spans of each text of a shard."""
    texts = texts.cast(pa.large_binary())
    raw = texts.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if raw[2] is not None else np.empty(0, dtype=np.uint8)
    begin = offsets[:-1] - offsets[0]
    hashes, starts, ends = hash_words(data, offsets[1:] - offsets[0])
    word_ends = np.searchsorted(starts, offsets[1:] - offsets[0])
    word_begins = np.concatenate([[0], word_ends[:-1]])
    delta = np.zeros(len(hashes) + 1, dtype=np.int64)
    items: list[set[str]] = [set() for _ in range(len(texts))]
    for p in blocks:
        hit, place, of = _search_block(hashes, word_ends, p)
        np.add.at(delta, place, 1)
        np.add.at(delta, place + p.sizes[hit] if len(hit) else place, -1)
        for t, w in np.unique(np.stack([of, hit], axis=1), axis=0) if len(hit) else ():
            items[t].update(p.names[i] for i in p.items[p.item_at[w] : p.item_at[w + 1]])
    covered = np.cumsum(delta[:-1]) > 0
    before = np.concatenate([[0], np.cumsum(covered)])
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
    byte_spans: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
    for t in np.flatnonzero(before[word_ends] > before[word_begins]):
        lo, hi = word_begins[t], word_ends[t]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], covered[lo:hi].astype(np.int8), [0]])))
        spans[t] = list(zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True))
        byte_spans[t] = [(int(starts[lo + a] - begin[t]), int(ends[lo + b - 1] - begin[t])) for a, b in spans[t]]
    return ShardHits(word_ends - word_begins, before[word_ends] - before[word_begins], [sorted(s) for s in items], spans, byte_spans)


def _window_batches(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("decontamination")
        for batch in chunks(batches, "text", 1 << 20):
            rows, sizes, of = _windows(batch.column(1).to_pylist(), window)
            words = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * window), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))])
            yield pa.record_batch([words.cast(pa.binary()), pa.array(sizes.astype(np.int32)), batch.column(0).take(pa.array(of))], names=["words", "n", "item"])

    return run


def _packed_blocks(window: int):
    """Over rows (block, words, n, item) sorted by block: (block, bytes of its phrases)."""

    def close(block: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        rows = np.frombuffer(b"".join(t.column("words").to_pylist()), dtype=np.uint64).reshape(-1, window)
        found = _phrases(rows, t.column("n").to_numpy().astype(np.int64), np.array(t.column("item").to_pylist()))
        return pa.record_batch([pa.array([block], pa.int64()), pa.array([pickle.dumps(found)], pa.binary())], names=["block", "phrases"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("decontamination")
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if hi > lo:
                    if held and blocks[lo] != now:
                        yield close(int(now), held)
                        held = []
                    now = blocks[lo]
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield close(int(now), held)

    return run


def benchmark_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES, window: int = WINDOW) -> list:
    """Broadcasts of packed phrases, made by executors; none for a benchmark without words."""
    spark = benchmark.sparkSession
    bounded_batches(spark)
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), text_or_empty(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    windows = rows.mapInArrow(_window_batches(window), "words binary, n int, item string")
    blocks = windows.select(F.pmod(F.xxhash64("words", "n", "item"), F.lit(n)).alias("block"), "words", "n", "item").distinct()
    packed = blocks.repartition(n, "block").sortWithinPartitions("block").mapInArrow(_packed_blocks(window), "block long, phrases binary")
    return [spark.sparkContext.broadcast(bytes(r.phrases)) for r in packed.toLocalIterator()]


@lru_cache(maxsize=1)
def _unpacked(block: bytes) -> Phrases:
    return pickle.loads(block)


def _each_block(blocks: list) -> Iterator[Phrases]:
    for b in blocks:
        yield _unpacked(b.value)
        if len(blocks) > 1:
            b.__dict__.pop("_value", None)  # read again from the worker's file when needed


def _shards(batches: Iterator[pa.RecordBatch], column: str, blocks: list) -> Iterator[tuple[pa.RecordBatch, ShardHits, np.ndarray]]:
    """(rows, hits of the different texts, text number of each row); small batches are searched together."""
    own_worker("decontamination", _unpacked.cache_clear)
    held: list[pa.RecordBatch] = []
    size = 0

    def search(group: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(group).combine_chunks()
        coded = rows.column(column).combine_chunks().dictionary_encode()
        batch = rows.to_batches()[0]
        return batch, search_texts(coded.dictionary, _each_block(blocks)), coded.indices.to_numpy()

    for batch in chunks(batches, column, SHARD_BYTES):
        n = batch.column(batch.schema.get_field_index(column)).nbytes
        if held and size + n > SHARD_BYTES:
            yield search(held)
            held, size = [], 0
        held.append(batch)
        size += n
    if held:
        yield search(held)


def _report(blocks: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found, at in _shards(batches, "text", blocks):
            digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in found.items]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(found.n_words[at]),
                    pa.array(found.n_hit[at]),
                    pa.array([len(found.items[i]) for i in at], pa.int64()),
                    pa.array([digest[i] for i in at]),
                    pa.array([found.items[i] for i in at], pa.list_(pa.string())),
                    pa.array([[{"first": a, "end": b} for a, b in found.spans[i]] for i in at], pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["key", "n_words", "n_hit", "n_items", "items_sha256", "items", "spans"],
            )

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items_sha256, items, spans (in words)."""
    bounded_batches(docs.sparkSession)
    blocks = benchmark_blocks(benchmark, block_bytes=block_bytes)
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    schema = f"key {docs.schema[key].dataType.simpleString()}, n_words long, n_hit long, n_items long, items_sha256 string, items array<string>, spans array<struct<first:long,end:long>>"
    return rows.mapInArrow(_report(blocks), schema).withColumnRenamed("key", key)


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with the byte spans taken out; what stood before and after a span is left as it is."""
    raw, out, at = text.encode(), [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    return b"".join(out).decode()


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with all removal spans cut from the texts, and ``length`` (if there) set anew where a text changed.

    A document of which no word is left after a cut goes; documents without hits stay as they are.
    """
    bounded_batches(docs.sparkSession)
    blocks = benchmark_blocks(benchmark)
    plain = [f"c{i}" for i in range(len(docs.columns))]
    at_text = docs.columns.index(text)
    at_length = docs.columns.index(length) if length in docs.columns else None
    rows = docs.toDF(*plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = (b.append_column("filled", pa.array([t or "" for t in b.column(at_text).to_pylist()], pa.string())) for b in batches)
        for batch, found, at in _shards(filled, "filled", blocks):
            texts = batch.column(at_text).to_pylist()
            hit = [i for i, t in enumerate(at) if found.n_hit[t]]
            cols = list(batch.columns[:-1])
            for i in hit:
                texts[i] = without_spans(texts[i], found.byte_spans[at[i]])
            if hit:
                cols[at_text] = pa.array(texts, cols[at_text].type)
                if at_length is not None:
                    sizes = cols[at_length].to_pylist()
                    for i in hit:
                        sizes[i] = len(texts[i])
                    cols[at_length] = pa.array(sizes, cols[at_length].type)
            keep = np.array([found.n_hit[t] == 0 or found.n_hit[t] < found.n_words[t] for t in at], dtype=bool)
            yield pa.record_batch(cols, names=plain).filter(pa.array(keep))

    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
