"""Token-id output in shards compressed by a Re-Pair grammar, with random access.

Documents are put in order of their key by range partitioning, encoded with the tokenizers library and cut into shards
of whole documents. In each shard, rounds of replacement give the most frequent pairs of neighbouring symbols a
nonterminal of their own until no pair is frequent enough or the rule table is full. A shard
stores the rules, the expansion length of every nonterminal, the sequence and sampled offsets into its expansion, so
that any range of ids is decoded by expanding only the symbols that cover it.

Shards are written by Spark as rows of a Parquet table (part, number, place of its first id within the part, bytes), so
task retries and lost executors leave whole files only, in any store that Spark writes.

File format (little-endian): ``TWRP``, then uint32 version, documents, ids, base symbols, rules, sequence symbols, bytes
a symbol (2 or 4), 0; then keys (int64 each), null-key marks (1 byte each), document ends in ids (int64 each), rules
(two uint32 each), expansion lengths (uint32 each), expansion offsets of every ``ACCESS_EVERY``-th symbol (int64 each),
the sequence.

Rounds stop where no pair has ``MIN_COUNT`` places or symbols would need more than two bytes: rules that make the sequence
shorter still would make the shard larger (see the README for figures).

Defined results: null and empty texts have the end id only; null keys come first and are kept as null; repeated keys are
in order of the first 64 characters of their texts and then of a hash of these, equal rows in any order; keys are whole numbers, others raise; other columns and their names do
not matter; an empty table writes no shard. A document longer than a shard is a shard of its own. Writing runs when the
operator is called, and the shards stay where they were written.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import bounded_batches, chunks, own_worker, rare_gc, scratch_path, text_or_empty
from .pieces import PATTERN, PieceTable

MAGIC, VERSION = b"TWRP", 1
SHARD_IDS = 2_000_000
BASE = 50257
MAX_RULES = 65536 - BASE  # symbols then fit in two bytes
MIN_COUNT = 8
ROUNDS = 5  # that share the rule table out; more follow as needed
ACCESS_EVERY = 1024
BEGINNING = 64
CACHE_WORDS = 2_000_000
WORDS_PER_CALL = 20_000
_HASH_BITS, _LEAST_BITS = 21, 12
_MIX = (0x9E3779B1, 0x85EBCA77)  # odd


class Encoder:
    """Ids of whole texts, by the library's encoding of each different piece that its pre-tokenizer cuts.

    As in the library, texts are first cut at the file's added tokens, which have ids of their own.
    """

    def __init__(self, path: str, pattern: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        cut = json.loads(self.library.to_str()).get("pre_tokenizer") or {}
        if pattern == PATTERN and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space"):
            # Pieces are cut by the same pattern already: only bytes are left to be mapped.
            self.library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        added = self.library.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that take white space or need word borders are not cut")
        self.added = {t.content: i for i, t in added.items()}
        longest = sorted(self.added, key=len, reverse=True)  # the longest wins where several begin
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest))})" if longest else r"(?!)()").split
        self.end = end
        self.pieces = PieceTable(CACHE_WORDS, self._learn, self._forget, pattern)
        self._forget()

    def _forget(self) -> None:
        self.ids, self.used, self.ends, self.n = np.empty(1 << 20, dtype=np.uint32), 0, np.zeros(1 << 20, dtype=np.int64), 0

    def _learn(self, pieces: list[str]) -> None:
        """Append the ids of new pieces; arrays double when they are full."""
        for lo in range(0, len(pieces), WORDS_PER_CALL):
            some = pieces[lo : lo + WORDS_PER_CALL]
            found = self.library.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, dtype=np.uint32)
            counts = np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(some))
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            while self.n + len(some) >= len(self.ends):
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.ids[self.used : self.used + len(ids)] = ids
            self.ends[self.n + 1 : self.n + 1 + len(some)] = self.used + np.cumsum(counts)
            self.used, self.n = self.used + len(ids), self.n + len(some)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, an end id after each; ids of each text with its end id)."""
        between, marks, parts = [], [], []  # what stands between added tokens, the id after each, and how many a text has
        for t in texts:
            cut = self.cut(t)
            between += cut[::2]
            marks += [self.added[a] for a in cut[1::2]]
            marks.append(self.end)
            parts.append(len(cut) // 2 + 1)
        numbers, pieces = self.pieces.read(between)
        begin = self.ends[numbers]
        size = self.ends[numbers + 1] - begin
        after = np.cumsum(size)
        ids = self.ids[np.repeat(begin - (after - size), size) + np.arange(int(size.sum()))]
        last = np.concatenate([[0], after])[np.cumsum(pieces)]
        at = np.cumsum(parts)
        return np.insert(ids, last, np.array(marks, dtype=ids.dtype)), np.diff(last[at - 1] + at, prepend=0)


@lru_cache(maxsize=1)
def encoder(path: str, pattern: str, end: int) -> Encoder:
    return Encoder(path, pattern, end)


def _single(key: np.ndarray, min_count: int) -> np.ndarray:
    """Places of the most frequent pair with enough places that do not overlap, by exact counts; empty if there is none."""
    pairs, of, counts = np.unique(key, return_inverse=True, return_counts=True)
    often = np.flatnonzero(counts >= min_count)
    for k in often[np.argsort(-counts[often], kind="stable")]:
        if len(at := _apart(np.flatnonzero(of == k))) >= min_count:
            return at
    return np.empty(0, dtype=np.int64)


def _apart(at: np.ndarray) -> np.ndarray:
    """Of neighbouring places, every second one from the left."""
    run = np.concatenate([[True], np.diff(at) != 1]) if len(at) else np.empty(0, dtype=bool)
    place = np.arange(len(at))
    return at[(place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0]


def grammar(ids: np.ndarray, base: int = BASE, max_rules: int = MAX_RULES, min_count: int = MIN_COUNT, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair: (rules as pairs of symbols, expansion lengths of the rules, sequence). Symbol base + i is rule i.

    A round counts all neighbouring pairs by hash and replaces the most frequent of them together, without overlaps;
    pairs that share a hash count as the one seen last, so a rare pair is never taken for a frequent one, and each round
    hashes anew. A round that finds none is followed by an exact count. The first ``rounds`` share the rule table out;
    more follow until it is full or no pair is frequent enough.
    """
    seq = ids.astype(np.uint32)
    rules, lengths = np.empty((0, 2), dtype=np.uint32), np.empty(0, dtype=np.int64)
    for n in count():
        if len(seq) < 2 or len(rules) >= max_rules:
            break
        bits = min(_HASH_BITS, max(_LEAST_BITS, len(seq).bit_length() + 1))
        mix = [np.uint32(int(m) * (4 * n + 1) & 0xFFFFFFFF) for m in _MIX]
        h = ((seq[:-1] * mix[0] + seq[1:] * mix[1]) >> np.uint32(32 - bits)).astype(np.intp)
        counts = np.bincount(h, minlength=1 << bits)
        room = max(1, (max_rules - len(rules)) // min(max(rounds - n, 1), 3))
        often = np.flatnonzero(counts >= min_count)
        if not len(often):
            break
        if len(often) > 2 * room:  # more than fit, as some will hardly be found apart from others
            often = often[np.argpartition(counts[often], -2 * room)[-2 * room :]]
        chosen = np.zeros(1 << bits, dtype=bool)
        chosen[often] = True
        at = np.flatnonzero(chosen[h])
        own = h[at]
        seen = np.empty(1 << bits, dtype=np.intp)
        seen[own] = at
        first = seen[own]
        at = _apart(at[(seq[at] == seq[first]) & (seq[at + 1] == seq[first + 1])])
        own = h[at]
        used = np.bincount(own, minlength=1 << bits)
        good = np.flatnonzero(used >= min_count)
        if not len(good):
            at = _single((seq[:-1].astype(np.uint64) << np.uint64(32)) | seq[1:], min_count)
            if not len(at):
                break
            own = h[at]
            good = own[:1]
            seen[good] = at[0]
        elif len(good) > room:
            good = good[np.argpartition(used[good], -room)[-room:]]
        number = np.full(1 << bits, -1, dtype=np.int64)
        number[good] = base + len(rules) + np.arange(len(good))
        name = number[own]
        at, name = at[name >= 0], name[name >= 0]
        pairs = np.stack([seq[seen[good]], seq[seen[good] + 1]], axis=1)
        size = np.concatenate([np.ones(base, dtype=np.int64), lengths])
        rules, lengths = np.concatenate([rules, pairs]), np.concatenate([lengths, size[pairs[:, 0]] + size[pairs[:, 1]]])
        seq[at] = name
        keep = np.ones(len(seq), dtype=bool)
        keep[at + 1] = False
        seq = seq[keep]
    return rules, lengths, seq


def expand(seq: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int = BASE) -> np.ndarray:
    """Ids of a sequence: nonterminals are replaced by their expansions, which are built once a rule."""
    size = np.concatenate([np.ones(base, dtype=np.int64), lengths])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.zeros(int(starts[-1]), dtype=np.uint32)
    # Rules only name earlier symbols, so they are filled by depth.
    depth, below = np.zeros(base + len(rules), dtype=np.int64), None
    while below is None or (depth[base:] != below).any():
        below = depth[base:].copy()
        depth[base:] = 1 + depth[rules].max(axis=1, initial=0)

    def put(symbols: np.ndarray, to: np.ndarray) -> None:
        plain = symbols < base
        flat[to[plain]] = symbols[plain]
        r, t = symbols[~plain].astype(np.int64) - base, to[~plain]
        n = lengths[r]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        flat[np.repeat(t, n) + step] = flat[np.repeat(starts[r], n) + step]

    for d in range(1, int(depth.max(initial=0)) + 1):
        r = np.flatnonzero(depth[base:] == d)
        put(rules[r, 0], starts[r])
        put(rules[r, 1], starts[r] + size[rules[r, 0]])
    n = size[seq]
    out = np.empty(int(n.sum()), dtype=np.uint32)
    to = np.cumsum(n) - n
    plain = seq < base
    out[to[plain]] = seq[plain]
    r, t, n = seq[~plain].astype(np.int64) - base, to[~plain], n[~plain]
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(t, n) + step] = flat[np.repeat(starts[r], n) + step]
    return out


def pack(keys: list[int | None], ends: np.ndarray, ids: np.ndarray) -> bytes:
    """One shard's bytes. ``ends``: where each document ends in ``ids``, which are below ``BASE``."""
    if len(ids) and int(ids.max()) >= BASE:
        raise ValueError("an id is outside the vocabulary")
    rules, lengths, seq = grammar(ids)
    size = np.concatenate([np.ones(BASE, dtype=np.int64), lengths])[seq]
    access = (np.cumsum(size) - size)[::ACCESS_EVERY]
    width = 2 if BASE + len(rules) <= 65536 else 4
    head = struct.pack("<4s8I", MAGIC, VERSION, len(keys), len(ids), BASE, len(rules), len(seq), width, 0)
    parts = [np.array([k or 0 for k in keys], dtype="<i8"), np.array([k is None for k in keys], dtype=np.uint8), ends.astype("<i8"), rules.astype("<u4"), lengths.astype("<u4"), access.astype("<i8"), seq.astype(f"<u{width}")]
    return head + b"".join(p.tobytes() for p in parts)


class Shard:
    """A packed shard, read in place."""

    def __init__(self, blob: bytes):
        magic, version, n_docs, self.n_ids, self.base, n_rules, n_seq, width, _ = struct.unpack_from("<4s8I", blob)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token shard of this version")
        at = struct.calcsize("<4s8I")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        self.keys, self.null = take("<i8", n_docs), take("u1", n_docs)
        self.ends, self.rules = take("<i8", n_docs), take("<u4", 2 * n_rules).reshape(-1, 2)
        self.lengths = take("<u4", n_rules).astype(np.int64)
        self.access, self.seq = take("<i8", -(-n_seq // ACCESS_EVERY)), take(f"<u{width}", n_seq)

    def key(self, i: int) -> int | None:
        return None if self.null[i] else int(self.keys[i])

    def ids(self) -> np.ndarray:
        return expand(self.seq.astype(np.uint32), self.rules, self.lengths, self.base)

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop, by expanding only the symbols that cover them."""
        start, stop = max(0, start), min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, dtype=np.uint32)
        lo = (int(np.searchsorted(self.access, start, side="right")) - 1) * ACCESS_EVERY
        hi = int(np.searchsorted(self.access, stop, side="left")) * ACCESS_EVERY
        from_ = int(self.access[lo // ACCESS_EVERY])
        some = self.seq[lo:hi].astype(np.int64)
        size = np.where(some < self.base, 1, self.lengths[np.maximum(some - self.base, 0)]) if len(self.lengths) else np.ones(len(some), dtype=np.int64)
        ends = from_ + np.cumsum(size)
        a, b = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(ends, stop, side="left")) + 1
        begin = from_ if a == 0 else int(ends[a - 1])
        out: list[int] = []
        stack = some[a:b][::-1].tolist()
        while stack:
            s = stack.pop()
            if s < self.base:
                out.append(s)
            else:
                stack += [int(self.rules[s - self.base, 1]), int(self.rules[s - self.base, 0])]
        return np.array(out[start - begin : stop - begin], dtype=np.uint32)

    def document(self, i: int) -> np.ndarray:
        return self.slice(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))


def _pack_batches(path: str, pattern: str, end: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("token shards", encoder.cache_clear)
        e = encoder(path, pattern, end)
        rare_gc()
        part = TaskContext.get().partitionId()
        keys: list[int | None] = []
        held: list[np.ndarray] = []
        counts: list[int] = []
        size = number = start = 0

        def close() -> pa.RecordBatch:
            blob = pack(keys, np.cumsum(counts), np.concatenate(held))
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([start], pa.int64()), pa.array([size], pa.int64()), pa.array([blob], pa.binary())], names=["part", "number", "start_in_part", "n_ids", "shard"])

        for batch in chunks(batches, "text", 2 << 20):
            ids, sizes = e.encode(batch.column(1).to_pylist())
            at = 0  # ids of this batch that are already in a shard's list
            to = 0
            for key, n in zip(batch.column(0).to_pylist(), sizes.tolist(), strict=True):
                if counts and size + n > shard_ids:
                    held.append(ids[at:to])
                    yield close()
                    number, start, keys, held, counts, size, at = number + 1, start + size, [], [], [], 0, to
                keys.append(key)
                counts.append(n)
                size += n
                to += n
            held.append(ids[at:to])
        if counts:
            yield close()

    return run


def write_shards(docs: DataFrame, out: str, path: str, pattern: str, end: int = 2, key: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Write the table ``out`` of packed shards, in ascending order of the key."""
    bounded_batches(docs.sparkSession)
    if not isinstance(docs.schema[key].dataType, IntegralType):
        raise TypeError(f"shards hold whole numbers as keys, and {key} is {docs.schema[key].dataType.simpleString()}")
    rows = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    # Rows of one key are parted by the beginning of their texts, then by a hash of whole texts (whole texts would have to be
    # sampled otherwise), and equal rows, which may stand in any order, by the place where they were read.
    order = [F.col("key"), F.substring("text", 1, BEGINNING), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order, "text")
    schema = "part int, number int, start_in_part long, n_ids long, shard binary"
    ordered.mapInArrow(_pack_batches(path, pattern, end, shard_ids), schema).write.option("compression", "zstd").parquet(out)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """part, number, start (ids in all shards before), n_ids, shard."""
    shards = spark.read.schema("part int, number int, start_in_part long, n_ids long, shard binary").parquet(path)
    # One row per range partition: their number is a setting of the write, not of the data's size.
    parts = shards.groupBy("part").agg(F.max(F.col("start_in_part") + F.col("n_ids")).alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("ids_before"))
    return shards.join(F.broadcast(parts), "part").select("part", "number", (F.col("ids_before") + F.col("start_in_part")).alias("start"), "n_ids", "shard")


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, blob in zip(batch.column(0), batch.column(1), strict=True):
            shard = Shard(blob.as_py())
            ids = shard.ids().astype("<u4")
            begins = np.concatenate([[0], shard.ends[:-1]]).astype(np.int64)
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(begins, shard.ends, strict=True)]
            yield pa.record_batch([pa.array([shard.key(i) for i in range(len(sums))], pa.int64()), pa.array(begins + start.as_py()), pa.array(shard.ends - begins), pa.array(sums, pa.int64())], names=["key", "start", "n_tokens", "ids_crc32"])


def document_rows(shards: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document, from the decoded shards: key, start, n_tokens, ids_crc32."""
    return shards.select("start", "shard").mapInArrow(_read_batches, "key long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("key", key)


def encode_and_read(docs: DataFrame, path: str, pattern: str, end: int = 2, key: str = "doc_id", text: str = "text", out: str | None = None) -> DataFrame:
    """Write the shards (to the shared folder unless ``out`` is given) and return what they hold, read back."""
    spark = docs.sparkSession
    out = out or scratch_path(spark, "token-shards")
    write_shards(docs, out, path, pattern, end, key, text)
    return document_rows(read_shards(spark, out), key)
