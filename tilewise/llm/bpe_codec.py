"""Byte-level BPE encoding and decoding with DuckDB recursive queries, one database per Python worker.

Texts are cut by the tokenizer's pattern; the distinct matches of a batch that the worker has not met become
token-position rows in DuckDB. A recursive query joins neighbouring rows with the merge table and contracts each
word's leftmost pair of least rank, once a step, until no word has a pair left. Decoding joins ids with the vocabulary
and concatenates bytes in order. A worker keeps the results for at most ``CACHE_WORDS`` words.

A match of over ``BLOCK_BYTES`` is cut into blocks that are contracted as words of their own, so that a step never runs
over long words alone. The encodings of two blocks stand side by side if the query leaves the two tokens at their seam as
they are (then no merge of the whole match crosses it); blocks whose seam does not hold are joined and contracted again,
by a form of the query that keeps one row a position and contracts all places of the least pair in a step.

Defined results: null and empty texts have no ids; repeated rows, and rows with equal or null keys, are encoded alike and
each by itself; other columns and their names do not matter; an empty table gives an empty result; any text length works,
as rows are only held for the distinct words of a batch of bounded size. Memory grows with the longest match alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, own_worker, rare_gc, text_or_empty
from .pieces import PieceTable

CACHE_WORDS = 800_000
BLOCK_BYTES = 64
WORDS_PER_QUERY = 10_000
#: Bound on the rows of all steps of a query: a word of n bytes has at most n * n.
ROWS_PER_QUERY = 4_000_000
MEMORY_MB = 300

_ENCODE = """
CREATE OR REPLACE TEMP TABLE ids AS
WITH RECURSIVE step(word, pos, id, n) AS (
    SELECT word, pos, id, 0 FROM start
  UNION ALL
    SELECT word, pos, id, n FROM (
        WITH pairs AS (
            SELECT word, pos, id, n, lead(id) OVER w AS after, lead(pos) OVER w AS after_pos
            FROM step WINDOW w AS (PARTITION BY word ORDER BY pos)
        ), best AS (
            SELECT p.word, min(m.rank::BIGINT * 1048576 + p.pos) AS at, any_value(p.n) + 1 AS n
            FROM pairs p JOIN merges m ON m.a = p.id AND m.b = p.after GROUP BY p.word
        )
        SELECT p.word, p.pos, CASE WHEN p.pos = b.at % 1048576 THEN (b.at // 1048576)::INTEGER ELSE p.id END AS id, b.n
        FROM pairs p JOIN best b ON b.word = p.word
        LEFT JOIN (SELECT q.word, q.after_pos FROM pairs q JOIN best c ON c.word = q.word AND q.pos = c.at % 1048576) gone
               ON gone.word = p.word AND gone.after_pos = p.pos
        WHERE gone.word IS NULL
    )
), last AS (SELECT word, max(n) AS n FROM step GROUP BY word)
SELECT s.word, s.pos, s.id FROM step s JOIN last l ON l.word = s.word AND l.n = s.n
"""

#: The same for long words: only changed rows are kept (id -1: gone), and all places of a word's least pair go together.
#: After a merge of rank r a pair of a rank below r may stand beside it; such ranks (``alone``) are contracted one by one.
_ENCODE_LONG = """
CREATE OR REPLACE TEMP TABLE ids AS
WITH RECURSIVE step(word, pos, id) USING KEY (word, pos) AS (
    SELECT word, pos, id FROM start
  UNION
    SELECT word, pos, id FROM (
        WITH pairs AS (
            SELECT word, pos, id, lead(id) OVER w AS after, lead(pos) OVER w AS after_pos, row_number() OVER w AS nth
            FROM recurring.step WHERE id >= 0 WINDOW w AS (PARTITION BY word ORDER BY pos)
        ), ranked AS (
            SELECT p.word, p.pos, p.after_pos, p.nth, m.rank, m.alone, min(m.rank) OVER (PARTITION BY p.word) AS least
            FROM pairs p JOIN merges m ON m.a = p.id AND m.b = p.after
        ), hit AS (
            SELECT *, min(nth) OVER (PARTITION BY word) AS first, nth - row_number() OVER (PARTITION BY word ORDER BY nth) AS run
            FROM ranked WHERE rank = least
        ), chosen AS (
            SELECT word, pos, after_pos, rank FROM hit
            QUALIFY row_number() OVER (PARTITION BY word, run ORDER BY nth) % 2 = 1 AND (NOT alone OR nth = first)
        )
        SELECT word, pos, rank AS id FROM chosen UNION ALL SELECT word, after_pos, -1 FROM chosen
    )
)
SELECT word, pos, id FROM step WHERE id >= 0
"""

_DECODE = """
SELECT i.word, string_agg(i.id::VARCHAR, ' ' ORDER BY i.pos) AS decimal, string_agg(v.hex, '' ORDER BY i.pos) AS hex
FROM ids i JOIN vocab v ON v.id = i.id GROUP BY i.word
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _batches(words: list) -> Iterator[list]:
    """The words (text or bytes) in turn, in lists that a query takes together, by their bytes."""
    lo, rows = 0, 0
    for i, w in enumerate(words):
        n = min(len(w if isinstance(w, bytes) else w.encode()), BLOCK_BYTES) ** 2
        if i > lo and (i - lo == WORDS_PER_QUERY or rows + n > ROWS_PER_QUERY):
            yield words[lo:i]
            lo, rows = i, 0
        rows += n
    if words[lo:]:
        yield words[lo:]


class Codec:
    """Encoder and decoder for one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.decimal: list[bytes] = []
        self.data: list[bytes] = []
        self.pieces = PieceTable(CACHE_WORDS, self._learn, self._forget, pattern)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.db = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": f"{MEMORY_MB}MB", "temp_directory": "", "preserve_insertion_order": "false", "allocator_flush_threshold": "16MB"})
        merges = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        a, b, r = zip(*merges, strict=True) if merges else ((), (), ())
        alone = {x for ab in zip(a, b, r, strict=True) for x in ab[:2] if ab[2] <= x}
        self._table("merges", {"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "rank": pa.array(r, pa.int32()), "alone": pa.array([x in alone for x in r], pa.bool_())})
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        self.seams: dict[tuple[int, int], bool] = {}
        self._table("vocab", {"id": pa.array(list(self.ranks.values()), pa.int32()), "hex": pa.array([t.hex() for t in self.ranks])})

    def _table(self, name: str, columns: dict) -> None:
        given = pa.table(columns)  # noqa: F841  read by DuckDB from this frame
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM given")

    def _contract(self, raw: list[bytes]) -> None:
        """Fill the table ``ids`` (word number, position, id) for these words by the recursive query."""
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        pos = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
        long = len(raw) > 0 and int(size.max()) > BLOCK_BYTES
        if long:
            self.db.execute(f"SET memory_limit = '{MEMORY_MB + len(data) // 2500}MB'")
        self._table("start", {"word": np.repeat(np.arange(len(raw)), size).astype(np.int32), "pos": pos.astype(np.int32), "id": self.byte_ids[data]})
        self.db.execute(_ENCODE_LONG if long else _ENCODE)
        if long:
            self.db.execute(f"SET memory_limit = '{MEMORY_MB}MB'")

    def ids_of(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """Ids of words, each contracted as a whole."""
        out: dict[bytes, list[int]] = {w: [] for w in words}
        for some in _batches(list(out)):
            self._contract(some)
            for w, ids in self.db.execute("SELECT word, list(id ORDER BY pos) FROM ids GROUP BY word").fetchall():
                out[some[w]] = ids
        return out

    def _long(self, words: list[bytes]) -> list[list[int]]:
        """Ids of long words, by blocks whose seams hold."""
        cut = [[w[i : i + BLOCK_BYTES] for i in range(0, len(w), BLOCK_BYTES)] for w in words]
        known: dict[bytes, list[int]] = {}
        open_ = list(range(len(words)))  # words with a seam that may not hold
        while open_:
            known |= self.ids_of([b for b in dict.fromkeys(b for i in open_ for b in cut[i]) if b not in known])
            at_seam = {i: [(known[a][-1], known[b][0]) for a, b in zip(cut[i], cut[i][1:], strict=False)] for i in open_}
            new = {p: self.bytes_of[p[0]] + self.bytes_of[p[1]] for ps in at_seam.values() for p in ps if p not in self.seams}
            found = self.ids_of(list(dict.fromkeys(new.values())))
            self.seams |= {p: found[d] == list(p) for p, d in new.items()}
            still = []
            for i in open_:
                joined = cut[i][:1]
                for b, p in zip(cut[i][1:], at_seam[i], strict=True):
                    if self.seams[p]:
                        joined.append(b)
                    else:
                        joined[-1] += b
                if len(joined) < len(cut[i]):
                    cut[i] = joined
                    still.append(i)
            open_ = still
        return [[x for b in blocks for x in known[b]] for blocks in cut]

    def _encode(self, words: list[str]) -> None:
        """Fill the table ``ids`` (word number, position, id) for these words."""
        raw = [w.encode() for w in words]
        at = [i for i, d in enumerate(raw) if len(d) > BLOCK_BYTES]
        long = dict(zip(at, self._long([raw[i] for i in at]), strict=True))
        self._contract([b"" if i in long else d for i, d in enumerate(raw)])
        if long:
            size = np.fromiter(map(len, long.values()), dtype=np.int64, count=len(long))
            pos = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            self._table("more", {"word": np.repeat(np.fromiter(long, dtype=np.int32, count=len(long)), size), "pos": pos.astype(np.int32), "id": np.fromiter((i for x in long.values() for i in x), dtype=np.int32, count=int(size.sum()))})
            self.db.execute("INSERT INTO ids SELECT * FROM more")

    def _decoded(self, n: int) -> list[tuple[bytes, bytes]]:
        """Of the words in the table ``ids``: decimal ids joined by a space, and the bytes that they decode to."""
        out = [(b"", b"")] * n
        for w, decimal, data in self.db.execute(_DECODE).fetchall():
            out[w] = (decimal.encode(), bytes.fromhex(data))
        return out

    def decode_words(self, words: list[list[int]]) -> list[bytes]:
        """Bytes of each sequence of ids."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        pos = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        ids = np.fromiter((i for w in words for i in w), dtype=np.int32, count=int(size.sum()))
        self._table("ids", {"word": np.repeat(np.arange(len(words)), size).astype(np.int32), "pos": pos.astype(np.int32), "id": ids})
        return [data for _, data in self._decoded(len(words))]

    def _learn(self, words: list[str]) -> None:
        """Decimal ids joined by a space, and the bytes decoded from the ids, of new pieces."""
        for some in _batches(words):
            self._encode(some)
            for decimal, data in self._decoded(len(some)):
                self.decimal.append(decimal)
                self.data.append(data)

    def _forget(self) -> None:
        self.decimal.clear()
        self.data.clear()
        self.seams.clear()

    def read(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Of each text: decimal ids joined by a space, and the bytes decoded from the ids."""
        numbers, sizes = self.pieces.read(texts)
        every, at = numbers.tolist(), 0
        for n in sizes.tolist():
            own = every[at : at + n]
            at += n
            yield b" ".join(map(self.decimal.__getitem__, own)), b"".join(map(self.data.__getitem__, own))


@lru_cache(maxsize=1)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _worker_codec(path: str, pattern: str) -> Codec:
    own_worker("bpe", codec.cache_clear)
    rare_gc()
    return codec(path, pattern)


def _digests(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _worker_codec(path, pattern)
        for batch in chunks(batches, "text", 1 << 20):
            counts, ids, decoded = [], [], []
            for decimal, data in c.read(batch.column(1).to_pylist()):
                counts.append(decimal.count(b" ") + 1 if decimal else 0)
                ids.append(hashlib.sha256(decimal).hexdigest())
                decoded.append(hashlib.sha256(data).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)], names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def round_trip_digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256 (bytes decoded from the ids)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    out = rows.mapInArrow(_digests(path, pattern), f"key {docs.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)


def _both(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _worker_codec(path, pattern)
        for batch in chunks(batches, "text", 1 << 20):
            ids, decoded = [], []
            for decimal, data in c.read(batch.column(1).to_pylist()):
                ids.append(np.array(decimal.split(), dtype=np.int32))
                decoded.append(data)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, dtype=np.int32)))
            yield pa.record_batch([batch.column(0), lists, pa.array(np.diff(ends).astype(np.int64)), pa.array(decoded, pa.binary()).cast(pa.string())], names=["key", "ids", "n_tokens", "decoded"])

    return run


def encode_and_decode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids, n_tokens, decoded (the text that the ids decode to; null texts give an empty one)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(_both(path, pattern), f"key {docs.schema[key].dataType.simpleString()}, ids array<int>, n_tokens long, decoded string").withColumnRenamed("key", key)


def _decoder(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _worker_codec(path, pattern)
        for batch in batches:
            sequences = [x or [] for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(c.decode_words(sequences), pa.binary())], names=["key", "bytes"])

    return run


def decode(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, bytes: the concatenated token bytes of each row's ids."""
    bounded_batches(encoded.sparkSession)
    rows = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return rows.mapInArrow(_decoder(path, pattern), f"key {encoded.schema[key].dataType.simpleString()}, bytes binary").withColumnRenamed("key", key)
