"""Token counts from a compiled finite-state transducer, its chunk maps composed by a parallel prefix scan.

The BPE of a sentencepiece model is compiled, lazily and exactly, into a deterministic transducer over characters. The
last token of the encoding of every prefix decides how the encoding goes on: the next prefix's last token is the
longest piece that ends there and is compatible with the last token before it. A state therefore is, for each piece
prefix that the text read so far ends with, the last token at the place where that prefix begins and the number of
tokens since; a transition carries by how much the token count changes.

Two neighbouring characters that stand together in no piece bring the transducer back to one state: no token crosses
them. Texts are cut there (first into units before space marks, which follow no other character in any piece) into
chunks whose state maps are constant: one run of the transducer counts each distinct chunk, and the prefix sums of the
counts along a batch give the count of every document. A chunk of more than ``CHUNK_CHARS`` characters is cut into parts,
each part gets the map of the entry states that can occur there, and an associative scan composes the maps.

The states at a part's start are not known beforehand. Every part is first run from the first state, and then from each
exit state found for the part before it that is new, until there is none; as states soon agree, two rounds mostly do.

Defined results: null and empty texts have 0 tokens; repeated rows, and rows with equal or null keys, count alike and
each by itself; other columns and their names do not matter; texts of any length are read whole; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, bounded_batches, chunks, own_worker, rare_gc, text_or_empty

SPACE = "▁"
CHUNK_CHARS = 64
CACHE_UNITS, CACHE_CHUNKS = 700_000, 1_400_000
CACHE_STATES = 300_000
#: A state: for each live start of a piece (nearest last), the piece prefix since then as a trie node, the last token
#: before it (-1: none), tokens since.
State = tuple[tuple[int, int, int], ...]
#: Of each entry state of a stretch of text: the exit state and the tokens counted.
StateMap = dict[int, tuple[int, int]]
_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Transducer:
    """Lazily determinised counter for one sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        normal = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.score = {m.id_to_piece(i): m.get_score(i) for i in normal}
        inner = [p for p in self.score if SPACE in p.lstrip(SPACE)]
        if inner or m.encode("a  b") == m.encode("a b"):
            raise ValueError("the model joins or drops spaces in ways that chunks cannot follow")
        self.order = {p: -x for p, x in self.score.items() if len(p) > 1}
        made = {p: self._merge(p) for p in self.score}
        self.pieces = {p for p, (parts, _) in made.items() if parts == [p]}
        self.split = {p: made[p][1] for p in self.pieces if len(p) > 1}
        self.pairs = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.names = sorted(self.pieces)
        self.children: list[dict[str, int]] = [{}]
        self.piece_at = [-1]
        for number, p in enumerate(self.names):
            node = 0
            for ch in p:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.piece_at.append(-1)
                node = self.children[node][ch]
            self.piece_at[node] = number
        self.fits = lru_cache(maxsize=300_000)(self._fits)
        self.reset()

    def reset(self) -> None:
        """Forget the states built so far."""
        self.number: dict[State, int] = {((0, -1, 0),): 0}
        self.listed: list[State] = [((0, -1, 0),)]
        self.edges: list[dict[str, tuple[int, int]]] = [{}]
        self.maps: dict[tuple[int, str], tuple[int, int]] = {}

    def _merge(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """The encoding by its definition, the adjacent pair of the best score first, and the last pair that merged."""
        parts, last = list(text), None
        while len(parts) > 1:
            best = max(((self.score[parts[i] + parts[i + 1]], -i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in self.score), default=None)
            if best is None:
                break
            i = -best[1]
            last = (parts[i], parts[i + 1])
            parts[i : i + 2] = ["".join(last)]
        return parts, last

    def _fits(self, first: int, second: int) -> bool:
        """Whether the encoding of two pieces is just these: no merge across the seam comes before those within a and b.

        The merges that made a and b are undone from the last one back, so that at every time the two tokens at the
        seam are known. Among equal scores the left one is merged first.
        """
        a, b, before = self.names[first], self.names[second], float("inf")
        while True:
            if (r := self.order.get(a + b)) is not None and r < before:
                return False
            split_a, split_b = self.split.get(a), self.split.get(b)
            if split_b is not None and (split_a is None or self.order[b] >= self.order[a]):
                before, b = self.order[b] + 0.5, split_b[0]
            elif split_a is not None:
                before, a = self.order[a], split_a[1]
            else:
                return True

    def _step(self, live: State, ch: str) -> tuple[int, int]:
        """(next state, change of the token count) on one character."""
        if ch not in self.pieces:  # unknown: one byte token for each byte, and nothing joins over it
            return 0, len(ch.encode())
        children, piece_at, last, tokens, after = self.children, self.piece_at, -1, 0, []
        for node, before, since in live:  # the longest fitting piece first
            node = children[node].get(ch)
            if node is not None:
                if last < 0 and (piece := piece_at[node]) >= 0 and (before < 0 or self.fits(before, piece)):
                    last, tokens = piece, since
                if children[node]:  # a piece may still go on from here
                    after.append((node, before, since))
        change = 1 - tokens  # tokens since the place where the last piece begins are replaced by it
        new: State = (*[(node, before, since + change) for node, before, since in after], (0, last, 0))
        if new not in self.number:
            self.number[new] = len(self.listed)
            self.listed.append(new)
            self.edges.append({})
        return self.number[new], change

    def chunk_map(self, state: int, chunk: str) -> tuple[int, int]:
        """The map of a chunk at an entry state: exit state and tokens."""
        count, edges = 0, self.edges
        for ch in chunk:
            found = edges[state].get(ch)
            if found is None:
                found = edges[state][ch] = self._step(self.listed[state], ch)
            state, change = found
            count += change
        return state, count

    def chunks_of(self, unit: str) -> list[str]:
        """The unit cut between characters that stand together in no piece: nothing joins there, nor looks over it."""
        if unit.lstrip(SPACE).isalpha():  # mostly whole; a cut is never needed
            return [unit]
        at = [0, *(i for i in range(1, len(unit)) if unit[i - 1 : i + 1] not in self.pairs), len(unit)]
        return [unit[a:b] for a, b in zip(at, at[1:], strict=False)]

    def part_maps(self, parts: list[str]) -> list[StateMap]:
        """The map of each part, over all entry states that a run of the parts before it can end in."""
        out: list[StateMap] = [{} for _ in parts]
        todo = [(i, 0) for i in range(len(parts))]
        while todo:
            after = []
            for i, state in todo:
                if state in out[i]:
                    continue
                key = (state, parts[i])
                if key not in self.maps:
                    self.maps[key] = self.chunk_map(*key)
                out[i][state] = self.maps[key]
                if i + 1 < len(parts):
                    after.append((i + 1, out[i][state][0]))
            todo = after
        return out

    def count_chunk(self, chunk: str) -> int:
        """Tokens of a chunk that is read from the first state."""
        if len(chunk) <= CHUNK_CHARS:
            return self.chunk_map(0, chunk)[1]
        parts = [chunk[lo : lo + CHUNK_CHARS] for lo in range(0, len(chunk), CHUNK_CHARS)]
        return prefix_scan(self.part_maps(parts))[-1][0][1]


def compose(first: StateMap, second: StateMap) -> StateMap:
    """The map of a stretch and the one after it, taken together."""
    return {state: (second[middle][0], n + second[middle][1]) for state, (middle, n) in first.items() if middle in second}


def prefix_scan(maps: list[StateMap]) -> list[StateMap]:
    """Compositions of the first 1, 2, ... maps, in a logarithmic number of passes of independent compositions."""
    if len(maps) < 2:
        return maps
    halves = prefix_scan([compose(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)])
    return [maps[0] if i == 0 else halves[i // 2] if i % 2 else compose(halves[i // 2 - 1], maps[i]) for i in range(len(maps))]


class Counter:
    def __init__(self, path: str):
        self.machine, self.memo, self.chunks = Transducer(path), Memo(CACHE_UNITS), Memo(CACHE_CHUNKS)

    def units(self, text: str) -> list[str]:
        """Units between returns to the first state; sentencepiece puts one space mark before a non-empty text."""
        return _UNITS.findall((SPACE + text).replace(" ", SPACE)) if text else []

    def count(self, texts: list[str]) -> np.ndarray:
        cut = [self.units(t) for t in texts]
        new = self.memo.missing({u for us in cut for u in us})
        known = self.memo.now
        cut_new = [self.machine.chunks_of(u) for u in new]
        of_chunk = self.chunks
        for x in of_chunk.missing({x for xs in cut_new for x in xs}):
            # Every chunk is read from the first state, so that states can go between any two.
            if len(self.machine.listed) > CACHE_STATES or len(self.machine.maps) > CACHE_STATES:
                self.machine.reset()
            of_chunk.now[x] = self.machine.count_chunk(x)
        for u, xs in zip(new, cut_new, strict=True):
            known[u] = sum(map(of_chunk.now.__getitem__, xs))
        sizes = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        flat = np.fromiter((known[u] for us in cut for u in us), dtype=np.int64, count=int(sizes.sum()))
        scan = np.concatenate([[0], np.cumsum(flat)])
        ends = np.cumsum(sizes)
        return scan[ends] - scan[ends - sizes]


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    return Counter(path)


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("token counts", counter.cache_clear)
        c = counter(path)
        rare_gc()
        for batch in chunks(batches, "text", 4 << 20):
            text = batch.column(1)
            size = pc.binary_length(text).cast(pa.int64())
            yield pa.record_batch([batch.column(0), size, pa.array(c.count(text.to_pylist()), pa.int64())], names=["key", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes (UTF-8), n_tokens of every row's whole text."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(_counts(path), f"key {docs.schema[key].dataType.simpleString()}, n_bytes long, n_tokens long").withColumnRenamed("key", key)
