"""The byte-level BPE pattern on arrays, and numbering of the pieces that it cuts.

Texts of a batch are joined into one array of code points. Pieces begin where the class of characters changes, with the
pattern's rules for contractions, for a space that goes with what follows it, and for white space. Each piece is named
by a 64-bit hash from prefix sums; a second sum tells different pieces of equal hash apart. A worker numbers the
distinct pieces that it meets, so that all further work on a text is gathering by number.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex

#: The pattern that this module cuts by (a fixed value of the tokenizers).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTER, _NUMBER, _OTHER, _SPACE = range(4)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point, by the same properties as the pattern's; from plane 4 on there are only others."""
    out = np.full(0x110000, _OTHER, dtype=np.uint8)
    for low in range(0, 0x40000, 0x4000):
        block = "".join(chr(c) for c in range(low, low + 0x4000) if not 0xD800 <= c < 0xE000)
        for kind, test in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
            out[[ord(c) for c in regex.findall(test, block)]] = kind
    return out


_TABLES: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, at least n of each."""
    if len(_TABLES[0]) < n:
        for i, base in enumerate((_ODD, _BACK)):
            _TABLES[i] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n + n // 4, base, dtype=np.uint64)]), dtype=np.uint64)
    return _TABLES


def starts(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """First characters of the pieces of texts of these sizes, joined."""
    n = len(points)
    if not n:
        return np.empty(0, dtype=np.int64)
    kind = _classes()[points]
    edges = np.cumsum(sizes[sizes > 0])
    first = np.zeros(n + 1, dtype=bool)  # of a text; n counts as one
    first[0] = True
    first[edges] = True
    start = first.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    # The last of white space that something follows in the same text stands apart; if it is a space, it goes with that.
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n])
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    mark = np.flatnonzero((points == 39) & start[:n])
    if len(mark):
        padded = np.concatenate([points, np.zeros(3, dtype=points.dtype)])
        ends = np.concatenate([first, np.ones(3, dtype=bool)])
        a, b = padded[mark + 1], padded[mark + 2]
        one = np.isin(a, [ord(c) for c in "stmd"]) & ~ends[mark + 1]
        two = (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))) & ~ends[mark + 1] & ~ends[mark + 2]
        for some, size in ((mark[one], 2), (mark[two], 3)):
            start[some + 1] = False
            start[some + size] = True
    return np.flatnonzero(start[:n])


def starts_of(pattern: str) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """First characters of the matches of any other pattern whose matches cover the text."""
    find = regex.compile(pattern).finditer

    def run(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        text, out, at = points.tobytes().decode("utf-32-le"), [], 0
        for n in sizes.tolist():
            out += [at + m.start() for m in find(text[at : at + n])]
            at += n
        return np.array(out, dtype=np.int64)

    return run


class PieceTable:
    """Numbers for pieces. ``learn`` is told the new ones, in order of their numbers; ``forget`` that all start anew."""

    def __init__(self, limit: int, learn: Callable[[list[str]], None], forget: Callable[[], None], pattern: str = PATTERN):
        self.limit, self.learn, self.forget = limit, learn, forget
        self.starts = starts if pattern == PATTERN else starts_of(pattern)
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.sums, self.numbers = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        self.count = 0

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all pieces in order, pieces of each text)."""
        if self.count > self.limit:
            self._clear()
            self.forget()
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        begin = self.starts(points, sizes)
        if not len(begin):
            return begin, np.zeros(len(texts), dtype=np.int64)
        end = np.append(begin[1:], len(points))
        up, down = _powers(len(points) + 1)
        total = np.zeros(len(points) + 1, dtype=np.uint64)
        values = points.astype(np.uint64) + np.uint64(1)
        np.cumsum(values * up[: len(points)], out=total[1:])
        key = (total[end] - total[begin]) * down[begin]
        values ^= values << np.uint64(23)
        values *= np.uint64(0xD6E8FEB86659FD93)
        np.cumsum(values, out=total[1:])
        second = (total[end] - total[begin]) ^ (end - begin).astype(np.uint64)
        key ^= key >> np.uint64(31)
        order = np.argsort(key)
        sorted_key = key[order]
        new_key = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
        head = order[new_key]  # one piece of each hash
        group = np.empty(len(key), dtype=np.int64)
        group[order] = np.cumsum(new_key) - 1
        distinct = sorted_key[new_key]
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == distinct if len(self.hashes) else np.zeros(len(distinct), dtype=bool)
        fresh = np.flatnonzero(~known)
        number = np.empty(len(distinct), dtype=np.int64)
        number[known] = self.numbers[at[known]]
        number[fresh] = self.count + np.arange(len(fresh))
        sums = second[head]
        sums[known] = self.sums[at[known]]
        out = number[group]
        clash = np.flatnonzero(second != sums[group])  # another piece with this hash: it gets a number of its own
        out[clash] = self.count + len(fresh) + np.arange(len(clash))
        told = np.concatenate([head[fresh], clash])
        if len(told):
            self.learn([joined[a:b] for a, b in zip(begin[told].tolist(), end[told].tolist(), strict=True)])
            self.count += len(told)
        if len(fresh):
            place = np.searchsorted(self.hashes, distinct[fresh])
            self.hashes = np.insert(self.hashes, place, distinct[fresh])
            self.sums = np.insert(self.sums, place, sums[fresh])
            self.numbers = np.insert(self.numbers, place, number[fresh])
        edges = np.searchsorted(begin, np.cumsum(sizes))
        return out, np.diff(edges, prepend=0)
