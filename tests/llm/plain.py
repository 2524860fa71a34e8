"""Plain Python versions of what the operators compute, by their contracts alone."""

import hashlib
import re
from collections import defaultdict

import xxhash

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def lower(text):
    return ascii_lower(text or "")


def words(text):
    return re.findall(WORD, lower(text))


def windows_of(items):
    """Windows of (item, text) rows, with the items they are of."""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add("null" if item is None else str(item))
    return windows


def hits(text, windows):
    """(hit word numbers, items) of a text."""
    w, hit, items = words(text), set(), set()
    for n in {len(k) for k in windows}:
        for i in range(len(w) - n + 1):
            if found := windows.get(tuple(w[i : i + n])):
                items |= found
                hit.update(range(i, i + n))
    return hit, items


def without_hits(text, hit):
    """The text without the stretches from the first to the last of neighbouring hit words."""
    at = [m.span() for m in re.finditer(WORD, lower(text))]
    out, end = [], 0
    for i in sorted(hit):
        if i - 1 not in hit:
            out.append(text[end : at[i][0]])
        end = at[i][1]
    return "".join([*out, text[end:]])


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(prints, distance=4):
    """The number of a component for each fingerprint."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def largest_id_of_equal_texts(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append((i, t))
    out = []
    for same in groups.values():
        keep = max((i for i, _ in same if i is not None), default=None)
        out.append(next(r for r in same if r[0] == keep))
    return out


def one_of_each_component(rows):
    prints = sorted({fingerprint(t) for _, t in rows})
    root = dict(zip(prints, components(prints), strict=True))
    best = {}
    for r in rows:
        rank = (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).digest())
        k = root[fingerprint(r[1])]
        if k not in best or rank < best[k][0]:
            best[k] = (rank, r)
    return [r for _, r in best.values()]
