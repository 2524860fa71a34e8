"""Polygon validity of whole columns: reason and place of the first fault, with exact predicates.

Segments of all geometries of a batch are compared together: those of small geometries pairwise, those of large ones within
slabs, in which only segments whose spans overlap meet. Orientations are taken in double precision with an error bound and in rational
numbers where that does not settle the sign. Rules: rings do not touch or cross themselves; rings of a geometry meet only in
points, without crossing; holes lie in their shell and not in each other; shells do not lie in each other but in holes; no touching rings
cut an interior in two. Repeated vertices are no fault.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Faults in the order in which they are reported, in the words that geometry libraries use (fixed values).
INVALID_COORDINATE = "Invalid Coordinate"
TOO_FEW = "Too few points in geometry component"
SELF = "Self-intersection"
RING_SELF = "Ring Self-intersection"
OUTSIDE = "Hole lies outside shell"
NESTED_HOLES = "Nested holes"
NESTED_SHELLS = "Nested shells"
DISCONNECTED = "Interior is disconnected"

#: Geometries of up to so many segments are compared pairwise; points that are compared together.
PAIRWISE = 48
BATCH_POINTS = 50_000
_BOUND = 4e-16
Fault = tuple[str, float, float]


def orientation(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Sign of the turn a, b, c for rows of points, exact."""
    with np.errstate(over="ignore", invalid="ignore"):
        one, two = (b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]), (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])
        det, size = one - two, np.abs(one) + np.abs(two)
        sign = np.sign(det)
        unsure = ~(np.abs(det) > _BOUND * size + 1e-290)
    for i in np.flatnonzero(unsure):
        (ax, ay), (bx, by), (cx, cy) = (map(Fraction, map(float, p[i])) for p in (a, b, c))
        exact = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
        sign[i] = (exact > 0) - (exact < 0)
    return sign


def turn(a, b, c) -> int:
    return int(orientation(np.array([a], float), np.array([b], float), np.array([c], float))[0])


def _slab_pairs(lo: np.ndarray, hi: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of segments (left to right, sorted by x within each) that share a slab and overlap in y there."""
    n = len(left)
    cuts = np.quantile(np.concatenate([left[:, 0], right[:, 0]]), np.linspace(0, 1, int(np.sqrt(n)) + 1))
    cuts[0], cuts[-1] = -np.inf, np.inf
    out = []
    for x0, x1 in zip(cuts[:-1], cuts[1:], strict=True):
        here = np.flatnonzero((left[:, 0] <= x1) & (right[:, 0] >= x0))
        if not len(here):
            continue
        p, q = left[here], right[here]
        with np.errstate(divide="ignore", invalid="ignore"):
            slope = np.where(q[:, 0] > p[:, 0], (q[:, 1] - p[:, 1]) / (q[:, 0] - p[:, 0]), 0.0)
        at = lambda x: np.where(q[:, 0] > p[:, 0], p[:, 1] + (np.clip(x, p[:, 0], q[:, 0]) - p[:, 0]) * slope, 0.0)  # noqa: B023, E731
        upright = ~(q[:, 0] > p[:, 0])
        y0, y1 = at(x0), at(x1)
        room = 1e-12 * (np.abs(p[:, 1]) + np.abs(q[:, 1]) + np.abs(slope) * (np.abs(p[:, 0]) + np.abs(q[:, 0])))
        low = np.maximum(np.where(upright, -np.inf, np.minimum(y0, y1) - room), lo[here])
        high = np.minimum(np.where(upright, np.inf, np.maximum(y0, y1) + room), hi[here])
        order = low.argsort()
        last = np.searchsorted(low[order], high[order], side="right")
        count = np.maximum(last - np.arange(len(order)) - 1, 0)
        i = np.repeat(np.arange(len(order)), count)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        out.append(np.sort(np.stack([here[order[i]], here[order[j]]], axis=1), axis=1))
    pairs = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), int)
    return pairs[:, 0], pairs[:, 1]


def _pairs(a: np.ndarray, b: np.ndarray, starts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of segments of one geometry whose boxes overlap; geometry k has the segments starts[k] to starts[k + 1]."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    firsts, seconds = [], []
    for n in sorted({e - s for s, e in zip(starts, starts[1:], strict=False)}):
        at = np.array([s for s, e in zip(starts, starts[1:], strict=False) if e - s == n])
        if n <= PAIRWISE:
            i, j = np.triu_indices(n, 1)
            firsts.append((at[:, None] + i).ravel())
            seconds.append((at[:, None] + j).ravel())
            continue
        for s in at:
            turned = (a[s : s + n, 0] > b[s : s + n, 0])[:, None]
            p, q = np.where(turned, b[s : s + n], a[s : s + n]), np.where(turned, a[s : s + n], b[s : s + n])
            i, j = _slab_pairs(low[s : s + n, 1], high[s : s + n, 1], p, q)
            firsts.append(s + i)
            seconds.append(s + j)
    i, j = (np.concatenate(x) if x else np.zeros(0, int) for x in (firsts, seconds))
    meet = ((low[i] <= high[j]) & (low[j] <= high[i])).all(axis=1)
    return i[meet], j[meet]


def _between(p, u, v, d) -> bool:
    """Whether direction p-d is strictly inside the turn from p-u counter-clockwise to p-v; no two directions are equal."""
    side = turn(p, u, v)
    if side > 0 or (side == 0 and (u[0] - p[0]) * (v[0] - p[0]) + (u[1] - p[1]) * (v[1] - p[1]) < 0):
        return turn(p, u, d) > 0 and (side == 0 or turn(p, d, v) > 0)
    return not (turn(p, v, d) > 0 and turn(p, d, u) > 0)


def locate(point, ring: np.ndarray) -> int:
    """1 inside a closed ring, 0 on it, -1 outside."""
    a, b = ring[:-1], ring[1:]
    p = np.broadcast_to(np.array(point, float), a.shape)
    side = orientation(a, b, p)
    low, high = np.minimum(a, b), np.maximum(a, b)
    if ((side == 0) & (p >= low).all(axis=1) & (p <= high).all(axis=1)).any():
        return 0
    up, down = (a[:, 1] <= p[:, 1]) & (p[:, 1] < b[:, 1]), (b[:, 1] <= p[:, 1]) & (p[:, 1] < a[:, 1])
    return 1 if ((up & (side > 0)).sum() + (down & (side < 0)).sum()) % 2 else -1


def _inside(inner: np.ndarray, outer: np.ndarray) -> bool:
    """Whether a ring lies inside another one that it does not cross: by its first vertex, or middle of a side, not on it."""
    if (inner.min(axis=0) < outer.min(axis=0)).any() or (inner.max(axis=0) > outer.max(axis=0)).any():
        return False
    for p in (*inner[:-1], *((inner[:-1] + inner[1:]) / 2)):
        where = locate(p, outer)
        if where:
            return where > 0
    return True


class _Shape:
    """A geometry's distinct-vertex rings, and where its segments meet."""

    def __init__(self, parts: list):
        self.faults: list[Fault] = []
        self.rings: list[np.ndarray] = []
        self.parts: list[list[int]] = []
        for part in parts:
            mine = []
            for ring in part:
                p = np.array(ring, dtype=float).reshape(-1, 2)
                bad = ~np.isfinite(p).all(axis=1)
                if bad.any():
                    self.faults.append((INVALID_COORDINATE, *map(float, p[bad][0])))
                    continue
                p = p[np.concatenate([[True], (p[1:] != p[:-1]).any(axis=1)])] if len(p) else p
                if len(p) < 4:
                    self.faults.append((TOO_FEW, *(map(float, p[0]) if len(p) else (float("nan"),) * 2)))
                    continue
                mine.append(len(self.rings))
                self.rings.append(p)
            self.parts.append(mine)
        self.touches: set[tuple[float, float, int, int]] = set()

    def neighbours(self, ring: int, segment: int, p: tuple[float, float]):
        """The vertices before and after a point of a segment of a ring."""
        r = self.rings[ring]
        a, b = tuple(r[segment]), tuple(r[segment + 1])
        if p == a:
            return tuple(r[segment - 1] if segment else r[-2]), b
        return (a, tuple(r[segment + 2] if segment + 2 < len(r) else r[1])) if p == b else (a, b)

    def fault(self) -> Fault | None:
        """The first fault by kind, then by place."""
        order = (INVALID_COORDINATE, TOO_FEW, SELF, RING_SELF)
        return min(self.faults, key=lambda f: (order.index(f[0]), f[1:])) if self.faults else self.nesting() or self.connection()

    def enclosed(self, rings: list[int]) -> Iterator[tuple[int, int]]:
        """Pairs of places in a list of rings of which the first lies inside the second."""
        low, high = (np.array([f(self.rings[r], axis=0) for r in rings]) for f in (np.min, np.max))
        for k in range(len(rings)):
            for o in np.flatnonzero(((low <= low[k]) & (high >= high[k])).all(axis=1)):
                if o != k and _inside(self.rings[rings[k]], self.rings[rings[o]]):
                    yield k, int(o)

    def nesting(self) -> Fault | None:
        shells = [(mine[0], mine[1:]) for mine in self.parts if mine]
        place = lambda ring: tuple(map(float, self.rings[ring][0]))
        for shell, holes in shells:
            for h in holes:
                if not _inside(self.rings[h], self.rings[shell]):
                    return OUTSIDE, *place(h)
            if len(holes) > 1:
                for k, _ in self.enclosed(holes):
                    return NESTED_HOLES, *place(holes[k])
        if len(shells) > 1:
            for k, o in self.enclosed([shell for shell, _ in shells]):
                if not any(_inside(self.rings[shells[k][0]], self.rings[h]) for h in shells[o][1]):
                    return NESTED_SHELLS, *place(shells[k][0])
        return None

    def connection(self) -> Fault | None:
        """A cycle of touching rings of one polygon."""
        part_of = {ring: k for k, mine in enumerate(self.parts) for ring in mine}
        root: dict = {}

        def find(k):
            while root.setdefault(k, k) != k:
                k = root[k]
            return k

        ends = {(r, x, y) for x, y, one, two in self.touches if part_of[one] == part_of[two] for r in (one, two)}
        for r, x, y in sorted(ends, key=lambda e: (e[1], e[2], e[0])):
            ring, point = find(r), find((part_of[r], x, y))
            if ring == point:
                return DISCONNECTED, x, y
            root[ring] = point
        return None


def _plainly_sound(shapes: list[list | None]) -> np.ndarray:
    """Which geometries are one small ring without any fault: closed, its sides meeting at their ends alone, none turning back.

    Rings of one length are looked at together; a ring that is not settled here may be sound all the same.
    """
    out = np.zeros(len(shapes), dtype=bool)
    single = [(i, np.asarray(parts[0][0], dtype=float)) for i, parts in enumerate(shapes) if parts is not None and len(parts) == 1 and len(parts[0]) == 1 and 4 <= len(parts[0][0]) <= PAIRWISE]
    by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, ring in single:
        by_length.setdefault(len(ring), []).append((i, ring))
    for n, some in by_length.items():
        step = max(1, 2_000_000 // (n * n))
        for k in range(0, len(some), step):
            at = np.array([i for i, _ in some[k : k + step]])
            out[at] = _sound_rings(np.stack([ring for _, ring in some[k : k + step]]))
    return out


def _sound_rings(rings: np.ndarray) -> np.ndarray:
    """For rings of one length (ring, vertex, coordinate), those without any fault; repeated vertices and straight angles are left to others."""
    with np.errstate(invalid="ignore"):
        good = np.isfinite(rings).all(axis=(1, 2)) & (rings[:, 0] == rings[:, -1]).all(axis=1) & (rings[:, 1:] != rings[:, :-1]).any(axis=2).all(axis=1)
    at = np.flatnonzero(good)
    a, b = rings[at, :-1], rings[at, 1:]
    m = a.shape[1]
    i, j = np.triu_indices(m, 1)
    beside = (j - i == 1) | (j - i == m - 1)
    ok = np.ones(len(at), dtype=bool)
    # Sides that follow each other make a turn, so that they meet in their common end alone.
    nxt = np.roll(b, -1, axis=1)
    ok &= (orientation(a.reshape(-1, 2), b.reshape(-1, 2), nxt.reshape(-1, 2)).reshape(-1, m) != 0).all(axis=1)
    i, j = i[~beside], j[~beside]
    low, high = np.minimum(a, b), np.maximum(a, b)
    near = ((low[:, i] <= high[:, j]) & (low[:, j] <= high[:, i])).all(axis=2)
    shape, pair = np.nonzero(near)
    p, q, r, s = a[shape, i[pair]], b[shape, i[pair]], a[shape, j[pair]], b[shape, j[pair]]
    meet = (orientation(p, q, r) * orientation(p, q, s) <= 0) & (orientation(r, s, p) * orientation(r, s, q) <= 0)
    ok[shape[meet]] = False
    good[at] = ok
    return good


def faults(shapes: list[list | None]) -> list[Fault | None]:
    """The first fault of each geometry (a list of parts of closed rings), or None."""
    sound = _plainly_sound(shapes)
    if sound.any():
        rest = iter(faults([parts for parts, fine in zip(shapes, sound, strict=True) if not fine]))
        return [None if fine else next(rest) for fine in sound]
    found = [None if parts is None else _Shape(parts) for parts in shapes]
    whole = [s for s in found if s is not None and not s.faults and s.rings]
    starts, ring_no, seg_no, size, owner, a, b = [0], [], [], [], [], [], []
    for s in whole:
        for k, r in enumerate(s.rings):
            n = len(r) - 1
            a.append(r[:-1])
            b.append(r[1:])
            ring_no.append(np.full(n, k))
            seg_no.append(np.arange(n))
            size.append(np.full(n, n))
        owner.append(np.full(sum(len(r) - 1 for r in s.rings), len(owner)))
        starts.append(starts[-1] + len(owner[-1]))
    if whole:
        a, b, ring_no, seg_no, size, owner = map(np.concatenate, (a, b, ring_no, seg_no, size, owner))
        _meetings(whole, a, b, ring_no, seg_no, size, owner, starts)
    return [s and s.fault() for s in found]


def _meetings(whole: list[_Shape], a, b, ring_no, seg_no, size, owner, starts) -> None:
    """Record crossings, overlaps and touches of the segments in their shapes."""
    i, j = _pairs(a, b, starts)
    p, q, r, s = a[i], b[i], a[j], b[j]
    of_r, of_s, of_p, of_q = orientation(p, q, r), orientation(p, q, s), orientation(r, s, p), orientation(r, s, q)
    meet = (of_r * of_s <= 0) & (of_p * of_q <= 0)
    i, j, p, q, r, s, of_r, of_s, of_p, of_q = (x[meet] for x in (i, j, p, q, r, s, of_r, of_s, of_p, of_q))
    proper = (of_r * of_s < 0) & (of_p * of_q < 0)
    for k in np.flatnonzero(proper):
        d, e, f = q[k] - p[k], s[k] - r[k], r[k] - p[k]
        t = (f[0] * e[1] - f[1] * e[0]) / (d[0] * e[1] - d[1] * e[0] or 1.0)
        whole[owner[i[k]]].faults.append((SELF, float(p[k][0] + t * d[0]), float(p[k][1] + t * d[1])))
    level = (of_r == 0) & (of_s == 0)
    low, high = np.maximum(np.minimum(p, q), np.minimum(r, s)), np.minimum(np.maximum(p, q), np.maximum(r, s))
    near = (low <= high).all(axis=1)
    overlap = level & near & (low < high).any(axis=1)
    for k in np.flatnonzero(overlap):
        ends = sorted(tuple(map(float, e)) for e in (p[k], q[k], r[k], s[k]))
        whole[owner[i[k]]].faults.append((SELF, *ends[1]))
    same = ring_no[i] == ring_no[j]
    step = np.abs(seg_no[i] - seg_no[j])
    joined = same & ((step == 1) | (step == size[i] - 1))
    for k in np.flatnonzero(~proper & ~overlap & near & ~joined):
        shape = whole[owner[i[k]]]
        within = lambda e, o: bool((np.minimum(*o) <= e).all() and (e <= np.maximum(*o)).all())
        ends = ((r[k], of_r[k], (p[k], q[k])), (s[k], of_s[k], (p[k], q[k])), (p[k], of_p[k], (r[k], s[k])), (q[k], of_q[k], (r[k], s[k])))
        at = next((tuple(map(float, e)) for e, side, other in ends if side == 0 and within(e, other)), None)
        if at is None:
            continue
        one, two = int(ring_no[i[k]]), int(ring_no[j[k]])
        if one == two:
            shape.faults.append((RING_SELF, *at))
            continue
        u, v = shape.neighbours(one, int(seg_no[i[k]]), at)
        c, d = shape.neighbours(two, int(seg_no[j[k]]), at)
        # Equal directions are overlaps, which are faults already.
        if len({_direction(at, e) for e in (u, v, c, d)}) == 4 and _between(at, u, v, c) != _between(at, u, v, d):
            shape.faults.append((SELF, *at))
        shape.touches.add((*at, one, two))


def _direction(p, e) -> tuple:
    """Equal for points in one direction of p."""
    x, y = Fraction(e[0]) - Fraction(p[0]), Fraction(e[1]) - Fraction(p[1])
    length = max(abs(x), abs(y))
    return x / length, y / length


_SCHEMA = T.StructType([T.StructField("reason", T.StringType()), T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


def _rings_of(shapes: pa.Array) -> Iterator[list | None]:
    """Parts as lists of arrays of points; a vertex without a number is not finite."""
    parts = shapes.values
    rings = parts.values
    points = rings.values
    xy = np.stack([points.field(n).to_numpy(zero_copy_only=False).astype(float) for n in ("x", "y")], axis=1)
    at_part, at_ring, at_point = (x.offsets.to_numpy() for x in (shapes, parts, rings))
    for i, known in enumerate(shapes.is_valid().to_pylist()):
        yield [[xy[at_point[r] : at_point[r + 1]] for r in range(at_ring[p], at_ring[p + 1])] for p in range(at_part[i], at_part[i + 1])] if known else None


@F.arrow_udf(_SCHEMA)
def first_fault(shapes: pa.Array) -> pa.Array:
    """struct(reason, x, y) of the first fault of a column of parts, null for a valid geometry; a null geometry gives null."""
    found: list[Fault | None] = []
    some: list[list | None] = []
    size = 0
    for shape in _rings_of(shapes):
        some.append(shape)
        size += sum(len(r) for part in shape or () for r in part)
        if size > BATCH_POINTS:
            found, some, size = found + faults(some), [], 0
    found += faults(some)
    kind = pa.struct([("reason", pa.string()), ("x", pa.float64()), ("y", pa.float64())])
    return pa.array([None if f is None else dict(zip(("reason", "x", "y"), f, strict=True)) for f in found], kind)


