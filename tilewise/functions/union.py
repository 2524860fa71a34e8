"""The union of polygons as an outline: arrangement of all sides, the parts of them that border the union, and their rings.

Sides are cut where they meet, in rational numbers. A piece of a side borders the union if no polygon holds its middle and all
polygons that it bounds lie on one side of it. Pieces are joined to rings with the union on their left: shells run
counter-clockwise, holes clockwise. A boundary is a bounded table, so its union is made at once; ``unions`` makes one per group.
"""

from __future__ import annotations

from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import validity
from .geometry import Ring, check_polygons
from .reader import nested_array

Point = tuple[Fraction, Fraction]


def _cross(o: Point, a: Point, b: Point) -> Fraction:
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def ring_area(ring: list[Point]) -> Fraction:
    """Signed area: positive if the ring runs counter-clockwise."""
    return sum(((a[0] * b[1] - b[0] * a[1]) for a, b in zip(ring, ring[1:], strict=False)), Fraction(0)) / 2


def _sides(polygons: list[list[Ring]]) -> tuple[list[tuple[Point, Point]], np.ndarray]:
    """All sides with the polygon on their left, and the polygon of each; repeated vertices give none."""
    sides, owner = [], []
    for k, rings in enumerate(polygons):
        for i, ring in enumerate(rings):
            points = [(Fraction(x), Fraction(y)) for x, y in ring]
            if (ring_area(points) > 0) != (i == 0):
                points = points[::-1]
            some = [(a, b) for a, b in zip(points, points[1:], strict=False) if a != b]
            sides += some
            owner += [k] * len(some)
    return sides, np.array(owner, dtype=np.int64)


def _cuts(sides: list[tuple[Point, Point]]) -> dict[int, set[Point]]:
    """Points at which each side is cut by others."""
    a, b = (np.array([[float(v) for v in s[i]] for s in sides]) for i in (0, 1))
    cuts: dict[int, set[Point]] = defaultdict(set)
    for i, j in zip(*(x.tolist() for x in validity._pairs(a, b, [0, len(sides)])), strict=True):
        (p, q), (r, s) = sides[i], sides[j]
        one, two, three, four = _cross(p, q, r), _cross(p, q, s), _cross(r, s, p), _cross(r, s, q)
        if one * two < 0 and three * four < 0:
            t = three / (three - four)
            at = (p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1]))
            cuts[i].add(at)
            cuts[j].add(at)
            continue
        for k, ends, point, side in ((i, (p, q), r, one), (i, (p, q), s, two), (j, (r, s), p, three), (j, (r, s), q, four)):
            if side == 0 and min(ends) < point < max(ends):
                cuts[k].add(point)
    return cuts


class _Shape:
    """A polygon that tells whether it holds a point that is on none of its sides."""

    def __init__(self, sides: list[tuple[Point, Point]]):
        self.sides = sides
        self.a, self.b = (np.array([[float(v) for v in s[i]] for s in sides]) for i in (0, 1))
        self.low, self.high = np.minimum(self.a, self.b).min(axis=0), np.maximum(self.a, self.b).max(axis=0)

    def holds(self, point: Point) -> bool:
        x, y = map(float, point)
        room = 1e-12 * (abs(x) + abs(y) + 1)
        if x < self.low[0] - room or x > self.high[0] + room or y < self.low[1] - room or y > self.high[1] + room:
            return False
        # Sides that are clearly above or below, or clearly left, are settled in doubles; the others exactly.
        near = (np.minimum(self.a[:, 1], self.b[:, 1]) <= y + room) & (np.maximum(self.a[:, 1], self.b[:, 1]) >= y - room) & (np.maximum(self.a[:, 0], self.b[:, 0]) >= x - room)
        inside = False
        for k in np.flatnonzero(near):
            a, b = self.sides[k]
            if (a[1] <= point[1]) != (b[1] <= point[1]):
                inside ^= (_cross(a, b, point) > 0) == (b[1] > a[1])
        return inside


def outline(polygons: list[list[Ring]]) -> tuple[list[Ring], float]:
    """Rings of the union of valid polygons (shell, holes ...), shells counter-clockwise and holes clockwise, and its area."""
    check_polygons(polygons)
    sides, owner = _sides(polygons)
    if not sides:
        return [], 0.0
    cuts = _cuts(sides)
    bounds: dict[tuple[Point, Point], list[tuple[int, bool]]] = defaultdict(list)
    for i, (a, b) in enumerate(sides):
        stops = sorted({a, b} | cuts.get(i, set()), reverse=a > b)
        for p, q in zip(stops, stops[1:], strict=False):
            bounds[min(p, q), max(p, q)].append((int(owner[i]), p < q))
    shapes = [_Shape([s for s, k in zip(sides, owner, strict=True) if k == n]) for n in range(len(polygons))]
    after: dict[Point, list[Point]] = defaultdict(list)
    for (p, q), found in bounds.items():
        ways = {way for _, way in found}
        middle = ((p[0] + q[0]) / 2, (p[1] + q[1]) / 2)
        own = {k for k, _ in found}
        if len(ways) == 1 and not any(s.holds(middle) for k, s in enumerate(shapes) if k not in own):
            start, stop = (p, q) if ways == {True} else (q, p)
            after[start].append(stop)
    rings = _traced(after)
    return [[(float(x), float(y)) for x, y in r] for r in rings], float(sum(map(ring_area, rings), Fraction(0)))


def _turn_order(back: Point, at: Point, to: Point) -> tuple:
    """Sorts directions clockwise from the one that points back."""
    d = (back[0] - at[0], back[1] - at[1])
    e = (to[0] - at[0], to[1] - at[1])
    sine, cosine = d[0] * e[1] - d[1] * e[0], d[0] * e[0] + d[1] * e[1]
    # Clockwise turns (negative sines) of under half a turn come first; within a half, by the cotangent.
    if sine == 0:
        return (1 if cosine < 0 else 3, Fraction(0))
    return (0 if sine < 0 else 2, -Fraction(cosine) / abs(sine) if sine < 0 else Fraction(cosine) / sine)


def _traced(after: dict[Point, list[Point]]) -> list[list[Point]]:
    """Rings of directed pieces, each taking the first piece clockwise from where it came; vertices within a straight side go."""
    rings = []
    for start in sorted(after):
        while after[start]:
            ring = [start, after[start].pop()]
            while ring[-1] != start:
                out = after[ring[-1]]
                best = min(range(len(out)), key=lambda i: _turn_order(ring[-2], ring[-1], out[i]))  # noqa: B023
                ring.append(out.pop(best))
            points = ring[:-1]
            kept = [p for i, p in enumerate(points) if _cross(points[i - 1], p, points[(i + 1) % len(points)]) != 0]
            rings.append([*kept, kept[0]])
    return rings


def unions(df: DataFrame, group: str, parts: str) -> DataFrame:
    """(group, rings, area): one union for each group of rows with a column of parts; a group is a bounded set of features.

    Null geometries are left out; one that is not valid raises.
    """
    kind = df.schema[group].dataType.simpleString()

    def made(some: pa.Table) -> pa.Table:
        polygons = [[[(p["x"], p["y"]) for p in ring] for ring in part] for shape in some["p"].to_pylist() if shape is not None for part in shape]
        rings, area = outline(polygons)
        return pa.table({group: some["g"][:1], "rings": nested_array([[rings]]).values, "area": pa.array([area], pa.float64())})

    rings = "array<array<struct<x:double,y:double>>>"
    return df.select(F.col(group).alias("g"), F.col(parts).alias("p")).groupBy("g").applyInArrow(made, f"`{group}` {kind}, rings {rings}, area double")


