"""Geographic columns: equal-area projection, WKT, bounds, centroids, containment.

A geometry is an array of parts, a part an array of rings (the first its shell, the others holes), a ring an array of
(x, y) structs; bounds, projection and centroids, and quick parsing of well-formed WKT, are built-in higher-order functions.
``reader`` reads any text and says what is wrong with it, ``validity`` finds what is wrong with a polygon. ``covers`` tests points
against the union of polygons with holes, exactly.
"""

from __future__ import annotations

import json
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import validity

#: WGS84 ellipsoid, and the centre of the projection (latitude 0).
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
CENTRE_LONGITUDE = 37.5
ECCENTRICITY = math.sqrt(FLATTENING * (2 - FLATTENING))


def authalic_q(sin_lat: Column | float):
    """q of the ellipsoid at a latitude given by its sine (Snyder, equation 3-12)."""
    e = ECCENTRICITY
    log = (lambda v: F.log(v)) if isinstance(sin_lat, Column) else math.log
    return (1 - e * e) * (sin_lat / (1 - e * e * sin_lat * sin_lat) - log((1 - e * sin_lat) / (1 + e * sin_lat)) / (2 * e))


def project(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Lambert azimuthal equal-area coordinates in metres, centred on the equator at ``CENTRE_LONGITUDE``."""
    q_pole = authalic_q(1.0)
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), authalic_q(F.sin(F.radians(lat))) / q_pole)))
    radius = SEMI_MAJOR * math.sqrt(q_pole / 2)
    # With the centre on the equator the scale D at the centre is a / (radius * cos(0)).
    d = SEMI_MAJOR / radius
    dlon = F.radians(lon - F.lit(CENTRE_LONGITUDE))
    b = radius * F.sqrt(F.try_divide(F.lit(2.0), 1 + F.cos(beta) * F.cos(dlon)))  # null opposite the centre
    return b * d * F.cos(beta) * F.sin(dlon), b / d * F.sin(beta)


_RING = r"\(([^()]*)\)"
_PART = r"\(\s*(\([^()]*\)(?:\s*,\s*\([^()]*\))*)\s*\)"


def wkt_parts(wkt: Column) -> Column:
    """Parts of a POLYGON or MULTIPOLYGON text; a number that does not parse is null."""

    def points(text: Column) -> Column:
        return F.transform(F.split(F.trim(text), r"\s*,\s*"), lambda p: F.struct(F.get(F.split(F.trim(p), r"\s+"), F.lit(0)).try_cast("double").alias("x"), F.get(F.split(F.trim(p), r"\s+"), F.lit(1)).try_cast("double").alias("y")))

    return F.transform(F.regexp_extract_all(wkt, F.lit(_PART), F.lit(1)), lambda part: F.transform(F.regexp_extract_all(part, F.lit(_RING), F.lit(1)), points))


def wkt_rings(wkt: Column) -> Column:
    """The rings of all parts."""
    return F.flatten(wkt_parts(wkt))


def project_parts(parts: Column) -> Column:
    """The same parts with projected vertices."""

    def projected(p: Column) -> Column:
        x, y = project(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(parts, lambda part: F.transform(part, lambda ring: F.transform(ring, projected)))


def wkt_type(wkt: Column) -> Column:
    return F.upper(F.regexp_extract(wkt, r"^\s*([A-Za-z]+)", 1))


#: Geometry types of WKT (fixed values).
WKT_TYPES = ("POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON", "GEOMETRYCOLLECTION")


def wkt_error(wkt: Column) -> Column:
    """Why a WKT text does not parse, in words, or null: an unknown type, unmatched parentheses, a vertex without
    numbers, text after the geometry. Quick and built-in; ``reader.parse_geometry`` gives the place as well."""
    kind = wkt_type(wkt)
    many = lambda c: F.length(wkt) - F.length(F.replace(wkt, F.lit(c), F.lit("")))
    loose = F.exists(wkt_rings(wkt), lambda r: F.exists(r, lambda p: p["x"].isNull() | p["y"].isNull()))
    return (
        F.when(kind == "", "no geometry type")
        .when(~kind.isin(*WKT_TYPES), F.concat(F.lit("unknown geometry type "), kind))
        .when(many("(") != many(")"), F.concat_ws(" ", many("(").cast("string"), F.lit("opening and"), many(")").cast("string"), F.lit("closing parentheses")))
        .when(loose, "a vertex without two numbers")
        .when(F.regexp_extract(wkt, r"\)([^()]*)$", 1).rlike(r"\S"), "text after the geometry")
    )


def bounds(rings: Column) -> list[Column]:
    """min x, min y, max x, max y of all vertices."""
    xs = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["x"])))
    ys = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["y"])))
    return [F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)]


def all_finite(rings: Column) -> Column:
    ok = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return F.forall(rings, lambda r: F.forall(r, lambda p: ok(p["x"]) & ok(p["y"])))


def ring_problem(rings: Column) -> Column:
    """``malformed_geometry`` (a vertex without two numbers), ``empty_geometry``, ``invalid_geometry`` (a ring that is short,
    open or without area), or null."""
    nulls = F.exists(rings, lambda r: F.exists(r, lambda p: p["x"].isNull() | p["y"].isNull()))
    bad = F.exists(rings, lambda r: (F.size(r) < 4) | (F.element_at(r, 1) != F.element_at(r, -1)))
    flat = F.exists(rings, lambda r: ring_moments(r)["a"] == 0)
    return F.when(F.size(rings) == 0, "empty_geometry").when(nulls, "malformed_geometry").when(bad, "invalid_geometry").when(flat, "invalid_geometry")


def ring_moments(ring: Column) -> Column:
    """struct(a, cx, cy): twice the signed area, and the sums that give the centroid."""
    n = F.size(ring)
    pair = F.zip_with(F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1), lambda p, q: F.struct((p["x"] * q["y"] - q["x"] * p["y"]).alias("k"), (p["x"] + q["x"]).alias("sx"), (p["y"] + q["y"]).alias("sy")))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))
    return F.aggregate(pair, zero, lambda s, e: F.struct((s["a"] + e["k"]).alias("a"), (s["cx"] + e["k"] * e["sx"]).alias("cx"), (s["cy"] + e["k"] * e["sy"]).alias("cy")))


def _moments(parts: Column) -> Column:
    """Sums over all rings, shells counting as positive and holes as negative whatever their direction."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))
    rings = F.flatten(F.transform(parts, lambda part: F.transform(part, lambda r, i: F.struct(ring_moments(r).alias("m"), F.when(i == 0, 1.0).otherwise(-1.0).alias("sign")))))
    return F.aggregate(
        rings,
        zero,
        lambda s, e: F.struct(
            (s["a"] + e["sign"] * F.abs(e["m"]["a"])).alias("a"),
            (s["cx"] + e["sign"] * F.signum(e["m"]["a"]) * e["m"]["cx"]).alias("cx"),
            (s["cy"] + e["sign"] * F.signum(e["m"]["a"]) * e["m"]["cy"]).alias("cy"),
        ),
    )


def area(parts: Column) -> Column:
    """Area of all parts, less their holes."""
    return _moments(parts)["a"] / 2


def centroid(parts: Column) -> tuple[Column, Column]:
    """Area centroid of all parts, less their holes; null for a geometry without area."""
    total = _moments(parts)
    return F.try_divide(total["cx"], 3 * total["a"]), F.try_divide(total["cy"], 3 * total["a"])


Ring = list[tuple[float, float]]


def check_polygons(polygons: list[list[Ring]]) -> list[list[Ring]]:
    """The polygons; raises for one that has an open ring or is not valid."""
    for rings in polygons:
        for ring in rings:
            if len(ring) < 4 or tuple(ring[0]) != tuple(ring[-1]):
                raise ValueError("a boundary ring is not closed")
    for fault in validity.faults([[rings] for rings in polygons]):
        if fault:
            raise ValueError(f"a boundary ring is not valid: {fault[0]} at {fault[1]} {fault[2]}")
    return polygons


def covers(polygons: list[list[Ring]]):
    """An Arrow UDF (x, y) -> whether a point is in or on the union of polygons (shell, holes ...), null for no point.

    Points on a border, of a hole too, are covered. Sides are decided in double precision with an error bound, and in
    rational numbers where that does not settle them. The polygons travel with the function: a border is a bounded table.
    """
    shapes = []
    for rings in check_polygons(polygons):
        p = [np.array(r, dtype=float) for r in rings]
        shapes.append((np.concatenate([r[:-1] for r in p]), np.concatenate([r[1:] for r in p])))

    def within(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        ax, ay, bx, by = a[:, 0], a[:, 1], b[:, 0], b[:, 1]
        px, py = x[:, None], y[:, None]
        one, two = (bx - ax) * (py - ay), (by - ay) * (px - ax)
        side = one - two
        near_y = (py >= np.minimum(ay, by)) & (py <= np.maximum(ay, by))
        unsure = near_y & (np.abs(side) <= 1e-14 * (np.abs(one) + np.abs(two) + np.abs(px) + np.abs(py)) + 1e-300)
        for i, k in zip(*np.nonzero(unsure), strict=True):
            f = Fraction
            exact = (f(bx[k]) - f(ax[k])) * (f(y[i]) - f(ay[k])) - (f(by[k]) - f(ay[k])) * (f(x[i]) - f(ax[k]))
            side[i, k] = (exact > 0) - (exact < 0)
        on = near_y & (side == 0) & (px >= np.minimum(ax, bx)) & (px <= np.maximum(ax, bx))
        up, down = (ay <= py) & (py < by), (by <= py) & (py < ay)
        crossed = (up & (side > 0)) | (down & (side < 0))
        return on.any(axis=1) | (crossed.sum(axis=1) % 2 == 1)

    @F.arrow_udf(T.BooleanType())
    def run(xs: pa.Array, ys: pa.Array) -> pa.Array:
        x, y = (c.to_numpy(zero_copy_only=False).astype(float) for c in (xs, ys))
        known = np.isfinite(x) & np.isfinite(y)
        at = np.flatnonzero(known)
        found = np.zeros(len(x), dtype=bool)
        for a, b in shapes:
            step = max(1, 1_000_000 // len(a))
            for lo in range(0, len(at), step):
                some = at[lo : lo + step]
                found[some] |= within(a, b, x[some], y[some])
        return pa.array(found, mask=~known)

    return run


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def geojson_bounds(texts: pa.Array) -> pa.Array:
    """min x, min y, max x, max y of all positions of a GeoJSON text at any depth; null if it has none."""

    def bounds_of(text: str | None) -> list[float] | None:
        try:
            todo = [json.loads(text)] if text is not None else []
        except ValueError:
            return None
        xs, ys = [], []
        while todo:
            v = todo.pop()
            if isinstance(v, dict):
                todo += [v[k] for k in ("coordinates", "geometry", "geometries", "features") if k in v]
            elif isinstance(v, list) and len(v) > 1 and all(isinstance(n, (int, float)) and not isinstance(n, bool) for n in v[:2]):
                xs.append(float(v[0]))
                ys.append(float(v[1]))
            elif isinstance(v, list):
                todo += v
        return [min(xs), min(ys), max(xs), max(ys)] if xs else None

    return pa.array([bounds_of(t) for t in texts.to_pylist()], pa.list_(pa.float64()))


@F.arrow_udf(T.BooleanType())
def self_crossing(rings: pa.Array) -> pa.Array:
    """Whether some ring by itself touches or crosses itself; null for null."""
    out = []
    for some in rings.to_pylist():
        found = validity.faults([[[[tuple(math.nan if v is None else v for v in (p["x"], p["y"])) for p in ring]]] for ring in some or ()])
        out.append(None if some is None else any(f is not None and f[0] in (validity.SELF, validity.RING_SELF) for f in found))
    return pa.array(out, pa.bool_())
