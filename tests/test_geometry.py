"""Geometry texts and polygon validity: brute force over all segments, planted faults, texts broken at random."""

import json
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewise.functions import geometry, reader, validity
from tilewise.operators import footprints


def cross(o, a, b):
    return (Fraction(a[0]) - Fraction(o[0])) * (Fraction(b[1]) - Fraction(o[1])) - (Fraction(a[1]) - Fraction(o[1])) * (Fraction(b[0]) - Fraction(o[0]))


def shared(p, q, r, s):
    """The common points of two segments as one point, a pair of different points, or None, by clipping the first with rational numbers."""
    p, q, r, s = (tuple(map(Fraction, v)) for v in (p, q, r, s))
    if cross(p, q, r) == cross(p, q, s) == 0:
        a, b = sorted([p, q]), sorted([r, s])
        lo, hi = max(a[0], b[0]), min(a[1], b[1])
        return None if lo > hi else (lo if lo == hi else (lo, hi))
    one, two = cross(r, s, p), cross(r, s, q)
    three, four = cross(p, q, r), cross(p, q, s)
    if one * two > 0 or three * four > 0:
        return None
    t = Fraction(one) / (one - two)
    return (p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1]))


def brute_ring(ring):
    """Whether a ring crosses itself, only touches itself, or neither ('few': it has too few points)."""
    pts = [p for i, p in enumerate(ring) if i == 0 or p != ring[i - 1]]
    if len(pts) < 4:
        return "few"
    pts = [tuple(map(Fraction, p)) for p in pts]
    segs, touch = list(zip(pts, pts[1:], strict=False)), False
    n = len(segs)
    for i in range(n):
        for j in range(i + 1, n):
            at = shared(*segs[i], *segs[j])
            if at is None:
                continue
            if isinstance(at[0], tuple):
                return "cross"
            if j == i + 1 or (i == 0 and j == n - 1):
                continue
            inner = at not in segs[i] and at not in segs[j]
            if inner:
                return "cross"
            touch = True
    return "touch" if touch else None


WORDS = {"few": validity.TOO_FEW, "cross": validity.SELF, "touch": validity.RING_SELF, None: None}


def random_rings(n, seed, size=5):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        p = [(r.randrange(size), r.randrange(size)) for _ in range(r.randrange(3, 8))]
        out.append([*p, p[0]])
    return out


@pytest.mark.parametrize("pairwise", [48, 0])
def test_random_rings_equal_brute_force(monkeypatch, pairwise):
    monkeypatch.setattr(validity, "PAIRWISE", pairwise)
    rings = random_rings(1500, 1)
    got = [f and f[0] for f in validity.faults([[[r]] for r in rings])]
    assert got == [WORDS[brute_ring(r)] for r in rings]
    assert {w for w in got} == set(WORDS.values())


def test_near_collinear_vertices_are_decided_exactly():
    third = 1 / 3
    sliver = [(0.0, 0.0), (3.0, 1.0), (1.0, third), (0.0, 1.0), (0.0, 0.0)]  # (1, third) is off the first side by less than a rounding
    assert (cross((0.0, 0.0), (3.0, 1.0), (1.0, third)) > 0) == (brute_ring(sliver) is None)
    assert [f and f[0] for f in validity.faults([[[sliver]]])] == [WORDS[brute_ring(sliver)]]
    far = [(x * 1e15, y * 1e-15) for x, y in ((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))]
    assert validity.faults([[[far]]]) == [None]


def star(n, k=50):
    t = np.linspace(0, 2 * math.pi, n, endpoint=False)
    r = 10 + np.sin(k * t)
    p = list(zip((r * np.cos(t)).tolist(), (r * np.sin(t)).tolist(), strict=True))
    return [*p, p[0]]


def test_large_rings_go_by_slabs():
    ring = star(5000)
    crossed = [*ring[:2000], ring[2400], ring[2001], *ring[2002:]]
    comb = [(0.0, -1.0)] + [q for i in range(1000) for q in ((float(2 * i), 1000.0 + i), (float(2 * i + 1), float(i % 7)))] + [(2000.0, -1.0), (0.0, -1.0)]
    found = validity.faults([[[ring]], [[crossed]], [[comb]], [[comb, star(64)]]])
    assert found[0] is None and found[1][0] == validity.SELF and found[2] is None and found[3] is not None


def box(x, y, side, back=False):
    p = [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
    return p[::-1] if back else p


@pytest.mark.parametrize("back", [False, True])
def test_faults_of_rings_and_parts(back):
    frame = [box(0, 0, 10)]
    shapes = {
        "hole beside hole": ([[*frame, box(1, 1, 2, back), box(5, 5, 2)]], None),
        "holes that touch in a corner": ([[*frame, box(1, 1, 2, back), box(3, 3, 2)]], None),
        "holes that share a side": ([[*frame, box(1, 1, 2, back), box(3, 1, 2)]], validity.SELF),
        "equal holes": ([[*frame, box(1, 1, 2, back), box(1, 1, 2)]], validity.SELF),
        "hole in hole": ([[*frame, box(1, 1, 6, back), box(2, 2, 2)]], validity.NESTED_HOLES),
        "hole as shell": ([[*frame, box(0, 0, 10, back)]], validity.SELF),
        "hole around": ([[box(1, 1, 2), box(0, 0, 10, back)]], validity.OUTSIDE),
        "hole beside": ([[*frame, box(20, 1, 2, back)]], validity.OUTSIDE),
        "hole outside in a corner": ([[*frame, box(10, 10, 2, back)]], validity.OUTSIDE),
        "hole touches twice": ([[*frame, [(0, 5), (5, 0), (2, 5), (0, 5)][:: -1 if back else 1]]], validity.DISCONNECTED),
        "three holes in a circle": ([[*frame, [(2, 2), (4, 2), (3, 4), (2, 2)], [(4, 2), (6, 2), (5, 4), (4, 2)], [(3, 4), (5, 4), (4, 6), (3, 4)]]], validity.DISCONNECTED),
        "three holes in one point": ([[*frame, [(5, 5), (4, 7), (6, 7), (5, 5)], [(5, 5), (3, 5), (3, 4), (5, 5)], [(5, 5), (7, 5), (7, 4), (5, 5)]]], None),
        "vertex on a side": ([[*frame, [(0, 5), (2, 4), (2, 6), (0, 5)]]], None),
        "vertex through a side": ([[*frame, [(5, 5), (10, 6), (12, 5), (10, 4), (5, 5)]]], validity.SELF),
        "crossing in shared vertices": ([[box(0, 0, 4)], [[(4, 4), (6, 2), (2, 2), (4, 4)]]], validity.SELF),
        "parts apart": ([[box(0, 0, 2, back)], [box(5, 5, 2)]], None),
        "part in part": ([[box(0, 0, 9, back)], [box(5, 5, 2)]], validity.NESTED_SHELLS),
        "part in a hole": ([[box(0, 0, 9), box(1, 1, 7, back)], [box(2, 2, 2)]], None),
        "part fills a hole's corner": ([[box(0, 0, 9), box(1, 1, 7, back)], [box(1, 1, 2)]], validity.SELF),
        "parts in ring of parts": ([[box(0, 0, 9), box(1, 1, 7)], [box(2, 2, 5), box(3, 3, 3)], [box(4, 4, 1)]], None),
        "not finite": ([[[(0, 0), (math.inf, 0), (1, 1), (0, 0)]]], validity.INVALID_COORDINATE),
        "not a number": ([[[(0, 0), (math.nan, 0), (1, 1), (0, 0)]]], validity.INVALID_COORDINATE),
        "no parts": ([], None),
    }
    found = validity.faults([s for s, _ in shapes.values()])
    assert {k: f and f[0] for k, f in zip(shapes, found, strict=True)} == {k: w for k, (_, w) in shapes.items()}
    assert validity.faults([None]) == [None]


def test_column_of_shapes(spark):
    texts = ["POLYGON ((0 0, 0 0, 4 0, 4 4, 0 4, 0 0))", "POLYGON ((0 0, 4 4, 4 0, 0 4, 0 0))", "POINT (1 2)", "MULTIPOLYGON EMPTY", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("g", reader.parse_geometry(F.col("t"), "wkt"))
    got = df.select("i", "g.kind", "g.empty", validity.first_fault("g.parts").alias("f")).orderBy("i").collect()
    assert [(r.kind, r.empty, r.f and tuple(r.f)) for r in got] == [("POLYGON", False, None), ("POLYGON", False, (validity.SELF, 2.0, 2.0)), ("POINT", False, None), ("MULTIPOLYGON", True, None), (None, None, None)]


def wkt_of(parts):
    ring = lambda r: "(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")"
    return "MULTIPOLYGON (" + ", ".join("(" + ", ".join(map(ring, p)) + ")" for p in parts) + ")"


def random_parts(r):
    def ring():
        p = [(r.uniform(-9, 9), r.choice([0.0, -0.0, 1e-7, 1e22, 3.0])) for _ in range(r.randrange(3, 6))]
        return [*p, p[0]]

    return [[ring() for _ in range(r.randrange(1, 4))] for _ in range(r.randrange(1, 4))]


def test_texts_of_both_forms_round_trip():
    r = random.Random(2)
    for _ in range(300):
        parts = random_parts(r)
        for text, form in ((wkt_of(parts), "wkt"), (json.dumps({"type": "MultiPolygon", "coordinates": parts}), "geojson"), (json.dumps({"type": "Feature", "properties": {"a": 1}, "geometry": {"type": "MultiPolygon", "coordinates": parts}}), "geojson")):
            got = reader.read(text, form)
            assert got["parts"] == parts and got["kind"] == "MULTIPOLYGON" and not got["geometry_error"] and not got["record_error"]


def test_broken_texts_never_raise():
    r = random.Random(3)
    seen = set()
    for k in range(6000):
        parts = random_parts(r)
        form = ("wkt", "geojson")[k % 2]
        text = wkt_of(parts) if form == "wkt" else json.dumps({"type": "MultiPolygon", "coordinates": parts})
        at = r.randrange(len(text))
        cut = r.choice([text[:at], text[:at] + r.choice("x(),[]{}\"0 é\n-e") + text[at:], text[:at] + text[at + 1 :], text + r.choice([" x", ")", "]"])])
        got = reader.read(cut, form)
        error = got["geometry_error"] or got["record_error"]
        assert (error is None) != (got["kind"] is None) and len(error or "") <= reader.MOST_DETAIL
        seen.add(error is None)
    assert seen == {True, False}


def test_odd_texts():
    ok = {"  point ( 1 2 ) ": ("POINT", False), "POINT EMPTY": ("POINT", True), "GEOMETRYCOLLECTION (POINT (1 2), POLYGON EMPTY)": ("GEOMETRYCOLLECTION", False), "LINESTRING M (1 2 3, 4 5 6)": ("LINESTRING", False), "POINT (nan -Inf)": ("POINT", False), "MULTIPOLYGON (EMPTY)": ("MULTIPOLYGON", True), "POLYGON (EMPTY)": ("POLYGON", True), "POINT (.5 1.e3)": ("POINT", False)}
    assert {t: (reader.read(t, "wkt")["kind"], reader.read(t, "wkt")["empty"]) for t in ok} == ok
    for t in ("", " ", "POINT", "POINT (1)", "POINT (1 2 3 4 5)", "POINT (1 2,)", "POLYGON ((0 0, 1 1, 0 0))", "POLYGON ((0 0, 1 1, 2 0, 1 0))", "POINT (1 2) POINT (1 2)", "POINT (0x1 2)", "POINT (1e 2)", "LINESTRING (1 2; 3 4)", "(" * 5000, "GEOMETRYCOLLECTION (" * 3000, "١ POINT (1 2)"):
        assert reader.read(t, "wkt")["geometry_error"], t
    for t in ("", "[]", "1", "null", '{"type":"Polygon","coordinates":[[[0,0],[1,Infinity]]]}', "[" * 100000):
        assert reader.read(t, "geojson")["record_error"], t
    for t in ("{}", '{"type":"Polygon"}', '{"type":"Polygon","coordinates":null}', '{"type":"Polygon","coordinates":[[0,0]]}', '{"type":"Polygon","coordinates":[[[0],[1,1],[2,2],[0]]]}', '{"type":"Polygon","coordinates":[[[true,0],[1,1],[2,2],[true,0]]]}', '{"type":"Feature","geometry":[]}', '{"type":5}'):
        assert reader.read(t, "geojson")["geometry_error"], t


def test_cascade_of_footprints(spark):
    feature = lambda g: json.dumps({"type": "Feature", "id": 7, "properties": {"c": 0.5}, "geometry": g})
    square = [[37.0, 0.0], [37.1, 0.0], [37.1, 0.1], [37.0, 0.1], [37.0, 0.0]]
    cases = [
        (feature({"type": "Polygon", "coordinates": [square]}), "geojson", None, None),
        (feature({"type": "Polygon", "coordinates": [[[37.0, 0.0], *square]]}), "geojson", None, None),
        ("{", "geojson", "malformed_record", "Expecting property name"),
        (None, "geojson", "malformed_record", None),
        (feature({"type": "Polygon", "coordinates": [square[:-1]]}), "geojson", "malformed_geometry", "a ring that is not closed at coordinates[0]"),
        ("POLYGON ((37 0, 37.1 0, 37.1 0.1, 37 0)) tail", "wkt", "malformed_geometry", "the end expected"),
        ("POINT (37 0)", "wkt", "unsupported_geometry_type", None),
        ("POLYGON EMPTY", "wkt", "empty_geometry", None),
        ("POLYGON ((37 0, 37.2 0.2, 37.2 0, 37 0.2, 37 0))", "wkt", "invalid_geometry", "Self-intersection[37.1 0.1"),
        ("POLYGON ((37 0, nan 0.2, 37.2 0, 37 0))", "wkt", "invalid_geometry", "Invalid Coordinate"),
        ("POLYGON ((0 0, 0.1 0, 0.1 0.1, 0 0))", "wkt", "centroid_outside_country", None),
        (f"POLYGON (({geometry.CENTRE_LONGITUDE + 180} 0, 37.1 0, 37.1 0.1, {geometry.CENTRE_LONGITUDE + 180} 0))", "wkt", "nonfinite_projected_geometry", None),
        ("POLYGON ((37 0, 37.000000001 0, 37.000000001 0.000000001, 37 0))", "wkt", "quantized_degenerate", None),
    ]
    df = spark.createDataFrame([(i, t, f) for i, (t, f, _, _) in enumerate(cases)], "i int, text string, form string")
    boundary = footprints.projected_boundary(spark, [[[(36.0, -1.0), (38.0, -1.0), (38.0, 1.0), (36.0, 1.0), (36.0, -1.0)]]])
    got = footprints.judge(df, "text", F.col("form"), boundary).orderBy("i").collect()
    assert [r.reason for r in got] == [r for _, _, r, _ in cases]
    for r, (_, _, _, said) in zip(got, cases, strict=True):
        assert (r.detail or "").startswith(said or "") and (r.x0 is None) == (r.reason is not None)
    assert got[0].own_id == "7" and got[0].properties == '{"c":0.5}' and [got[0][n] for n in ("x0", "y0", "x1", "y1")] == [got[1][n] for n in ("x0", "y0", "x1", "y1")]
    with pytest.raises(ValueError):
        footprints.judge(df.withColumn("Reason", F.lit(1)), "text", "wkt", boundary)


def test_sound_rings_are_settled_together(monkeypatch):
    """Plain rings make no object each, and the quick look finds no ring sound that has a fault."""
    random = np.random.default_rng(8)
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    rings = [[tuple(map(float, p)) for p in random.integers(0, 5, (k, 2))] for k in random.integers(3, 8, 400)]
    shapes = [[[[*r, r[0]]]] for r in rings] + [[[square]], None, [], [[square, square]], [[[(np.nan, 0.0), *square[1:]]]]]
    quick = validity.faults(shapes)
    with monkeypatch.context() as m:
        m.setattr(validity, "_plainly_sound", lambda some: np.zeros(len(some), dtype=bool))
        assert repr(validity.faults(shapes)) == repr(quick)
    assert sum(f is None for f in quick) > 20 < sum(f is not None for f in quick)

    def none(parts):
        raise AssertionError("an object was made")

    monkeypatch.setattr(validity, "_Shape", none)
    assert validity.faults([[[square]]] * 3) == [None] * 3


def test_footprints_are_dealt_out_and_judged_once(spark, sf_dir):
    """One small file was one task, and a filter on the centroid asked for the validity of every polygon again."""
    from tilewise.plans import queries

    for query in (queries.polygon_centroid, queries.centroid_in_boundary, queries.centroid_audit):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython [first_fault") == 1
    assert queries._judged(spark, sf_dir).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
