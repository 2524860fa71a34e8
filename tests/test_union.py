"""Unions of polygons: areas by counting cells, membership by the points of all polygons."""

import random

import pytest
from pyspark.sql import functions as F

from tilewise.functions import geometry, reader, union, validity


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def inside(rings, x, y):
    """Winding number of rings around a point on none of them."""
    n = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
            if (ay <= y) != (by <= y) and ((bx - ax) * (y - ay) - (by - ay) * (x - ax) > 0) == (by > ay):
                n += 1 if by > ay else -1
    return n


@pytest.mark.parametrize("seed", range(40))
def test_rectangles_equal_counted_cells(seed):
    r = random.Random(seed)
    boxes = [(x, y, x + r.randrange(1, 5), y + r.randrange(1, 5)) for x, y in ((r.randrange(8), r.randrange(8)) for _ in range(r.randrange(1, 9)))]
    rings, area = union.outline([[box(*b)] if r.random() < 0.5 else [box(*b)[::-1]] for b in boxes])
    cells = {(i, j) for x0, y0, x1, y1 in boxes for i in range(x0, x1) for j in range(y0, y1)}
    assert area == len(cells)
    for i in range(13):
        for j in range(13):
            assert inside(rings, i + 0.5, j + 0.5) == ((i, j) in cells)
    assert all(len(set(ring)) == len(ring) - 1 or len(ring) > 5 for ring in rings)


def random_ring(r):
    while True:
        p = [(r.randrange(9), r.randrange(9)) for _ in range(r.randrange(3, 7))]
        if validity.faults([[[[*p, p[0]]]]]) == [None]:
            return [*p, p[0]]


@pytest.mark.parametrize("seed", range(40))
def test_any_polygons_hold_the_same_points(seed):
    r = random.Random(seed)
    polygons = [[random_ring(r)] for _ in range(r.randrange(1, 6))]
    rings, area = union.outline(polygons)
    for _ in range(200):
        x, y = r.random() * 9, r.random() * 9
        assert inside(rings, x, y) == any(abs(inside(p, x, y)) == 1 for p in polygons)
    alone = [abs(float(union.ring_area(p[0]))) for p in polygons]
    assert max(alone) - 1e-9 <= area <= sum(alone) + 1e-9


def test_holes_are_filled_and_left():
    frame = [box(0, 0, 10, 10), box(2, 2, 8, 8)]
    assert union.outline([frame])[1] == 64 and len(union.outline([frame])[0]) == 2
    rings, area = union.outline([frame, [box(2, 2, 8, 5)]])
    assert area == 82 and len(rings) == 2
    assert union.outline([frame, [box(2, 2, 8, 8)]]) == ([box(0, 0, 10, 10)], 100.0)
    assert union.outline([frame, [box(1, 1, 9, 9)]])[1] == 100 and union.outline([frame, [box(4, 4, 5, 5)]])[1] == 65
    assert union.outline([]) == ([], 0.0) and union.outline([frame, frame])[1] == 64
    assert len(union.outline([[box(0, 0, 1, 1)], [box(1, 1, 2, 2)]])[0]) == 2
    with pytest.raises(ValueError, match="not valid"):
        union.outline([[[(0, 0), (1, 1), (1, 0), (0, 1), (0, 0)]]])


def test_one_union_for_each_group(spark):
    texts = [("a", "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"), ("a", "MULTIPOLYGON (((1 1, 3 1, 3 3, 1 3, 1 1)), ((9 9, 10 9, 9 10, 9 9)))"), ("b", "POLYGON ((0 0, 1 0, 0 1, 0 0))"), ("b", None)]
    df = spark.createDataFrame(texts, "k string, t string").withColumn("parts", reader.parse_geometry(F.col("t"), "wkt")["parts"])
    got = {r.k: r for r in union.unions(df, "k", "parts").collect()}
    assert {k: (len(r.rings), r.area) for k, r in got.items()} == {"a": (2, 7.5), "b": (1, 0.5)}
    ring = [[[(p.x, p.y) for p in r]] for r in got["a"].rings]
    points = spark.createDataFrame([(0.5, 0.5), (2.5, 1.5), (2.5, 0.5), (9.1, 9.1)], "x double, y double")
    assert [r[0] for r in points.select(geometry.covers(ring)("x", "y")).collect()] == [True, True, False, True]
