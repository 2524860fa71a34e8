"""k-means by kd-tree filtering against plain arithmetic on whole numbers."""

import hashlib
from collections import Counter
from fractions import Fraction
from math import floor, isfinite

import cases
import numpy as np
import pytest

from tilewise.llm import centroids
from tilewise.llm.queries import QUERIES


def plain(rows, dims=64, scale=256, clusters=40, rounds=5, salt="2:"):
    """Counter of (id, cluster, distance, inertia of the cluster, inertia, digest)."""
    kept = [(i, [floor(Fraction(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{salt}{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    middle = [v for _, v in first]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    for _ in range(rounds + 1):
        at = [min(range(len(middle)), key=lambda c: (far(v, middle[c]), c)) for _, v in kept]
        last = middle
        middle = [[sum(col) // len(mine) for col in zip(*mine, strict=True)] if (mine := [v for (_, v), a in zip(kept, at, strict=True) if a == c]) else middle[c] for c in range(len(middle))]
    away = [far(v, last[a]) for (_, v), a in zip(kept, at, strict=True)]
    return Counter((i, a, d, sum(e for e, b in zip(away, at, strict=True) if b == a), sum(away), hashlib.sha256(",".join(map(str, last[a])).encode()).hexdigest()) for (i, _), a, d in zip(kept, at, away, strict=True))


def found(df):
    return Counter(tuple(r) for r in df.collect())


def test_query_on_edge_cases(spark, tables):
    rows = [(r[0], r[1] if r[1] is None else [None if x is None else float(np.float32(x)) for x in r[1]]) for r in cases.vectors()]
    assert found(QUERIES["op11_centroids"](spark, tables[0])) == plain(rows)


def test_small_blocks_and_leaves(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 64)
    monkeypatch.setattr(centroids, "LEAF_ROWS", 2)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 3)]) for i in range(700)]  # many equal vectors and ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = found(centroids.cluster(df, dims=3, scale=1, clusters=9, rounds=4))
    assert got == plain(rows, 3, 1, 9, 4)


@pytest.mark.parametrize("magnitude", [1e3, 1e5])
def test_large_components_stay_exact(spark, magnitude):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, magnitude, 64)]) for i in range(60)]
    assert found(centroids.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), clusters=5)) == plain(rows, clusters=5)


def test_components_beyond_64_bits_raise(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="do not fit 64 bits"):
        centroids.cluster(df).collect()


def test_fewer_vectors_than_clusters_and_text_keys(spark):
    rows = [("b", [1.0, 2.0]), ("a", [5.0, 2.0]), (None, [1.0, 2.0])]
    assert found(centroids.cluster(spark.createDataFrame(rows, "vec_id string, embedding array<double>"), dims=2, clusters=4)) == plain(rows, 2, clusters=4)


def test_nodes_are_pruned_and_assigned_whole():
    rng = np.random.default_rng(2)
    middles = rng.integers(-1000, 1000, (8, 4))
    points = (middles[rng.integers(0, 8, 4000)] + rng.integers(-9, 10, (4000, 4))).astype(np.int64)
    order, nodes = centroids.build_tree(points)
    out = list(centroids.filter_tree(points[order], nodes, middles.astype(np.int64)))
    whole = sum(int(nodes["stop"][n] - nodes["start"][n]) for n, one, _ in out if one is not None)
    assert whole > 3500 and sum(int(nodes["stop"][n] - nodes["start"][n]) for n, _, _ in out) == 4000
