"""Exact k-means over integer vectors by kd-tree filtering.

Vectors become integers (``floor(scale * x)``). Each task cuts its rows into blocks of bounded size and builds a kd-tree per
block: nodes hold their count, the integer sums of their vectors and their box. The trees are written once to the shared
folder; every round reads them. A round walks each tree level by level with the set of centroids that may still be nearest
to some point of a node: a centroid that is strictly farther than another one from every point of the node's box is pruned,
a node with one centroid left is assigned whole by its count and sums, and leaves that are left are resolved exactly. A
centroid at equal distance is never pruned, so that ties go to the smaller number. Only k x dims sums reach the driver.

All arithmetic is exact: double-precision products while no intermediate value can reach 2^52, 64-bit integers beyond that.
Components so large that a squared distance might not fit 64 bits raise an OverflowError.

Defined results: vectors that are null, of another length, or hold nulls or values that are not finite are left out; repeated
rows and ids are clustered row by row; a null id counts as an empty text when starting centroids are drawn, equal ids start in
the order of their vectors; with fewer vectors than k there are as many centroids as vectors; of equal centroids the smaller
number takes all and the other stays empty; an empty table gives an empty result; other columns may have any name and are not
carried.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, own_worker, written

DIMS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SALT = "2:"
BLOCK_ROWS = 8192
BLOCK_BYTES = 16 << 20
LEAF_ROWS = 48

_NODES = "start binary, stop binary, child binary, low binary, high binary, sums binary"
Matrix = np.ndarray


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has ``dims`` components, none null or not finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, finite), F.lit(False))


def exact_limit(dims: int) -> int:
    """Largest magnitude with which double-precision arithmetic is exact: dims * (2 b)^2 <= 2^52."""
    return math.isqrt(2**50 // dims)


def largest(dims: int) -> int:
    """Largest magnitude with which sums as in ``filter_tree`` fit 64 bits: dims * (2 b)^2 <= 2^62."""
    return math.isqrt(2**60 // dims)


def integers(x: Matrix, scale: int) -> Matrix:
    """floor(scale * x) as 64-bit integers."""
    out = np.floor(x * float(scale))
    if len(out) and np.abs(out).max() > largest(x.shape[1]):
        raise OverflowError("a component is so large that squared distances do not fit 64 bits")
    return out.astype(np.int64)


def build_tree(points: Matrix) -> tuple[Matrix, dict[str, Matrix]]:
    """The order of the points in the tree, and its nodes, level by level.

    ``child`` is the first of a node's two children, 0 for a leaf. A node is halved at the median of its widest side; one with
    few points, or without any width, is a leaf.
    """
    order = np.arange(len(points))
    starts, stops, children, lows, highs, sums = [0], [len(points)], [], [], [], []
    at = 0
    while at < len(starts):
        lo, hi = starts[at], stops[at]
        mine = points[order[lo:hi]]
        low, high = mine.min(axis=0), mine.max(axis=0)
        lows.append(low)
        highs.append(high)
        sums.append(mine.sum(axis=0))
        width = high - low
        if hi - lo <= LEAF_ROWS or not width.any():
            children.append(0)
        else:
            half = (hi - lo) // 2
            order[lo:hi] = order[lo:hi][np.argpartition(mine[:, int(width.argmax())], half)]
            children.append(len(starts))
            starts += [lo, lo + half]
            stops += [lo + half, hi]
        at += 1
    nodes = {"start": np.array(starts, np.int32), "stop": np.array(stops, np.int32), "child": np.array(children, np.int32), "low": np.array(lows), "high": np.array(highs), "sums": np.array(sums, np.int64)}
    return order, nodes


def filter_tree(points: Matrix, nodes: dict[str, Matrix], centroids: Matrix) -> Iterator[tuple[int, int | None, Matrix | None]]:
    """(node, its centroid, None) for nodes assigned whole, (leaf, None, the centroid of each point) for the others."""
    dims = centroids.shape[1]
    small = max(int(np.abs(m).max()) for m in (nodes["low"][0], nodes["high"][0], centroids)) <= exact_limit(dims)
    kind = np.float64 if small else np.int64
    c = centroids.astype(kind)
    norms = (c * c).sum(axis=1)
    low, high, x = (m.astype(kind, copy=False) for m in (nodes["low"], nodes["high"], points))
    level, live = np.zeros(1, dtype=np.int64), np.ones((1, len(c)), dtype=bool)
    while len(level):
        # Any live centroid may serve as the one to beat; the one nearest to the middle of the box prunes most.
        middle = (low[level] + high[level]).astype(np.float64) / 2
        away = norms.astype(np.float64) - 2 * middle @ c.T.astype(np.float64)
        best = np.where(live, away, np.inf).argmin(axis=1)
        for b in np.unique(best):
            rows = np.flatnonzero(best == b)
            u = c - c[b]
            # The most by which the distance to b can exceed that to each centroid, over all points of the box.
            most = 2 * (high[level[rows]] @ np.maximum(u, 0).T + low[level[rows]] @ np.minimum(u, 0).T) + norms[b] - norms
            live[rows] &= most >= 0
        left = live.sum(axis=1)
        deeper = []
        for i, node in enumerate(level):
            if left[i] == 1:
                yield int(node), int(live[i].argmax()), None
            elif nodes["child"][node]:
                deeper.append(i)
            else:
                some = np.flatnonzero(live[i])
                lo, hi = nodes["start"][node], nodes["stop"][node]
                flat = not (nodes["high"][node] - nodes["low"][node]).any()
                mine = x[lo : lo + 1 if flat else hi]
                near = some[(norms[some] - 2 * mine @ c[some].T).argmin(axis=1)]  # the first of equal ones
                yield (int(node), int(near[0]), None) if flat else (int(node), None, near)
        deeper = np.array(deeper, dtype=np.int64)
        first = nodes["child"][level[deeper]].astype(np.int64)
        level, live = np.stack([first, first + 1], axis=1).ravel(), np.repeat(live[deeper], 2, axis=0)


def trees(df: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """One row per block of vectors: keys and points in tree order, and the nodes."""
    bounded_batches(df.sparkSession)
    rows = df.where(usable(F.col(vector), dims)).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    limit = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dims)))
    kind = rows.schema["key"].dataType.simpleString()

    def block(batch: pa.Table) -> dict:
        x = batch["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        points = integers(x, scale)
        order, nodes = build_tree(points)
        size = next(t for t in (np.int16, np.int32, np.int64) if np.abs(points).max() <= np.iinfo(t).max)
        narrow = {n: nodes[n].astype(size) for n in ("low", "high")}
        keys = batch["key"].combine_chunks().take(pa.array(order))
        return {"keys": keys, "width": size().itemsize, "points": points[order].astype(size).tobytes()} | {n: m.tobytes() for n, m in (nodes | narrow).items()}

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("centroids")
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                some = batch.slice(0, limit - n)
                batch = batch.slice(some.num_rows)
                held.append(some)
                n += some.num_rows
                if n == limit:
                    yield as_batch(block(pa.Table.from_batches(held)))
                    held, n = [], 0
        if n:
            yield as_batch(block(pa.Table.from_batches(held)))

    def as_batch(row: dict) -> pa.RecordBatch:
        keys = row["keys"]
        arrays = [pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys), pa.array([row["width"]], pa.int32())]
        names = ["points", *(c.split()[0] for c in _NODES.split(", "))]
        return pa.RecordBatch.from_arrays(arrays + [pa.array([row[n]], pa.binary()) for n in names], ["keys", "width", *names])

    return rows.mapInArrow(grow, f"keys array<{kind}>, width int, points binary, {_NODES}")


def _read(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, Matrix, dict[str, Matrix]]]:
    """(row in the batch, points, nodes) of each tree."""
    for i in range(batch.num_rows):
        raw = lambda name, i=i: batch[name][i].as_buffer()
        size = {2: np.int16, 4: np.int32, 8: np.int64}[batch["width"][i].as_py()]
        nodes = {n: np.frombuffer(raw(n), np.int32) for n in ("start", "stop", "child")}
        nodes |= {n: np.frombuffer(raw(n), size).reshape(-1, dims).astype(np.int64) for n in ("low", "high")}
        nodes["sums"] = np.frombuffer(raw("sums"), np.int64).reshape(-1, dims)
        yield i, np.frombuffer(raw("points"), size).reshape(-1, dims).astype(np.int64), nodes


def start(df: DataFrame, key: str, vector: str, dims: int, scale: int, clusters: int, salt: str) -> Matrix:
    """The kept vectors whose ids have the smallest hashes, in that order."""
    name = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    kept = df.where(usable(F.col(vector), dims)).select(name.alias("h"), F.col(vector).cast("array<double>").alias("v"))
    return integers(np.array([r.v for r in kept.orderBy("h", "v").limit(clusters).collect()], dtype=float).reshape(-1, dims), scale)


def moved(grown: DataFrame, centroids: Matrix) -> Matrix:
    """One round: every vector to its nearest centroid, then each centroid that has vectors to the floor of their mean."""
    k, dims = centroids.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("centroids")
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, points, nodes in _read(batch, dims):
                for node, one, each in filter_tree(points, nodes, centroids):
                    lo, hi = nodes["start"][node], nodes["stop"][node]
                    if each is None:
                        n[one] += hi - lo
                        sums[one] += nodes["sums"][node]
                    else:
                        n += np.bincount(each, minlength=k)
                        for c in np.unique(each):
                            sums[c] += points[lo:hi][each == c].sum(axis=0)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at]), pa.array(sums[at].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = grown.drop("keys").mapInArrow(totals, "cluster int, n bigint, sums array<bigint>")
    total = F.sum(F.col("part").cast("decimal(38,0)"))
    out = centroids.copy()
    for r in parts.select("cluster", "n", F.posexplode("sums").alias("dim", "part")).groupBy("cluster", "dim").agg(total.alias("total"), F.sum("n").alias("n")).collect():
        out[r.cluster, r.dim] = int(r.total) // r.n
    return out


def assigned(grown: DataFrame, centroids: Matrix) -> DataFrame:
    """key, cluster and squared distance of every vector."""
    dims = centroids.shape[1]
    kind = grown.schema["keys"].dataType.elementType.simpleString()

    def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("centroids")
        for batch in batches:
            for i, points, nodes in _read(batch, dims):
                cluster = np.empty(len(points), np.int32)
                for node, one, each in filter_tree(points, nodes, centroids):
                    cluster[nodes["start"][node] : nodes["stop"][node]] = one if each is None else each
                gap = points - centroids[cluster]
                yield pa.RecordBatch.from_arrays([batch["keys"][i].values, pa.array(cluster), pa.array((gap * gap).sum(axis=1))], ["key", "cluster", "distance"])

    return grown.mapInArrow(each_row, f"key {kind}, cluster int, distance bigint")


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = DIMS, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, salt: str = SALT) -> DataFrame:
    """Per kept vector: key, cluster, distance, cluster_inertia, inertia and centroid_sha256. Calling it runs the rounds."""
    spark = df.sparkSession
    centroids = start(df, key, vector, dims, scale, clusters, salt)
    grown = written(trees(df, key, vector, dims, scale), "trees")
    for _ in range(rounds if len(centroids) else 0):
        before, centroids = centroids, moved(grown, centroids)
        if (before == centroids).all():
            break  # all further rounds would change nothing either
    rows = written(assigned(grown, centroids), "assigned")
    # One row per cluster: a bounded table.
    total = {r.cluster: int(r.total) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digest = {c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest() for c in total}
    table = spark.createDataFrame([(c, total[c], sum(total.values()), digest[c]) for c in sorted(total)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
