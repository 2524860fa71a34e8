"""SimHash near-duplicates with pigeonhole blocks.

Fingerprints (64 bits over word shingles, XXH64 with seed 42) are computed in vectorised batches. Fingerprints that
differ in at most ``MAX_DISTANCE`` bits are found exactly: with ``b`` blocks, a close pair agrees on at least
``b - MAX_DISTANCE`` whole blocks, so joining on every such combination of blocks meets every pair; each meeting is
verified by Hamming distance. ``b`` grows with the number of distinct fingerprints, so that a key holds few of them.

Only distinct fingerprints meet, and a bucket gives a spanning forest of its links, never all its pairs. A bucket of
over ``BUCKET_LIMIT`` distinct fingerprints is not compared in one task: its members are linked through midpoints
(values within two bits of both), which reach the same components with a fixed number of rows per fingerprint.
Components come from alternating star contractions over written tables, without anything gathered on the driver.

Defined results: null and empty texts, and texts of white space only, have fingerprint zero and link like any other;
fewer words than a shingle make one shingle; repeated rows, ties and equal keys share a component if their texts do; a null
doc_id is ignored as a component's name unless a component has no other; texts of any length are read whole; other columns
are carried or left out and may have any name; an empty table gives an empty result. Calling an operator runs the rounds,
whose tables stay in the shared folder until ``common.drop_scratch``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, fresh, join_back, own_worker, text_or_empty, written

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
BUCKET_LIMIT = 32768
#: Wanted mean number of fingerprints with one block key.
BUCKET_MEAN = 8

_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> list[int]:
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and exactly the white space of the contract
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words), SEED)] if words else []
    return [digest(s, SEED) for s in map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))]


def fingerprint_of(hashes: list[int]) -> int:
    """Bits that are set in more than half of the hashes; 0 for none."""
    if not hashes:
        return 0
    return int(_majority(np.array(hashes, dtype=np.uint64), np.array([0]), np.array([len(hashes)]))[0])


def _majority(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive non-empty runs of hashes."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    return ((sums * 2 > counts[:, None]) * _BITS).sum(axis=1, dtype=np.uint64)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own_worker("fingerprints")
    for batch in chunks(batches, "text", 2 << 20):
        per_doc = [shingle_hashes(t) for t in batch.column(1).to_pylist()]
        counts = np.array([len(h) for h in per_doc], dtype=np.int64)
        out = np.zeros(len(counts), dtype=np.uint64)
        if counts.sum():
            full = counts > 0
            flat = np.fromiter((x for h in per_doc for x in h), dtype=np.uint64, count=int(counts.sum()))
            starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
            out[full] = _majority(flat, starts, counts[full])
        yield pa.record_batch([batch.column(0), pa.array(out.view(np.int64))], names=["key", "fp"])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fp (the 64 bits as a signed long) of every row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(_fingerprint_batches, f"key {docs.schema[key].dataType.simpleString()}, fp long")


def plan_blocks(n: int) -> tuple[list[tuple[int, int]], int]:
    """Blocks as (first bit, width), and how many of them a key joins on, for n distinct fingerprints."""
    for b in range(MAX_DISTANCE + 1, 13):
        edges = [64 * i // b for i in range(b + 1)]
        blocks = [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]
        agree = b - MAX_DISTANCE
        if n >> min(63, sum(sorted(w for _, w in blocks)[:agree])) < BUCKET_MEAN:
            break
    return blocks, agree


def block_keys(fp: Column, blocks: list[tuple[int, int]], agree: int) -> Column:
    """Array of one key per combination of blocks; the combination's number is part of the key."""
    keys = []
    for i, chosen in enumerate(combinations(blocks, agree)):
        mask = sum(((1 << w) - 1) << lo for lo, w in chosen)
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(i).alias("c"), fp.bitwiseAND(F.lit(mask)).alias("bits")))
    return F.array(*keys)


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what is within ``distance``: each member is compared only with those not reached yet."""
    left, links = fps, []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= distance
            if near.any():
                found = left[near]
                links += [(int(at), int(x)) for x in found]
                queue += list(found)
                left = left[~near]
    return links


def _bucket_links(distance: int, limit: int):
    """Over rows sorted by (c, bits): links (a, b, 0) within buckets, or members (fp, fp, 1) of buckets over the limit."""

    def small(keys: np.ndarray, fps: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        out = []
        for d in range(1, int(sizes.max(initial=1))):
            same = (keys[d:] == keys[:-d]) & (np.bitwise_count(fps[d:] ^ fps[:-d]) <= distance)
            if same.any():
                out.append(np.stack([fps[:-d][same], fps[d:][same]], axis=1))
        return out

    def emit(pairs: np.ndarray, kind: int) -> pa.RecordBatch:
        pairs = np.unique(np.sort(pairs.astype(np.uint64), axis=1), axis=0)
        return pa.record_batch([pa.array(pairs[:, 0].copy().view(np.int64)), pa.array(pairs[:, 1].copy().view(np.int64)), pa.array(np.full(len(pairs), kind, dtype=np.int32))], names=["a", "b", "kind"])

    def close(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(fps):
            return
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        group = np.cumsum(first) - 1
        sizes = np.bincount(group)
        few = sizes[group] <= 16
        found = small(group[few], fps[few], sizes[sizes <= 16])
        for g in np.flatnonzero(sizes > 16):
            lo, hi = np.searchsorted(group, [g, g + 1])
            if links := _forest(fps[lo:hi], distance):
                found.append(np.array(links, dtype=np.uint64))
        if found:
            yield emit(np.concatenate(found), 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype([("c", np.int64), ("bits", np.int64)])
        held_k, held_f, over = np.empty(0, dtype=kind), np.empty(0, dtype=np.uint64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.empty(batch.num_rows, dtype=kind)
            k["c"], k["bits"] = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            f = batch.column(2).to_numpy().view(np.uint64)
            if over is not None:  # the rest of a bucket that is already over the limit
                n = int((k == over).sum())
                if n:
                    yield emit(np.stack([f[:n], f[:n]], axis=1), 1)
                k, f = k[n:], f[n:]
                if not len(k):
                    continue
                over = None
            k, f = np.concatenate([held_k, k]), np.concatenate([held_f, f])
            last = int((k != k[-1]).sum())
            yield from close(k[:last], f[:last])
            held_k, held_f = k[last:], f[last:]
            if len(held_f) > limit:
                over = held_k[-1]
                yield emit(np.stack([held_f, held_f], axis=1), 1)
                held_k, held_f = held_k[:0], held_f[:0]
        yield from close(held_k, held_f)

    return run


def _midpoint_links(fps: DataFrame) -> DataFrame:
    """Links among fingerprints by shared values within two bits of each; such a value has at most 2081 of them."""
    one = [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    bits = F.array(*[F.lit(b).cast("long") for b in one])
    flips = F.concat(
        F.array(F.lit(0).cast("long")),
        bits,
        F.flatten(F.transform(bits, lambda x, i: F.transform(F.slice(bits, i + 2, 64), lambda y: x.bitwiseXOR(y)))),
    )
    mids = fps.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    heads = mids.groupBy("mid").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    return mids.join(heads, "mid").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def links(fps: DataFrame, distance: int = MAX_DISTANCE, limit: int = BUCKET_LIMIT, n: int | None = None) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``fp`` whose components are those of all pairs within ``distance`` bits."""
    if distance != MAX_DISTANCE:
        raise ValueError("the block plan and the midpoints are made for a distance of 4")
    blocks, agree = plan_blocks(fps.count() if n is None else n)
    keyed = fps.select(F.explode(block_keys(F.col("fp"), blocks, agree)).alias("k"), "fp").select("k.c", "k.bits", "fp")
    sorted_ = keyed.repartition(F.col("c"), F.col("bits")).sortWithinPartitions("c", "bits")
    found = written(sorted_.mapInArrow(_bucket_links(distance, limit), "a long, b long, kind int"), "links")
    direct = found.where("kind = 0").select("a", "b")
    over = found.where("kind = 1").select(F.col("a").alias("fp")).distinct()
    if not found.where("kind = 1").isEmpty():
        direct = direct.unionByName(_midpoint_links(over))
    return direct.distinct()


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find within a stretch of the edges: the same connections as a star per tree."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while parent.get(x, x) != top:
                parent[x], x = top, parent.get(x, x)
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        stars = [(root(x), x) for x in list(parent)]
        stars = [(r, x) for r, x in stars if r != x]
        yield pa.record_batch([pa.array([r for r, _ in stars], pa.int64()), pa.array([x for _, x in stars], pa.int64())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b) with the smallest node it is connected to, by star contractions.

    The edges of a node with a large share of them are joined by broadcast of its row, so that no task holds them all.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").mapInArrow(_contract, "a long, b long")
    edges = written(edges.distinct(), "edges")
    total = edges.count()
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("low"), F.count("*").alias("n"))
        large = join_back(both, low, "u", "n", 2 * total).where("v > u").select(F.col("low").alias("a"), F.col("v").alias("b")).distinct()
        large = written(large, "large")
        # Small stars: each node's smaller neighbours, and itself, hang from the smallest of them.
        low = large.groupBy("b").agg(F.min("a").alias("low"), F.count("*").alias("n"))
        small = join_back(large, low, "b", "n", large.count())
        small = small.where("a <> low").select(F.col("low").alias("x"), F.col("a").alias("y")).unionByName(low.select(F.col("low").alias("x"), F.col("b").alias("y")))
        edges = written(small.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "small")
        # Stable when no node is both a root and a leaf, and each leaf has one root.
        leaves, total = edges.select("b").distinct().count(), edges.count()
        if leaves == total and edges.select(F.col("a").alias("b")).distinct().join(edges.select("b"), "b", "left_semi").isEmpty():
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _named(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fp, root, n of every fingerprint of the rows (key, fp); root, component_id (smallest key), members of every component)."""
    nodes = rows.groupBy("fp").agg(F.min("key").alias("low_key"), F.count("*").alias("n"))
    nodes = written(nodes, "nodes")
    found = components(links(nodes.select("fp"), n=nodes.count()))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return rooted, rooted.groupBy("root").agg(F.min("low_key").alias("component_id"), F.sum("n").alias("members"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, fingerprint (16 hex digits), component_id (smallest key reachable by links)."""
    rows = written(fingerprints(docs, key, text), "fingerprints")
    n_rows = rows.count()
    rooted, names = _named(rows)
    named = join_back(rooted, names, "root", "members", n_rows).select("fp", "component_id", "n")
    named = written(named, "named")
    out = join_back(rows, named, "fp", "n", n_rows)
    return out.select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: of its smallest key (null last), the first by the text's SHA-256.

    Keys may repeat or be null: a component is named by key and text hash together, which no other component shares.
    Columns and names are unchanged.
    """
    mark, value, no_key, stay_key, stay_text, who = fresh(docs, "mark", "value", "no_key", "stay_key", "stay_text", "who")
    digest = F.unhex(F.sha2(text_or_empty(text), 256))
    named = lambda k, t: F.sha2(F.concat(F.coalesce(F.concat(F.lit("k"), k.cast("string")), F.lit("n")).cast("binary"), t), 256)
    marked = docs.select(F.struct(F.col(key).isNull().alias(no_key), F.col(key).alias(stay_key), digest.alias(stay_text)).alias(mark), F.col(text).alias(value))
    _, names = _named(written(fingerprints(marked, mark, value), "fingerprints"))
    stay = written(names.select(named(F.col(f"component_id.{stay_key}"), F.col(f"component_id.{stay_text}")).alias(who)), "stay")
    # Rows that agree in key and text are one before they are shuffled: of these any one stays. Nearly all rows stay, and their names
    # are never few enough to broadcast at scale, so the join is shuffled at any size, on what the rows are parted by already.
    one = docs.groupBy(named(F.col(key), digest).alias(who)).agg(F.first(F.struct(*[F.col(c) for c in docs.columns])).alias(mark))
    return one.join(stay.hint("shuffle_hash"), who, "left_semi").select(f"{mark}.*")
