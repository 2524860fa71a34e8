"""Exact duplicates by two-pass Bloom filtering, in built-in functions only.

Pass one hashes every text into two cells of a bit table and finds the cells that were hit at least twice. Pass two
tests each row against that filter: a row with a cell hit once has no equal and passes straight through; the others,
the possibly repeated, are shuffled as (sha256, doc_id) pairs, never as texts, and grouped.

The filter is broadcast, so its size is bounded: hashes fall into parts of about ``PART_ROWS`` rows by their value, each
part with a filter of its own (``CELLS_PER_ROW`` bits a row, 128 MB at most). With several parts the rows are written once,
sorted by part within each file, and every part's rows are read and tested with that part's filter alone, one part after
the other; so the same two passes run at any size, and no row is shuffled to be tested.

Defined results: null text counts as empty; repeated (doc_id, text) rows are ties, of which exactly one row is kept; a
null doc_id loses to any other, and stays only in a group without ids; an empty table gives an empty result; texts of any
length are hashed whole; other columns of the input are carried by :func:`drop_duplicates` and may have any name.

Intermediate tables stay in the shared folder; calling an operator already runs the passes that need them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, join_back, scratch_path, text_or_empty, written

CELLS_PER_ROW = 8
#: Rows a filter serves: at most 2^30 cells, 128 MB, as cells are rounded up to a power of two.
PART_ROWS = 100_000_000


def _cells(h: Column, cells: int) -> tuple[Column, Column]:
    return F.pmod(F.xxhash64(h, F.lit("first cell")), F.lit(cells)) + 1, F.pmod(F.xxhash64(h, F.lit("second cell")), F.lit(cells)) + 1


def repeated_cells(hashes: DataFrame, cells: int) -> DataFrame:
    """Bloom filters of the cells hit more than once, as (part, bucket, bits) rows of 4 KB. ``hashes``: part, long ``h``."""
    one, two = _cells(F.col("h"), cells)
    counts = hashes.select("part", F.explode(F.array(one, two)).alias("cell")).groupBy("part", "cell").agg(F.count("*").alias("n"))
    return (
        counts.where("n > 1")
        .groupBy("part", F.call_function("bitmap_bucket_number", F.col("cell")).alias("bucket"))
        .agg(F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("cell"))).alias("bits"))
    )


def _bit(bits: Column, cell: Column) -> Column:
    pos = F.call_function("bitmap_bit_position", cell).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.floor(pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("getbit", byte, F.pmod(pos, F.lit(8))) == 1, F.lit(False))


def _tested(rows: DataFrame, h: Column, bloom: DataFrame, cells: int, flag: str) -> DataFrame:
    """``rows`` with ``flag``: whether both cells of the hash are in the broadcast filter (bucket, bits)."""
    k1, k2, b1, b2, n1, n2 = fresh(rows, "cell_1", "cell_2", "bits_1", "bits_2", "bucket_1", "bucket_2")
    one, two = _cells(h, cells)
    out = rows.withColumns({k1: one, k2: two})
    for k, b, n in ((k1, b1, n1), (k2, b2, n2)):
        side = F.broadcast(bloom.select(F.col("bucket").alias(n), F.col("bits").alias(b)))
        out = out.join(side, F.call_function("bitmap_bucket_number", F.col(k)) == F.col(n), "left").drop(n)
    return out.withColumn(flag, _bit(F.col(b1), F.col(k1)) & _bit(F.col(b2), F.col(k2))).drop(k1, k2, b1, b2)


def possibly_repeated(docs: DataFrame, h: Column, n_rows: int, flag: str) -> DataFrame:
    """``docs`` with a boolean ``flag`` column: false only where no other row has the same hash ``h``."""
    spark = docs.sparkSession
    parts = -(-n_rows // PART_ROWS) or 1
    cells = 1 << max(15, (max(1, min(n_rows, PART_ROWS)) * CELLS_PER_ROW - 1).bit_length())
    if parts == 1:
        return _tested(docs, h, repeated_cells(docs.select(F.lit(0).alias("part"), h.alias("h")), cells), cells, flag)
    part, hash_ = fresh(docs, "part", "hash")
    rows = docs.withColumn(hash_, h).withColumn(part, F.pmod(hash_, F.lit(parts)).cast("int"))
    rows = written(rows.sortWithinPartitions(part), "hashed")
    blooms = written(repeated_cells(rows.select(F.col(part).alias("part"), F.col(hash_).alias("h")), cells), "blooms")
    path = scratch_path(spark, "tested")
    for p in range(parts):
        one = _tested(rows.where(F.col(part) == p), F.col(hash_), blooms.where(F.col("part") == p), cells, flag)
        one.select(*docs.columns, flag).write.mode("append").parquet(path)
    return spark.read.schema(docs.withColumn(flag, F.lit(True)).schema).parquet(path)


def duplicate_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, text_sha256."""
    # The texts are read once; both passes read their digests.
    rows = written(docs.select(F.col(key).alias("key"), F.sha2(text_or_empty(text), 256).alias("sha")), "digests")
    n_rows = rows.count()
    rows = possibly_repeated(rows, F.xxhash64("sha"), n_rows, "maybe")
    single = rows.where("not maybe").select("key", F.col("key").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    # Equal (sha, key) rows are counted before anything else moves, so a hot group is never gathered.
    counted = rows.where("maybe").groupBy("sha", "key").agg(F.count("*").alias("copies"))
    groups = counted.groupBy("sha").agg(F.max("key").alias("keep_id"), F.sum("copies").alias("group_size"))
    joined = join_back(counted, groups, "sha", "group_size", n_rows)
    block = 1_000_000
    many = joined.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / block))))
    many = many.withColumn("nth", F.explode(F.sequence(F.col("part") * block, F.least(F.col("copies"), (F.col("part") + 1) * block) - 1)))
    repeated = many.select("key", "keep_id", "group_size", (F.col("key").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 0)).alias("kept"), "sha")
    return single.unionByName(repeated).select(F.col("key").alias(key), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another row with a larger key has; columns and names unchanged."""
    n_rows = docs.count()
    maybe, sha, row = fresh(docs, "maybe_repeated", "text_sha", "kept_row")
    rows = possibly_repeated(docs, F.xxhash64(text_or_empty(text)), n_rows, maybe)
    single = rows.where(~F.col(maybe)).drop(maybe)
    some = rows.where(F.col(maybe)).drop(maybe).withColumn(sha, F.sha2(text_or_empty(text), 256))
    # Each task leaves one row of a text, so that neither a hot text nor a hot key is gathered, and texts move once.
    largest = F.max_by(F.struct(*[F.col(c) for c in docs.columns]), F.struct(F.col(key).isNotNull(), F.col(key)))
    return single.unionByName(some.groupBy(sha).agg(largest.alias(row)).select(f"{row}.*"))
