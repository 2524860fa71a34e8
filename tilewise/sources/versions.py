"""Tables with versions: each is a folder of its own, and one pointer, replaced by a single rename, names the current one.

A reader keeps the folder that the pointer named when it began, so that a swap disturbs nobody. Folders that no pointer names
any more stay until ``expire``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .publish import _fs

POINTER = "CURRENT"


def current(spark: SparkSession, table: str) -> str | None:
    """The folder name of the current version, or None for a table without one."""
    fs, path = _fs(spark, f"{table}/{POINTER}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode().strip()
    finally:
        stream.close()


def _point(spark: SparkSession, table: str, name: str) -> None:
    """Replace the pointer in one step."""
    fs, new = _fs(spark, f"{table}/.{POINTER}-{uuid.uuid4().hex}")
    stream = fs.create(new, False)
    stream.write(bytearray(name.encode()))
    stream.close()
    jvm = spark.sparkContext._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    _, target = _fs(spark, f"{table}/{POINTER}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(new), fs.makeQualified(target), how)


def swap(df: DataFrame, table: str, expected: str | None = None) -> str:
    """Write ``df`` as a new version and make it the current one; returns its name.

    ``df`` may read the table itself. With ``expected``, another current version raises and the new one is not pointed to.
    """
    spark = df.sparkSession
    name = f"v-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(f"{table}/{name}")
    if expected is not None and current(spark, table) != expected:
        _remove(spark, f"{table}/{name}")
        raise RuntimeError(f"{table} was changed by another writer")
    _point(spark, table, name)
    return name


def read(spark: SparkSession, table: str, name: str | None = None) -> DataFrame:
    """A version, by default the current one; later swaps do not change what it reads."""
    name = name or current(spark, table)
    if name is None:
        raise FileNotFoundError(f"{table} has no version")
    return spark.read.parquet(f"{table}/{name}")


def with_counts(spark: SparkSession, table: str, counts: DataFrame, key: str = "group_id", count: str = "overlap_count") -> str:
    """Swap in a version whose groups have ``count``, added or replaced; groups without one have 0."""
    name = current(spark, table)
    groups = read(spark, table, name).drop(count)
    return swap(groups.join(counts.select(key, count), key, "left").withColumn(count, F.coalesce(count, F.lit(0).cast("long"))), table, name)


def _remove(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def expire(spark: SparkSession, table: str, keep: tuple[str, ...] = ()) -> list[str]:
    """Delete all versions but the current one and ``keep``; returns their names."""
    fs, path = _fs(spark, table)
    left = {current(spark, table), *keep}
    gone = sorted(n for n in (s.getPath().getName() for s in fs.listStatus(path)) if n.startswith("v-") and n not in left)
    for n in gone:
        _remove(spark, f"{table}/{n}")
    return gone
