"""Shared helpers: batch bounds, scratch tables, column naming, skew-proof join-back."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Collection, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the benchmark and licence contracts: maximal runs of these characters after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ARROW_ROWS = 1000
CHUNK_BYTES = 8 << 20
#: Groups at least this share of all rows are "hot"; there can be at most ``HOT_SHARE`` of them, so they may be broadcast.
HOT_SHARE = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough that a batch of very long texts still fits a worker.

    The session's own limits stay if they are lower; otherwise they are lowered for the rest of the session.
    """
    for name, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", CHUNK_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = re.fullmatch(r"([0-9]+)b?", spark.conf.get(key))
        if not now or not 0 < int(now[1]) <= most:
            spark.conf.set(key, str(most))


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only where none is set on a local master (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tilewise-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


#: Intermediate tables that this process made and has not dropped.
_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark)}/tilewise-{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def drop_scratch(spark: SparkSession, keep: Collection[str] = ()) -> None:
    """Delete the intermediate tables made so far, but for ``keep``. Results that were not read yet may need them."""
    for path in [p for p in _made if p not in keep]:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _made.remove(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_alone(df: DataFrame, name: str, others: Collection[str]) -> DataFrame:
    """``written``, and then the intermediate tables but for this one and ``others`` are dropped."""
    out = written(df, name)
    drop_scratch(df.sparkSession, {_made[-1], *others})
    return out


def scratch_tables() -> list[str]:
    """Paths of the intermediate tables that are there."""
    return list(_made)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names not used by ``df`` (Spark compares names without case)."""
    used = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in used:
            n = f"_{n}"
        used.add(n.lower())
        out.append(n)
    return out


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` text bytes; one longer text is a slice by itself."""
    for batch in batches:
        give_back()
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(batch.schema.get_field_index(column))).to_numpy(zero_copy_only=False)
        start, size = 0, 0
        for i, n in enumerate(lengths):
            n = 0 if n != n else int(n)
            if i > start and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        yield batch.slice(start)


def join_back(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int) -> DataFrame:
    """Inner join of rows with one row per ``key`` in ``groups``, safe for keys that hold a third of all rows.

    A group with at least ``n_rows / HOT_SHARE`` rows is broadcast: there are at most ``HOT_SHARE`` such groups at
    any input size. All other keys are shuffled, none with more than that share of the rows.
    """
    hot_at = max(2, n_rows // HOT_SHARE)
    hot = F.broadcast(groups.where(F.col(size) >= hot_at))
    cold = groups.where(F.col(size) < hot_at)
    in_hot = rows.join(hot, key, "inner")
    in_cold = rows.join(F.broadcast(groups.where(F.col(size) >= hot_at).select(key)), key, "left_anti").hint("shuffle_hash").join(cold, key, "inner")
    return in_hot.unionByName(in_cold)


def rare_gc() -> None:
    """Let a worker with large memos look for reference cycles less often; it makes none of its own."""
    gc.set_threshold(200_000, 50, 100)


def give_back() -> None:
    """Return freed memory to the system: allocators keep it otherwise, and it counts against the executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


_release: dict[str, Callable[[], None]] = {}


def own_worker(name: str, release: Callable[[], None] | None = None) -> None:
    """Called as an operator's task begins: frees what other operators keep in this worker, which serves them in turn.

    ``release`` empties this operator's own caches once another one takes the worker over.
    """
    others = [k for k in _release if k != name]
    for k in others:
        _release.pop(k)()
    if others:
        gc.collect()
        give_back()
    _release[name] = release or (lambda: None)


class Memo:
    """Results by key, for at most ``limit`` keys: what was not used for a while goes, common keys stay."""

    def __init__(self, limit: int):
        self.limit, self.now, self.before = limit, {}, {}

    def missing(self, keys) -> list:
        """The distinct keys without a result; those with one are in ``now`` until the next call."""
        if len(self.now) > self.limit // 2:
            self.now, self.before = {}, self.now
        out = []
        for k in keys if isinstance(keys, (set, frozenset)) else dict.fromkeys(keys):
            if k not in self.now:
                if k in self.before:
                    self.now[k] = self.before[k]
                else:
                    out.append(k)
        return out
