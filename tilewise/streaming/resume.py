"""Resumable, bounded builds with Structured Streaming: each source shard is processed once.

A checkpoint remembers the files done; ``availableNow`` takes what is new in bounded batches and stops. Every batch is
written under its own number, so that a batch that is run again after a failure replaces its own output only.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def contract_hash(**parts: object) -> str:
    """Digest of everything that decides a build's output; a checkpoint of another contract is refused."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def build_available(spark: SparkSession, source: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, contract: str, files_per_batch: int = 4) -> int:
    """Process the Parquet files of ``source`` not seen yet; returns the number of batches of this run."""
    from ..sources.publish import _fs

    fs, mark = _fs(spark, f"{checkpoint}/contract-{contract}")
    fs_root, root = _fs(spark, checkpoint)
    if fs_root.exists(root) and not fs.exists(mark):
        raise ValueError("the checkpoint belongs to another build contract")
    fs.mkdirs(mark)

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    run = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return len([p for p in run.recentProgress if p["numInputRows"]])


def merged_bounds(built: DataFrame) -> DataFrame:
    """Bounds and count over all batches: partial results per batch merge by min and max."""
    return built.agg(F.count("*").alias("n"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
