"""Intermediate tables in the folder that driver and executors share; columns that are made once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where a local session has none (tests)."""
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


def drop_scratch(spark: SparkSession, keep: Collection[str] = ()) -> None:
    """Delete the intermediate tables made so far, but for ``keep``. Results that were not read yet may need them."""
    for path in [p for p in _made if p not in keep]:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _made.remove(path)


def settled(rows: DataFrame) -> DataFrame:
    """A random column, which filters cannot pass, keeps later filters, and with them all that they compute, from moving below."""
    return rows.withColumn("__settled", F.rand(0)).where("__settled >= 0").drop("__settled")


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so that what follows neither recomputes it nor depends on its order."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
