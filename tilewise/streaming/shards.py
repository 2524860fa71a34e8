"""Shards of numbered records with a chained manifest, verified when a build is resumed.

A shard holds the records of one range of numbers. Its manifest row has the range, the count, a digest of its records in any
order, and a chain value over this and all earlier rows. ``faults`` compares what lies there with the manifest; ``build``
writes only what is missing or faulty.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import materialized
from ..sources.publish import _fs
from .resume import contract_hash

#: Records of a shard that one task writes to one file.
FILE_RECORDS = 100_000
_MANIFEST = "shard long, first long, last long, n long, digest string, chain string"


def _record_digest(columns: list[str]) -> Column:
    """The first 60 bits of each record's SHA-256, summed: equal for the same records in any order."""
    whole = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return F.sum(F.conv(F.substring(F.sha2(whole, 256), 1, 15), 16, 10).cast("decimal(38,0)")).cast("string")


def described(rows: DataFrame, number: str) -> DataFrame:
    """Per shard: first, last, n, digest."""
    columns = [c for c in rows.columns if c != "shard"]
    return rows.groupBy("shard").agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count("*").alias("n"), _record_digest(columns).alias("digest"))


def chained(manifest: list) -> list[tuple]:
    """Rows (shard, first, last, n, digest) in order, each with the digest of itself and all before."""
    out, chain = [], ""
    for r in sorted(manifest, key=lambda r: r.shard):
        chain = hashlib.sha256(f"{chain}|{r.shard}|{r.first}|{r.last}|{r.n}|{r.digest}".encode()).hexdigest()
        out.append((r.shard, r.first, r.last, r.n, r.digest, chain))
    return out


def _stored(spark: SparkSession, out: str, schema) -> DataFrame:
    fs, path = _fs(spark, f"{out}/rows")
    if not fs.exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{out}/rows").parquet(f"{out}/rows")


def _schema(rows: DataFrame):
    return rows.select(*[c for c in rows.columns if c != "shard"], F.col("shard").cast("long")).schema


def write(rows: DataFrame, out: str, number: str, shard_records: int, only: list[int] | None = None) -> None:
    """Write (or replace) the folders of shards; each is written by the tasks that hold its records: one for every ``FILE_RECORDS``
    that a shard may have, at most 16."""
    parted = rows.withColumn("shard", (F.col(number) / shard_records).cast("long"))
    if only is not None:
        wanted = rows.sparkSession.createDataFrame([(n,) for n in only], "shard long")  # one row a shard
        parted = parted.join(F.broadcast(wanted), "shard", "left_semi")
    salt = F.pmod(F.xxhash64(number), F.lit(min(16, -(-shard_records // FILE_RECORDS))))
    mode = parted.repartition("shard", salt).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard")
    mode.parquet(f"{out}/rows")


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).json(f"{out}/manifest")


def faults(spark: SparkSession, out: str, schema, number: str) -> DataFrame:
    """(shard, fault): missing, unexpected, damaged (other records), broken_chain, gap or overlap with the shard before."""
    manifest = read_manifest(spark, out)
    now = described(_stored(spark, out, schema), number)
    a, b = manifest.alias("a"), now.alias("b")
    same = (F.col("a.n") == F.col("b.n")) & (F.col("a.digest") == F.col("b.digest")) & (F.col("a.first") == F.col("b.first")) & (F.col("a.last") == F.col("b.last"))
    fault = F.when(F.col("b.shard").isNull(), "missing").when(F.col("a.shard").isNull(), "unexpected").when(~same, "damaged")
    content = a.join(b, F.col("a.shard") == F.col("b.shard"), "full_outer").select(F.coalesce("a.shard", "b.shard").alias("shard"), fault.alias("fault")).where("fault is not null")
    # One row a shard: the manifest is a bounded table.
    before = Window.orderBy("shard")
    edge = F.when(F.col("first") > F.lag("last").over(before) + 1, "gap").when(F.col("first") <= F.lag("last").over(before), "overlap")
    edges = manifest.select("shard", edge.alias("fault")).where("fault is not null")
    rows = manifest.collect()
    broken = [(c[0], "broken_chain") for r, c in zip(sorted(rows, key=lambda r: r.shard), chained(rows), strict=True) if r.chain != c[5]]
    return content.union(edges).union(spark.createDataFrame(broken[:1], "shard long, fault string"))


def build(rows: DataFrame, out: str, number: str, shard_records: int, **contract: object) -> list[int]:
    """Bring ``out`` to hold ``rows`` (numbered by ``number``); returns the shards that were written.

    A folder of another contract raises. Shards whose records are as they should be stay; all others are written anew, and those that
    should not be there are dropped.
    """
    spark = rows.sparkSession
    mark = contract_hash(number=number, shard_records=shard_records, columns=rows.columns, **contract)
    fs, path = _fs(spark, f"{out}/contract-{mark}")
    if fs.exists(_fs(spark, out)[1]) and not fs.exists(path):
        raise ValueError("the shards belong to another build contract")
    fs.mkdirs(path)
    wanted = materialized(described(rows.withColumn("shard", (F.col(number) / shard_records).cast("long")), number), "wanted")
    schema = _schema(rows.withColumn("shard", F.lit(0)))
    have = described(_stored(spark, out, schema), number)
    keys = ["shard", "first", "last", "n", "digest"]
    stale = [r.shard for r in wanted.join(have, keys, "left_anti").select("shard").collect()]
    for r in have.join(wanted, "shard", "left_anti").select("shard").collect():
        fs.delete(_fs(spark, f"{out}/rows/shard={r.shard}")[1], True)
    if stale:
        write(rows, out, number, shard_records, stale)
    manifest = spark.createDataFrame(chained(wanted.collect()), _MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").json(f"{out}/manifest")
    return sorted(stale)
