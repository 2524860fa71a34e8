"""Release sinks: relations, groups, exclusions, manifest and digests, staged and then renamed into place."""

from __future__ import annotations

import hashlib
import json
import uuid

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import require
from ..operators.grouping import relation
from ..operators.ordering import tasks_for
from ..schema import RELATION, SCHEMA_VERSION, check_schema
from ..scratch import shared_dir


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def contract_digest(contract: dict) -> str:
    """What a build was asked for, as one digest: equal contracts have equal ones whatever the order of their keys."""
    return hashlib.sha256(json.dumps(contract, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def is_complete(spark: SparkSession, out: str, contract: dict) -> bool:
    """Whether ``out`` is a release of this contract, with all files as they were written."""
    fs, _ = _fs(spark, out)
    if not fs.exists(_fs(spark, f"{out}/manifest")[1]) or not fs.exists(_fs(spark, f"{out}/digests")[1]):
        return False
    made = spark.read.json(f"{out}/manifest").first()["contract_sha256"]
    return made == contract_digest(contract) and changed_files(spark, out).isEmpty()


def publish(spark: SparkSession, out: str, records: DataFrame, groups: DataFrame, exclusions: DataFrame | None = None, overlap_counts: DataFrame | None = None, ledger: DataFrame | None = None, contract: dict | None = None) -> str:
    """Write a release to ``out``: everything goes to a staging folder that is renamed at the end.

    A complete release of the same contract is left as it is; anything else at ``out`` raises. Relations are sorted by
    group within files, so that a group's slice is read from few row groups. The manifest has the counts, the states of
    the groups, the ledger (side, key, n) and the contract; ``digests`` has those of all files.
    """
    contract = contract or {}
    fs, target = _fs(spark, out)
    if fs.exists(target):
        if is_complete(spark, out, contract):
            return out
        raise FileExistsError(out)
    staging = f"{out}.staging-{uuid.uuid4().hex}"
    rows = relation(records)
    counts = groups.agg(*[F.coalesce(F.sum(f"{s}_count"), F.lit(0)).alias(s) for s in ("r1", "r2")]).first()
    for side in ("r1", "r2"):
        tasks = tasks_for(rows, counts[side])
        one = rows.where(F.col("side") == side).drop("side").repartitionByRange(*([tasks] if tasks else []), "group_id").sortWithinPartitions("group_id", "record_id")
        one.write.option("compression", "zstd").parquet(f"{staging}/{side}.parquet")
    if overlap_counts is not None:
        groups = groups.join(overlap_counts, [c for c in overlap_counts.columns if c != "overlap_count"], "left").withColumn("overlap_count", F.coalesce("overlap_count", F.lit(0)))
    groups.write.option("compression", "zstd").parquet(f"{staging}/groups.parquet")
    if exclusions is not None:
        exclusions.write.option("compression", "gzip").json(f"{staging}/exclusions")
    written = spark.read.parquet(f"{staging}/groups.parquet")
    manifest = written.agg(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.count("*").alias("group_count"),
        F.coalesce(F.sum("r1_count"), F.lit(0)).alias("r1_count"),
        F.coalesce(F.sum("r2_count"), F.lit(0)).alias("r2_count"),
        F.struct(*[F.count_if(F.col("state") == s).alias(s) for s in ("both_nonempty", "r1_only", "r2_only", "both_empty")]).alias("states"),
        F.lit(1000).alias("quantization_scale"),
        F.lit("half-open").alias("rectangle_semantics"),
        F.lit(json.dumps(contract, sort_keys=True)).alias("contract"),
        F.lit(contract_digest(contract)).alias("contract_sha256"),
    )
    if ledger is not None:  # a row for each side and reason
        manifest = manifest.crossJoin(ledger.agg(F.array_sort(F.collect_list(F.struct("side", "key", "n"))).alias("ledger")))
    manifest.coalesce(1).write.json(f"{staging}/manifest")
    digests(spark, staging).coalesce(1).write.json(f"{staging}/digests")
    if not fs.rename(_fs(spark, staging)[1], target):
        raise OSError(f"{staging} could not be renamed to {out}")
    return out


def release_document(spark: SparkSession, out: str, title: str, checks: DataFrame) -> str:
    """Markdown that describes a release, from its manifest; raises unless its files are whole and all checks passed.

    ``checks``: (check_code, checked, failed). The text is also written to ``out``.md beside the release.
    """
    changed = changed_files(spark, out)
    if not changed.isEmpty():
        raise AssertionError(f"files changed since they were published: {[r.file for r in changed.limit(5).collect()]}")
    require(checks)
    m = spark.read.json(f"{out}/manifest").first().asDict(recursive=True)
    lines = [f"# {title}", "", f"Schema {m['schema_version']}, {m['rectangle_semantics']} boxes in units of 1/{m['quantization_scale']}.", "", "| | |", "|-|-|"]
    lines += [f"| {k} | {m[k]} |" for k in ("group_count", "r1_count", "r2_count")] + [f"| {k} | {n} |" for k, n in m["states"].items()]
    if m.get("ledger"):
        lines += ["", "| side | key | rows |", "|-|-|-|", *[f"| {r['side']} | {r['key']} | {r['n']} |" for r in m["ledger"]]]
    lines += ["", "| check | rows | failed |", "|-|-|-|", *[f"| {r.check_code} | {r.checked} | {r.failed} |" for r in checks.orderBy("check_code").collect()], ""]
    text = "\n".join(lines)
    fs, path = _fs(spark, f"{out}.md")
    stream = fs.create(path, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    return text


#: Files up to this size are digested by built-in functions; longer ones do not fit a value and are read as streams.
_WHOLE_BYTES = 512 << 20


def _stream_digests(batches):
    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            fs, at = pa.fs.FileSystem.from_uri(path)
            h = hashlib.sha256()
            with fs.open_input_stream(at) as f:
                while block := f.read(8 << 20):
                    h.update(block)
            found.append(h.hexdigest())
        yield pa.record_batch([batch.column(0), pa.array(found, pa.string())], names=["path", "sha256"])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha256) of the release's files, by path below the release."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    whole = files.where(F.col("length") <= _WHOLE_BYTES).select("path", F.sha2("content", 256).alias("sha256"))
    long = files.where(F.col("length") > _WHOLE_BYTES).select("path").mapInArrow(_stream_digests, "path string, sha256 string")
    last = path.rstrip("/").split("/")[-1]
    return whole.unionByName(long).select(F.regexp_extract("path", rf"/{last}/(.*)$", 1).alias("file"), "sha256")


def changed_files(spark: SparkSession, path: str) -> DataFrame:
    """Files whose digest is no longer the one that the release recorded, or that came or went."""
    recorded = spark.read.schema("file string, sha256 string").json(f"{path}/digests")
    now = digests(spark, path).where("file not like 'digests/%'").withColumnRenamed("sha256", "now")
    return recorded.join(now, "file", "full_outer").where(~F.col("sha256").eqNullSafe(F.col("now")))


def load(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """r1, r2 and groups of a release; raises unless its schema version is this one and all hold as many rows as its manifest says.

    Rows are counted from the files' footers.
    """
    manifest = spark.read.json(f"{path}/manifest").first()
    if manifest["schema_version"] != SCHEMA_VERSION:
        raise ValueError(f"release has schema version {manifest['schema_version']}")
    for side in ("r1", "r2"):
        check_schema(spark.read.parquet(f"{path}/{side}.parquet"), RELATION)
    out = {s: spark.read.schema(RELATION).parquet(f"{path}/{s}.parquet") for s in ("r1", "r2")} | {"groups": spark.read.parquet(f"{path}/groups.parquet")}
    for name, rows in out.items():
        wanted, found = manifest["group_count" if name == "groups" else f"{name}_count"], rows.count()
        if found != wanted:
            raise ValueError(f"{name} has {found} rows and the manifest says {wanted}")
    return out


def group_rows(release: dict[str, DataFrame], side: str, group_id: int) -> DataFrame:
    """One group's slice; the filter reaches the scan and row groups of other groups are skipped."""
    return release[side].where(F.col("group_id") == group_id)


def scratch_release(spark: SparkSession, records: DataFrame, groups: DataFrame) -> str:
    return publish(spark, f"{shared_dir(spark)}/release-{uuid.uuid4().hex}", records, groups)


def images_table(expected: DataFrame, found: DataFrame, key: str, name: str) -> DataFrame:
    """One row per expected image (``key``, ``name``) with the file's size, digests and native dimensions.

    ``status``: found, missing (no file), repeated (several files of that name), conflict (several that differ).
    """
    files = found.groupBy(F.col("file_name").alias(name)).agg(
        F.count("*").alias("__n"), F.count_distinct("sha256").alias("__d"), *[F.min(c).alias(c) for c in ("size", "sha256", "crc32", "width", "height")]
    )
    status = F.when(F.col("__n").isNull(), "missing").when(F.col("__d") > 1, "conflict").when(F.col("__n") > 1, "repeated").otherwise("found")
    return expected.select(key, name).join(files, name, "left").select(key, name, "size", "sha256", "crc32", "width", "height", status.alias("status"))
