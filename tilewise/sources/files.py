"""Readers built on Spark's own sources: annotation documents, tracking files, page results, images, manifests."""

from __future__ import annotations

import json
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import geometry, reader, validity
from ..functions.identity import HEX_SHA256, file_identity
from ..functions.quantize import corner_extents, quantize_texts
from .lines import opened, register


def _parsed(rows: DataFrame, value: str, items: str, schema: T.StructType, carry: list[str]) -> DataFrame:
    """One row per element of the array ``items`` of JSON texts: ``carry`` columns, ``nth`` and the fields of ``schema``.

    Spark's JSON reader turns numbers into doubles on the way to text, so numbers are kept as they stand here: string
    fields get the digits of the source.
    """
    out = T.StructType([rows.schema[c] for c in carry] + [T.StructField("nth", T.IntegerType())] + list(schema.fields))

    def cast(v, kind):
        if v is None:
            return None
        if isinstance(kind, T.ArrayType):
            return [None if e is None else str(e) for e in v] if isinstance(v, list) else []
        try:
            return str(v) if isinstance(kind, T.StringType) else int(v)
        except ValueError:
            return None

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(value)).to_pylist()
            for i, text in enumerate(texts):
                whole = json.loads(text, parse_float=str, parse_int=str, parse_constant=str)
                found = whole.get(items) or []
                for lo in range(0, len(found), 20_000):
                    some = found[lo : lo + 20_000]
                    kept = [pa.array(batch.column(batch.schema.get_field_index(c)).slice(i, 1).to_pylist() * len(some), batch.schema.field(c).type) for c in carry]
                    fields = [pa.array([cast(e.get(f.name), f.dataType) for e in some], to_arrow_type(f.dataType)) for f in schema.fields]
                    yield pa.record_batch([*kept, pa.array(range(lo, lo + len(some)), pa.int32()), *fields], names=out.names)

    return rows.select(value, *carry).mapInArrow(run, out)


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def annotation_documents(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """images, categories and annotations of documents with one JSON object a file; ordinals are 0-based per file.

    Boxes keep their number texts, in ``bbox``; ``box`` is the exact quantization of those.
    """
    docs = spark.read.text(path, wholetext=True).withColumn("source_file", file_identity(F.col("_metadata.file_path")))
    whole, number, text = T.LongType(), T.IntegerType(), T.StringType()
    images = _parsed(docs, "value", "images", _fields(id=whole, file_name=text, width=number, height=number), ["source_file"])
    notes = _parsed(docs, "value", "annotations", _fields(id=whole, image_id=whole, category_id=number, precedence=number, iscrowd=number, bbox=T.ArrayType(text)), ["source_file"])
    notes = notes.withColumn("q", quantize_texts(F.col("bbox")))
    return {
        "images": images.withColumnRenamed("nth", "ordinal").withColumn("identity", file_identity(F.col("file_name"))),
        "categories": _parsed(docs, "value", "categories", _fields(id=number, name=text), ["source_file"]).drop("nth"),
        "annotations": notes.withColumnRenamed("nth", "ordinal").select("*", "q.box", "q.reason").drop("q"),
    }


def tracking_rows(spark: SparkSession, path: str, side: str) -> DataFrame:
    """Header-less tracking rows with 1-based ordinals that count blank rows; r1 needs 9 columns, r2 needs 7.

    ``reason``: malformed_row, gt_invalid_flag, gt_non_pedestrian, nonfinite_score or the box's own.
    """
    register(spark)
    rows = spark.read.format("numbered_lines").option("path", path).load()
    f = F.split("value", ",")
    least = 9 if side == "r1" else 7
    number = lambda i: F.get(F.col("f"), F.lit(i)).try_cast("double")
    rows = rows.select("source_file", F.col("line").alias("ordinal"), f.alias("f"), F.size(f).alias("columns"))
    rows = rows.withColumn("q", quantize_texts(F.transform(F.slice("f", 3, 4), lambda s: F.trim(s))))
    own = F.col("q.reason")
    bad = F.coalesce(F.isnan(number(6)) | (F.abs(number(6)) == float("inf")), F.lit(True))
    if side == "r1":
        reason = F.when(F.col("columns") < least, "malformed_row").when(~number(6).eqNullSafe(F.lit(1.0)), "gt_invalid_flag").when(~number(7).eqNullSafe(F.lit(1.0)), "gt_non_pedestrian").otherwise(own)
    else:
        reason = F.when(F.col("columns") < least, "malformed_row").when(bad, "nonfinite_score").otherwise(own)
    return rows.select("source_file", "ordinal", F.get("f", F.lit(0)).try_cast("int").alias("frame"), F.get("f", F.lit(1)).alias("source_id"), "columns", F.get("f", F.lit(6)).alias("score"), "q.box", reason.alias("reason"))


def ini_entries(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, section, key, value) of INI files, one row an entry, each file read whole by one task.

    Keys are in lower case; lines that begin with # or ; are comments; = or : parts key and value. A section without entries
    has one row without key, a file without sections one without section.
    """
    rest = lambda s: F.regexp_replace(s, r"\A[^\n]*(\n|\z)", "")
    entry = F.lit(r"(?m)^[ \t]*([^\s=:#;][^=:\r\n]*?)[ \t]*[=:][ \t]*([^\r\n]*?)[ \t]*\r?$")
    cut = F.split("value", r"(?m)^[ \t]*\[(?=[^\]\r\n]*\])")
    rows = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.explode_outer(F.slice(cut, 2, F.size(cut))).alias("part"))
    pairs = F.arrays_zip(F.regexp_extract_all(rest(F.col("part")), entry, 1).alias("key"), F.regexp_extract_all(rest(F.col("part")), entry, 2).alias("value"))
    rows = rows.select("path", F.regexp_extract("part", r"\A([^\]]*)\]", 1).alias("section"), F.explode_outer(pairs).alias("entry"))
    return rows.select("path", "section", F.lower("entry.key").alias("key"), "entry.value")


def sequence_info(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per sequence file: name, frames, width, height, of its section ``Sequence``.

    A number that is missing, given twice or no whole number raises with the file's path.
    """
    entries = ini_entries(spark, paths)
    of = lambda k: F.when((F.col("section") == "Sequence") & (F.col("key") == k), F.col("value"))

    def number(key: str) -> Column:
        once = F.when(F.count(of(key)) == 1, F.max(of(key)).try_cast("int"))
        return F.coalesce(once, F.raise_error(F.concat(F.col("path"), F.lit(f": {key} is not there once as a whole number"))).cast("int"))

    found = entries.groupBy("path").agg(F.coalesce(F.max(of("name")), F.lit("")).alias("sequence"), number("seqlength").alias("frames"), number("imwidth").alias("width"), number("imheight").alias("height"))
    return found.drop("path")


def page_results(spark: SparkSession, path: str) -> DataFrame:
    """Predictions of gzip JSON lines, one page a line: page columns, 1-based line, 0-based ordinal, exact boxes."""
    register(spark)
    rows = spark.read.format("numbered_lines").option("path", path).load()
    page = rows.select("source_file", F.col("line").alias("prediction_jsonl_line"), "value", F.get_json_object("value", "$.page_id").alias("page_id"), F.get_json_object("value", "$.status").alias("status"))
    number, text = T.IntegerType(), T.StringType()
    fields = _fields(prediction_index=number, query_index=number, label=number, score=text, x0=text, y0=text, x1=text, y1=text)
    flat = _parsed(page, "value", "predictions", fields, ["source_file", "prediction_jsonl_line", "page_id", "status"])
    q = corner_extents(F.array("x0", "y0", "x1", "y1"))
    return flat.withColumnsRenamed({"prediction_index": "rank", "query_index": "query"}).withColumn("q", q).select("*", "q.extents", "q.box", "q.reason").drop("q")


def footprints_geojson(spark: SparkSession, path: str, member: str | None = None) -> DataFrame:
    """GeoJSON lines in a ZIP: record, line, geometry type, parts (each a shell and its holes), properties."""
    register(spark)
    source = spark.read.format("numbered_lines").option("path", path)
    rows = (source.option("member", member) if member else source).load()
    geometry = F.coalesce(F.get_json_object("value", "$.geometry"), F.col("value"))
    rows = rows.withColumns({"kind": F.get_json_object(geometry, "$.type"), "coordinates": F.get_json_object(geometry, "$.coordinates"), "properties": F.get_json_object("value", "$.properties")})
    point = "array<array<double>>"
    one, many = F.array(F.from_json("coordinates", f"array<{point}>")), F.from_json("coordinates", f"array<array<{point}>>")
    parts = F.when(F.col("kind") == "Polygon", one).when(F.col("kind") == "MultiPolygon", many)
    parts = F.transform(parts, lambda part: F.transform(part, lambda r: F.transform(r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))))
    return rows.select("source_file", "record", "line", "kind", "properties", parts.alias("parts"))


def footprints_csv(spark: SparkSession, path: str, geometry: str = "geometry") -> DataFrame:
    """CSV or CSV.gz with a WKT column: record, physical line, wkt, all fields as a map; a row of another width has null."""
    register(spark)
    rows = spark.read.format("numbered_lines").option("path", path).option("kind", "csv").load()
    fields = F.from_json("value", "map<string,string>")
    return rows.select("source_file", "record", "line", fields.alias("fields")).withColumn("wkt", F.col("fields")[geometry])


def boundary_polygons(spark: SparkSession, path: str) -> list[list[geometry.Ring]]:
    """Polygons, each a shell and its holes, of a GeoJSON boundary (collection, feature or geometry), for ``covers``.

    One small file, read on the driver; all features together are the boundary, whether they overlap or touch. A ring
    that is no valid one raises.
    """
    whole = json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    out = []
    for f in whole.get("features", [whole]):
        g = f.get("geometry") or f
        if g.get("type") not in ("Polygon", "MultiPolygon"):
            raise ValueError(f"not a polygon boundary: {g.get('type')}")
        parts = [g["coordinates"]] if g["type"] == "Polygon" else g["coordinates"]
        out += [[[(float(p[0]), float(p[1])) for p in ring] for ring in rings] for rings in parts]
    return geometry.check_polygons(out)


def boundary_features(spark: SparkSession, path: str) -> DataFrame:
    """(path, nth, kind, parts, fault): the features of GeoJSON boundary files (collections, features or geometries).

    ``fault``: why a feature is no sound polygon (its text, its type, or the first fault of its rings), else null.
    """
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    listed = F.get_json_object("value", "$.features")
    rows = rows.select("path", F.posexplode(F.coalesce(F.from_json(listed, "array<string>"), F.array("value"))).alias("nth", "text"))
    rows = rows.withColumn("g", reader.parse_geometry(F.col("text"), "geojson")).select("path", "nth", "g.*")
    unread = F.coalesce("record_error", "geometry_error", F.when(~F.coalesce(F.upper("kind").isin(*reader.POLYGONS), F.lit(False)), "not a polygon"), F.when(F.size("parts") == 0, "empty"))
    return rows.select("path", "nth", "kind", "parts", F.coalesce(unread, validity.first_fault("parts")["reason"]).alias("fault"))


def image_files(spark: SparkSession, path: str, pattern: str = "*.png") -> DataFrame:
    """Name, size, sha256, crc32 and native dimensions (from the PNG header bytes) of image files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    side = lambda at: F.conv(F.hex(F.substring("content", at, 4)), 16, 10).cast("int")
    is_png = F.hex(F.substring("content", 1, 8)) == "89504E470D0A1A0A"
    return files.select(file_identity(F.col("path")).alias("file_name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), F.crc32("content").alias("crc32"), F.when(is_png, side(17)).alias("width"), F.when(is_png, side(21)).alias("height"))


def tensors(spark: SparkSession, paths: list[str], name: str) -> DataFrame:
    """(path, values): one array of an NPZ file per row, flattened to floats; files are read by the tasks.

    For arrays that do not fit a value see ``tensor_rows``.
    """

    def load(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with opened(path) as f, np.load(f, allow_pickle=False) as z:
                    yield pa.RecordBatch.from_pylist([{"path": path, "values": z[name].astype(np.float32).ravel()}], schema=pa.schema([("path", pa.string()), ("values", pa.list_(pa.float32()))]))

    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths))).mapInArrow(load, "path string, values array<float>")


#: Bytes of an array that are decoded at a time.
_TENSOR_BYTES = 4 << 20


def tensor_rows(spark: SparkSession, path: str, name: str, kind: str = "float") -> DataFrame:
    """(path, row, values): the rows of one array of the NPZ files below ``path``, further dimensions flattened.

    Arrays stream through the tasks by blocks of rows, so that their size does not matter; the archive's CRC is checked at the end. A file
    without the array, or with one that is cut short, in column order or of objects, raises. ``kind``: float, double or long.
    """
    to = {"float": np.float32, "double": np.float64, "long": np.int64}[kind]

    def load(batches):
        for batch in batches:
            for at in batch.column(0).to_pylist():
                with opened(at) as f, zipfile.ZipFile(f) as z, z.open(f"{name}.npy") as m:
                    read = np.lib.format.read_array_header_1_0 if np.lib.format.read_magic(m) == (1, 0) else np.lib.format.read_array_header_2_0
                    shape, by_column, dtype = read(m)
                    if dtype.hasobject or (by_column and len(shape) > 1):
                        raise ValueError(f"{at}: {name} is of objects or in column order")
                    rows, width = (shape[0] if shape else 1), int(np.prod(shape[1:], dtype=np.int64))
                    step = max(1, _TENSOR_BYTES // max(1, width * dtype.itemsize))
                    for lo in range(0, rows, step):
                        n = min(step, rows - lo)
                        raw = m.read(n * width * dtype.itemsize)
                        if len(raw) != n * width * dtype.itemsize:
                            raise ValueError(f"{at}: {name} ends early")
                        values = pa.array(np.frombuffer(raw, dtype).astype(to))
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), values)
                        yield pa.record_batch([pa.array([at] * n), pa.array(np.arange(lo, lo + n)), lists], names=["path", "row", "values"])
                    if m.read(1):
                        raise ValueError(f"{at}: {name} is longer than its header says")

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").option("recursiveFileLookup", "true").load(path).select("path")
    return files.mapInArrow(load, f"path string, row long, values array<{kind}>")


_INPUT = "path:string,sha256:string,url:string,size_bytes:long"
_LOCK = f"dataset string, crs string, boundary struct<{_INPUT}>, sources array<struct<side:string,format:string,{_INPUT}>>"
FORMATS = ("geojsonl_zip", "geojsonl.zip", "geojsonl", "csv", "csv_gz", "csv.gz")


def lock_entries(spark: SparkSession, path: str, dataset: str | None = None, crs: str | None = None) -> DataFrame:
    """Inputs of one or more lock files (``lock``, ``role`` boundary or source), each with every problem it has.

    Of an input: repeated_path, path (absolute, or leaving its root), digest, url (no provenance); of a source also side
    and format; of the lock as a whole, on all its rows: dataset, crs, sides (r1 and r2 are not both there), boundary.
    """
    lock = spark.read.schema(_LOCK).json(path, multiLine=True).withColumn("lock", F.col("_metadata.file_path"))
    sides = F.array_distinct(F.transform("sources", lambda s: s["side"]))
    whole = F.array_compact(
        F.array(
            F.when(~F.col("dataset").eqNullSafe(F.lit(dataset)), "dataset") if dataset else F.lit(None).cast("string"),
            F.when(F.coalesce("crs", F.lit(crs)) != crs, "crs") if crs else F.lit(None).cast("string"),
            F.when(~F.coalesce(F.array_contains(sides, "r1") & F.array_contains(sides, "r2"), F.lit(False)), "sides"),
        )
    )
    fields = lambda c, side, format_: F.struct(side.alias("side"), format_.alias("format"), *[F.col(c)[n].alias(n) for n in ("path", "sha256", "url", "size_bytes")])
    none = F.lit(None).cast("string")
    boundary = lock.where("boundary is not null").select("lock", whole.alias("whole"), F.lit("boundary").alias("role"), fields("boundary", none, none).alias("s"))
    sources = lock.select("lock", whole.alias("whole"), F.lit("source").alias("role"), F.explode("sources").alias("x")).select("lock", "whole", "role", fields("x", F.col("x.side"), F.col("x.format")).alias("s"))
    rows = sources.unionByName(boundary).select("lock", "whole", "role", "s.*")
    repeated = rows.groupBy("lock", "path").agg(F.count("*").alias("n"))
    source = F.col("role") == "source"
    loose = F.col("path").isNull() | F.col("path").startswith("/") | F.array_contains(F.split("path", "/"), "..")
    problems = F.array_compact(
        F.array(
            F.when(F.col("n") > 1, "repeated_path"),
            F.when(loose, "path"),
            F.when(source & ~F.coalesce(F.col("side").isin("r1", "r2"), F.lit(False)), "side"),
            F.when(~F.coalesce(F.col("sha256").rlike(HEX_SHA256), F.lit(False)), "digest"),
            F.when(F.coalesce("url", F.lit("")) == "", "url"),
            F.when(source & ~F.coalesce(F.col("format").isin(*FORMATS), F.lit(False)), "format"),
        )
    )
    return rows.join(repeated, ["lock", "path"], "left").withColumn("problems", F.concat("whole", problems)).drop("n", "whole")


def verified_lock(entries: DataFrame, found: DataFrame) -> DataFrame:
    """``entries`` with the problems of the files themselves added: missing, checksum, size.

    ``found``: (path, size, sha256) of the files that are there, by path under the root.
    """
    files = found.select("path", F.col("size").alias("__size"), F.col("sha256").alias("__sha256"))
    more = F.array_compact(
        F.array(
            F.when(F.col("__size").isNull(), "missing"),
            F.when(F.col("__sha256") != F.col("sha256"), "checksum"),
            F.when(F.col("__size") != F.col("size_bytes"), "size"),
        )
    )
    return entries.join(files, "path", "left").withColumn("problems", F.concat("problems", more)).drop("__size", "__sha256")
