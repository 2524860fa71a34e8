"""Adapters that turn the driver tables into boxes, frames, model outputs and footprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import group_key
from ..functions.quantize import with_boxes
from ..operators import grouping
from ..scratch import settled

#: Rows of lineitem are unique only as a whole: every order ends in all of these columns.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
FRAME = 50
WINDOWS = (("low", 0, 0, 10000, 10000), ("middle", 10000, 10000, 30000, 30000), ("wide", 5000, 5000, 45000, 20000))
LABELS = 12
TOP_K = 20
THRESHOLD = 0.53
BOUNDARY = [(34.0, -5.0), (43.0, -5.0), (43.0, 6.0), (38.5, 3.0), (34.0, 6.0), (34.0, -5.0)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, *by: str, heavy: bool = False) -> DataFrame:
    """``rows`` dealt out over all cores, where a table is one file of few row groups; large tables stay as they are.

    ``heavy``: narrow rows that ask for far more work than a shuffle are dealt out at any size, as a file may have fewer row groups
    than the partitions that it is read in.
    """
    cores, parts = rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()
    if parts >= cores and not heavy:
        return rows
    return settled(rows.repartition(max(parts, 2 * cores) if heavy else cores, *by))


def line_boxes(spark: SparkSession, sf_dir: str, *by: str) -> DataFrame:
    """lineitem as boxes of both sides, quantized, with the reject reason: groups are (supplier, month of shipment).

    ``by``: columns that a small table is dealt out by, such as those of the join to come.
    """
    money = lambda c: F.col(c).cast("decimal(10,2)")  # noqa: E731  at most 18 digits in all steps, so that decimals stay longs
    rows = spread(table(spark, sf_dir, "lineitem").select(*LINE_ORDER), *by).withColumns(
        {
            "side": F.when(F.col("l_linestatus") == "F", "r1").otherwise("r2"),
            "supp": F.col("l_suppkey"),
            "mon": F.month("l_shipdate"),
            "semantic_key": group_key(F.col("l_suppkey"), F.month("l_shipdate")),
            "x": (F.col("l_partkey") % 50).cast("decimal(8,0)") + money("l_discount"),
            "y": money("l_quantity"),
            "w": (money("l_tax") * 100).cast("decimal(10,2)"),
            "h": (money("l_discount") * 50).cast("decimal(10,2)"),
        }
    )
    return with_boxes(rows)


def kept_boxes(spark: SparkSession, sf_dir: str, *by: str) -> DataFrame:
    return line_boxes(spark, sf_dir, *by).where("reason is null")


def line_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.pack(grouping.mentioned(line_boxes(spark, sf_dir), "semantic_key", LINE_ORDER, ["supp", "mon"]), "semantic_key")


def line_records(spark: SparkSession, sf_dir: str, groups: DataFrame | None = None) -> DataFrame:
    groups = line_groups(spark, sf_dir) if groups is None else groups
    kept = kept_boxes(spark, sf_dir).select("side", "semantic_key", *LINE_ORDER, "x0", "y0", "x1", "y1")
    return grouping.number_records(kept, groups, "semantic_key", LINE_ORDER)


def sides(boxes: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """(r1, r2) with the given columns and the box."""
    cut = lambda s: boxes.where(F.col("side") == s).select(*columns, "x0", "y0", "x1", "y1")
    return cut("r1"), cut("r2")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as detections: a frame per user and day, value as score, event type as class, props.k as attribute."""
    e = table(spark, sf_dir, "events")
    return e.withColumns({"day": F.to_date("ts"), "attribute": F.get_json_object("props", "$.k").try_cast("int")})


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as logits: the first 60 numbers are 5 queries of 12 labels."""
    from ..operators.postprocess import flattened

    e = table(spark, sf_dir, "embeddings").select("vec_id", F.slice("embedding", 1, 60).alias("logits"))
    return flattened(e, "vec_id", "logits", LABELS)


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as WKT footprints near the equator; some are broken on purpose, by key."""
    k = F.col("p_partkey")
    lon = (F.lit(34.0) + (k % 1000) / F.lit(100.0)).alias("lon")
    lat = (F.lit(-5.0) + (k % 700) / F.lit(60.0)).alias("lat")
    size = (F.col("p_size") / F.lit(1000.0)).alias("size")
    p = table(spark, sf_dir, "part").select(k, lon, lat, size)
    num = lambda c: F.format_string("%.6f", c)
    point = lambda x, y: F.concat_ws(" ", num(x), num(y))
    x0, y0, x1, y1 = F.col("lon"), F.col("lat"), F.col("lon") + F.col("size"), F.col("lat") + F.col("size")
    ring = F.concat_ws(", ", point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))
    open_ring = F.concat_ws(", ", point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1))
    polygon = lambda r: F.concat(F.lit("POLYGON (("), r, F.lit("))"))
    m = F.col("p_partkey") % 40
    wkt = (
        F.when(m == 0, F.lit("not a geometry"))
        .when(m == 1, F.concat(F.lit("POINT ("), point(x0, y0), F.lit(")")))
        .when(m == 2, F.lit("POLYGON EMPTY"))
        .when(m == 3, polygon(open_ring))
        .when(m == 4, polygon(F.regexp_replace(ring, r"^\S+", "NaN")))
        .when(m == 5, F.concat(F.lit("MULTIPOLYGON ((("), ring, F.lit(")))")))
        .otherwise(polygon(ring))
    )
    return p.withColumn("wkt", wkt)


def shape_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as polygons of sixteen classes by key, moved by the key: sound ones and one of each fault."""
    k = F.col("p_partkey")
    ring = lambda *points: [tuple(map(int, p.split())) for p in points]
    box = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    classes = (
        [[ring("0 0", "0 0", "4 0", "4 4", "0 4", "0 4", "0 0")]],
        [[ring("0 0", "4 4", "4 0", "0 4", "0 0")]],
        [[box(0, 0, 4, 4), box(1, 1, 2, 2)]],
        [[box(0, 0, 4, 4), box(5, 5, 6, 6)]],
        [[box(0, 0, 4, 4), box(3, 3, 5, 5)]],
        [[box(0, 0, 10, 10), box(1, 1, 9, 9), box(2, 2, 3, 3)]],
        [[box(0, 0, 4, 4)], [box(1, 1, 2, 2)]],
        [[box(0, 0, 4, 4)], [box(4, 0, 8, 4)]],
        [[box(0, 0, 4, 4)], [box(4, 4, 8, 8)]],
        [[box(0, 0, 4, 4), ring("0 0", "2 1", "1 2", "0 0")]],
        [[box(0, 0, 4, 4), ring("0 2", "2 1", "4 2", "2 3", "0 2")]],
        [[ring("0 0", "2 2", "4 0", "4 4", "2 2", "0 4", "0 0")]],
        [[ring("0 0", "4 0", "2 0", "2 2", "0 0")]],
        [[ring("0 0", "1 1", "2 2", "0 0")]],
        [[ring("0 0", "0 0", "1 1", "0 0")]],
        [[box(0, 0, 9, 9), box(1, 1, 8, 8)], [box(2, 2, 3, 3)]],
    )

    def text(parts: list) -> Column:
        point = lambda p: F.concat_ws(" ", (k % 97 + p[0]).cast("string"), (k % 31 + p[1]).cast("string"))
        listed = lambda items: F.concat(F.lit("("), F.concat_ws(", ", *items), F.lit(")"))
        return F.concat(F.lit("MULTIPOLYGON "), listed([listed([listed(map(point, r)) for r in part]) for part in parts]))

    cases = F.array(*map(text, classes))
    return table(spark, sf_dir, "part").select(k, F.get(cases, (k % len(classes)).cast("int")).alias("wkt"))
