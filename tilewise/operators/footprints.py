"""Building footprints: from texts to quantized, projected rectangles, every rejected record with its reason and detail.

The order of reasons is the contract's: a record that is none, a text that does not parse, a type that is no polygon, an empty
geometry, an invalid one, vertices that are not finite before or after projection, a projected geometry that is invalid, a
centroid that is not finite or outside the country, a rectangle that is empty after rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, quantize, reader, validity
from ..scratch import settled
from .rejects import cascade

Polygon = list[list[tuple[float, float]]]


def projected_boundary(spark: SparkSession, polygons: list[Polygon]) -> list[Polygon]:
    """The polygons of a boundary (a bounded table) with projected vertices, checked before and after."""
    rows = [(i, j, k, float(x), float(y)) for i, rings in enumerate(geometry.check_polygons(polygons)) for j, ring in enumerate(rings) for k, (x, y) in enumerate(ring)]
    x, y = geometry.project(F.col("x"), F.col("y"))
    placed = spark.createDataFrame(rows, "i int, j int, k int, x double, y double").select("i", "j", "k", x.alias("x"), y.alias("y"))
    out = [[[(0.0, 0.0)] * len(ring) for ring in rings] for rings in polygons]
    for r in placed.collect():
        out[r.i][r.j][r.k] = (r.x, r.y)
    return geometry.check_polygons(out)


def _said(fault: str) -> Column:
    return F.concat(F.col(f"{fault}.reason"), F.lit("["), F.concat_ws(" ", F.col(f"{fault}.x"), F.col(f"{fault}.y")), F.lit("]"))


def judge(df: DataFrame, text: str, form: Column | str, boundary: list[Polygon]) -> DataFrame:
    """The rows with own_id, properties, reason, detail, cx, cy (projected) and, where kept, x0, y0, x1, y1.

    ``boundary``: projected polygons. A null text is a malformed record. Columns of ``df`` with these names are refused.
    """
    new = ("g", "fault", "whole", "projected", "whole_projected", "projected_fault", "own_id", "properties", "reason", "detail", "cx", "cy", "q", "x0", "y0", "x1", "y1")
    if clash := {c.lower() for c in df.columns} & set(new):
        raise ValueError(f"columns {sorted(clash)} are there already")
    polygon = F.col("g.kind").isin(*reader.POLYGONS)
    rows = df.withColumn("g", reader.parse_geometry(F.col(text), form))
    rows = rows.withColumn("fault", validity.first_fault("g.parts")).withColumn("whole", geometry.all_finite(F.flatten("g.parts")))
    sound = polygon & ~F.col("g.empty") & F.col("fault").isNull() & F.col("whole")
    rows = rows.withColumn("projected", F.when(sound, geometry.project_parts(F.col("g.parts"))))
    rows = settled(rows).withColumn("whole_projected", geometry.all_finite(F.flatten("projected")))
    rows = rows.withColumn("projected_fault", validity.first_fault(F.when(F.col("whole_projected"), F.col("projected"))))
    c = geometry.centroid(F.when(F.col("whole_projected") & F.col("projected_fault").isNull(), F.col("projected")))
    rows = rows.withColumns({"cx": c[0], "cy": c[1]})
    inside = F.coalesce(geometry.covers(boundary)("cx", "cy"), F.lit(False))
    q = F.array(*[quantize.quantized_double(v) for v in geometry.bounds(F.flatten("projected"))])
    # Projected vertices and centroids are looked at in many places and made once.
    rows = settled(rows.withColumn("q", F.when(F.col("whole_projected") & F.col("projected_fault").isNull(), q)))
    finite = lambda v: F.col(v).isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    reason = cascade(
        (F.col(text).isNull() | F.col("g.record_error").isNotNull(), "malformed_record"),
        (F.col("g.geometry_error").isNotNull(), "malformed_geometry"),
        (~polygon, "unsupported_geometry_type"),
        (F.col("g.empty"), "empty_geometry"),
        (F.col("fault").isNotNull(), "invalid_geometry"),
        (~F.col("whole"), "nonfinite_source_geometry"),
        (~F.col("whole_projected"), "nonfinite_projected_geometry"),
        (F.col("projected_fault").isNotNull(), "invalid_projected_geometry"),
        (~(finite("cx") & finite("cy")), "nonfinite_projected_centroid"),
        (~inside, "centroid_outside_country"),
        ((F.get("q", F.lit(0)) >= F.get("q", F.lit(2))) | (F.get("q", F.lit(1)) >= F.get("q", F.lit(3))), "quantized_degenerate"),
    )
    rows = rows.withColumn("reason", reason)
    of = lambda name: F.col("reason") == name
    detail = (
        F.when(of("malformed_record"), F.col("g.record_error"))
        .when(of("malformed_geometry"), F.col("g.geometry_error"))
        .when(of("invalid_geometry"), _said("fault"))
        .when(of("invalid_projected_geometry"), _said("projected_fault"))
    )
    box = [F.when(F.col("reason").isNull(), F.get("q", F.lit(i))).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return rows.select(*df.columns, "g.own_id", "g.properties", "reason", detail.alias("detail"), "cx", "cy", *box)
