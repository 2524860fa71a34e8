"""The layout of rectangle relations, and its gate."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMA_VERSION = "tilewise-rectangles-v1"

#: The columns of a relation file, in order.
RELATION = T.StructType([T.StructField(n, T.LongType(), False) for n in ("record_id", "group_id", "x0", "y0", "x1", "y1", "weight")])


def schema_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """(place, name, want, have): columns that differ from the expected ones in name, type or place; none if all agree."""
    spark: SparkSession = df.sparkSession
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    rows = []
    for i in range(max(len(have), len(want))):
        h, w = (x[i] if i < len(x) else None for x in (have, want))
        if h != w:
            rows.append((i, (w or h)[0], " ".join(w) if w else None, " ".join(h) if h else None))
    return spark.createDataFrame(rows, "place int, name string, want string, have string")


def check_schema(df: DataFrame, expected: T.StructType) -> None:
    """Raise unless ``df`` has the expected names and types, in order."""
    if problems := schema_report(df, expected).collect():
        raise ValueError("schema differs: " + "; ".join(f"{r.want} expected, {r.have} found" for r in problems))
