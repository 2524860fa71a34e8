"""Groups: universe, bounds, states, numbering, slices and slab packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import ordered, tasks_for

SIDES = ("r1", "r2")


def universe(boxes: DataFrame, key: str, order: list[str], meta: list[str]) -> DataFrame:
    """One row per group mentioned on either side before any reject, with the metadata of its first mention."""
    first = F.min_by(F.struct(*meta), F.struct(*order)).alias("m")
    return boxes.groupBy(key).agg(first).select(key, "m.*")


def aggregates(kept: DataFrame, key: str) -> DataFrame:
    """Counts by side and bounds over both sides of the retained boxes."""
    counts = [F.count_if(F.col("side") == s).alias(f"{s}_count") for s in SIDES]
    return kept.groupBy(key).agg(*counts, F.min("x0").alias("local_min_x"), F.min("y0").alias("local_min_y"), F.max("x1").alias("local_max_x"), F.max("y1").alias("local_max_y"))


def state(r1: Column, r2: Column) -> Column:
    return F.when((r1 > 0) & (r2 > 0), "both_nonempty").when(r1 > 0, "r1_only").when(r2 > 0, "r2_only").otherwise("both_empty")


def mentioned(boxes: DataFrame, key: str, order: list[str], meta: list[str]) -> DataFrame:
    """``universe`` and ``aggregates`` of boxes with their ``reason`` in one pass: rejected boxes only mention a group."""
    ok = F.col("reason").isNull()
    counts = [F.count_if(ok & (F.col("side") == s)).alias(f"{s}_count") for s in SIDES]
    bounds = [f(F.when(ok, F.col(c))).alias(n) for f, c, n in ((F.min, "x0", "local_min_x"), (F.min, "y0", "local_min_y"), (F.max, "x1", "local_max_x"), (F.max, "y1", "local_max_y"))]
    return boxes.groupBy(key).agg(F.min_by(F.struct(*meta), F.struct(*order)).alias("m"), *counts, *bounds).select(key, "m.*", *[f"{s}_count" for s in SIDES], "local_min_x", "local_min_y", "local_max_x", "local_max_y")


def build(universe_: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """The groups table of a universe and the retained boxes; see :func:`pack`."""
    return pack(universe_.join(aggregates(kept, key), key, "left").withColumns({f"{s}_count": F.coalesce(f"{s}_count", F.lit(0)).cast("long") for s in SIDES}), key)


def pack(g: DataFrame, key: str) -> DataFrame:
    """Groups with counts and bounds, numbered by key, with slices into both relations and disjoint slabs along x.

    Slab starts follow a cursor that moves past every occupied group's width and a gap of one. That is the closed form
    1 + sum of (width + 1) over the occupied groups before, so a prefix sum replaces the loop. An empty group has a slab
    of no width at the cursor and no shift.
    """
    occupied = (F.col("r1_count") + F.col("r2_count")) > 0
    width = F.col("local_max_x") - F.col("local_min_x")
    g = ordered(g, [key], "group_id", {"__cursor": F.when(occupied, width + 1).otherwise(0), "r1_start": F.col("r1_count"), "r2_start": F.col("r2_count")})
    lo = F.col("__cursor") + 1
    g = g.withColumns(
        {
            "global_min_x": lo,
            "global_max_x": F.when(occupied, lo + width).otherwise(lo),
            "dx": F.when(occupied, lo - F.col("local_min_x")).otherwise(F.lit(0)).cast("long"),
            "dy": F.when(occupied, 1 - F.col("local_min_y")).otherwise(F.lit(0)).cast("long"),
            "state": state(F.col("r1_count"), F.col("r2_count")),
        }
    )
    return g.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("local_min_x", "local_min_y", "local_max_x", "local_max_y")}).drop("__cursor")


def number_records(kept: DataFrame, groups: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds group_id and record_id, the place among all rows of the side in order of group key and source.

    Slices follow the same order, so that a record lies in its group's slice. The order is made by range partitions,
    which also cut a group that holds most rows.
    """
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    r1_rows, rows = groups.agg(count("r1_count"), count("r1_count") + count("r2_count")).first()
    tasks = tasks_for(kept, rows)
    placed = ordered(kept, ["side", key, *order], "__nth", tasks=tasks)
    number = F.when(F.col("side") == "r1", F.col("__nth")).otherwise(F.col("__nth") - r1_rows).cast("long")
    placed = placed.withColumn("record_id", number).drop("__nth")
    return (placed.repartition(tasks, key) if tasks else placed).join(groups.select(key, "group_id", "dx", "dy"), key)


def translate(records: DataFrame, sign: int = 1) -> DataFrame:
    """Local to packed coordinates with the group's shift (or back, with sign -1); overflow raises."""
    return records.withColumns({c: F.col(c) + F.lit(sign) * F.col("dx" if c[0] == "x" else "dy") for c in ("x0", "y0", "x1", "y1")})


def relation(records: DataFrame) -> DataFrame:
    """The packed relation: record_id, group_id, x0, y0, x1, y1, weight."""
    return translate(records).select("side", "record_id", "group_id", "x0", "y0", "x1", "y1", F.lit(1).cast("long").alias("weight"))


def one_group(kept: DataFrame) -> DataFrame:
    """One shared shift for a relation pair with a single group: both minima map to 1. One row."""
    agg = kept.agg(*[F.count_if(F.col("side") == s).alias(f"{s}_count") for s in SIDES], F.min("x0").alias("min_x"), F.min("y0").alias("min_y"), F.max("x1").alias("max_x"), F.max("y1").alias("max_y"))
    size = lambda lo, hi: F.ceil((F.col(hi) - F.col(lo)) / 1000).cast("long")
    return agg.withColumns({"dx": 1 - F.col("min_x"), "dy": 1 - F.col("min_y"), "width": size("min_x", "max_x"), "height": size("min_y", "max_y")})


def isolation(groups: DataFrame) -> DataFrame:
    """Occupied groups with the right edge of the occupied group before; ``isolated``: that edge is left of the slab.

    ``groups`` has slabs in the order of group_id, so the edge before is the largest in the range-ordered prefix.
    """
    occupied = groups.where("r1_count + r2_count > 0").select("group_id", "global_min_x", "global_max_x")
    placed = ordered(occupied, ["group_id"], "nth")
    before = placed.select((F.col("nth") + 1).alias("nth"), F.col("global_max_x").alias("previous_max_x"))
    return placed.join(before, "nth", "left").select("group_id", "global_min_x", "global_max_x", "previous_max_x", F.coalesce(F.col("previous_max_x") < F.col("global_min_x"), F.lit(True)).alias("isolated"))
