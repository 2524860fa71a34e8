"""Deterministic selection: first rows per group, evenly spaced rows, priority samples, weighted pair draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialized
from .ordering import ordered


def first_n(df: DataFrame, by: list[str], order: list[str | Column], n: int) -> DataFrame:
    """The first n rows per group in a total order; adds the 1-based ``nth``."""
    return df.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("nth") <= n)


def priority(seed: str, *key: Column) -> Column:
    """A priority that depends on key and seed alone, not on partitioning."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in key]))


def priority_sample(df: DataFrame, k: int, seed: str, *key: str) -> DataFrame:
    """Bounded uniform sample: the k rows of lowest priority (a distributed top-k, no full sort)."""
    keys = [F.col(c) for c in key]
    return df.withColumn("priority", priority(seed, *keys)).orderBy("priority", *keys).limit(k)


def bounded_samples(df: DataFrame, by: list[str], k: int, seed: str, *key: str) -> DataFrame:
    """At most k rows of each group, those of lowest priority: what quantiles over very many rows are taken from.

    The ranking is cut to k rows in every partition before anything is shuffled.
    """
    keys = [F.col(c) for c in key]
    return first_n(df.withColumn("priority", priority(seed, *keys)), by, ["priority", *keys], k).drop("nth", "priority")


def weighted_samples(df: DataFrame, by: list[str], k: int, seed: str, sizes: DataFrame, weight: str, *key: str) -> DataFrame:
    """``bounded_samples`` of rows that stand for ``weight`` equal ones each; that column says how many of them are in the sample.

    ``sizes``: (by, rows), a bounded table. Few rows have priorities below a limit that the size of their group sets; only these are
    ranked. Should fewer than k be among them, by chance, all rows are.
    """
    head = F.substring("priority", 1, 13)
    share = F.least(F.lit(1.0), F.lit(1.2 * k + 500) / F.col("rows"))
    limit = F.when(share >= 1, "g").otherwise(F.lpad(F.lower(F.hex((share * F.lit(float(16**13))).cast("long"))), 13, "0"))
    ranked = df.withColumn("priority", priority(seed, *[F.col(c) for c in key])).join(F.broadcast(sizes.withColumn("__limit", limit)), by)
    low = materialized(ranked.where(head < F.col("__limit")), "low-priorities")
    few = sizes.join(low.groupBy(*by).agg(F.count("*").alias("__n")), by, "left").where(F.coalesce("__n", F.lit(0)) < F.least("rows", F.lit(k)))
    if not few.isEmpty():
        low = ranked
    before = F.coalesce(F.sum(weight).over(Window.partitionBy(*by).orderBy("priority", *key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    low = low.withColumn("__before", before).where(F.col("__before") < k)
    return low.withColumn(weight, F.least(weight, F.lit(k) - F.col("__before"))).drop("priority", "rows", "__limit", "__before")


def evenly_spaced(df: DataFrame, order: list[str], places: int = 3) -> DataFrame:
    """First, evenly spaced and last rows of the order: places i (n - 1) / (places - 1), rounded down."""
    placed = ordered(df, order, "place")
    n = placed.count()
    wanted = sorted({i * (n - 1) // (places - 1) for i in range(places)}) if n else []
    return placed.where(F.col("place").isin(wanted)) if wanted else placed.limit(0)


def draw_pairs(weighted: DataFrame, weight: str, order: list[str], draws: DataFrame, u: str = "u") -> DataFrame:
    """Extension: independent draws with replacement, one row of ``weighted`` per row of ``draws`` (u in [0, 1)).

    Cumulative integer mass by prefix sum, then each uniform meets the row whose mass interval holds it, through range
    buckets. Without mass there is no result: an empty frame, never an invented pair.
    """
    mass = F.round(F.col(weight) * F.lit(1e9)).cast("decimal(38,0)")
    placed = ordered(weighted.where(mass > 0), order, "place", {"mass_before": mass})
    total = placed.agg(F.max(F.col("mass_before") + mass)).first()[0]
    if not total:
        return placed.select(F.lit(None).alias(u), "*").limit(0)
    size = max(1, int(total) // 4096)
    t = F.floor(F.col(u) * F.lit(float(total))).cast("decimal(38,0)")
    bucket = lambda c: F.floor(c / F.lit(size)).cast("long")
    rows = placed.withColumn("mass_end", (F.col("mass_before") + mass).cast("decimal(38,0)"))
    rows = rows.withColumn("bucket", F.explode(F.sequence(bucket(F.col("mass_before")), bucket(F.col("mass_end") - 1))))
    wanted = draws.withColumns({"target": t, "bucket": bucket(t)})
    return wanted.join(rows, "bucket").where("target >= mass_before and target < mass_end").drop("bucket", "target")
