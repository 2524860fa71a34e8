"""Pairing, coverage and reconciliation: what matches, what is missing on either side, what disagrees."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coverage(a: DataFrame, b: DataFrame, key: str, agree: list[str]) -> DataFrame:
    """One row per key of either side: ``status`` matched, disagreeing, missing_in_b or missing_in_a."""
    left = a.select(F.col(key).alias("__a"), *[F.col(c).alias(f"a_{c}") for c in agree])
    right = b.select(F.col(key).alias("__b"), *[F.col(c).alias(f"b_{c}") for c in agree])
    same = reduce(Column.__and__, [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in agree], F.lit(True))
    status = F.when(F.col("__b").isNull(), "missing_in_b").when(F.col("__a").isNull(), "missing_in_a").when(same, "matched").otherwise("disagreeing")
    return left.join(right, F.col("__a") == F.col("__b"), "full_outer").select(F.coalesce("__a", "__b").alias(key), status.alias("status"))


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``children`` whose key has no parent; must be empty for a sound source."""
    return children.join(parents.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def selected(rows: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    return rows.join(chosen.select(key), key, "left_semi")


def completeness(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(problem, n): keys that are unexpected, missing or repeated in ``actual``; each problem has a row."""
    counts = actual.groupBy(key).agg(F.count("*").alias("n"))
    joined = expected.select(key, F.lit(1).alias("__e")).distinct().join(counts, key, "full_outer")
    sums = joined.agg(
        F.count_if(F.col("n").isNull()).alias("missing"),
        F.count_if(F.col("__e").isNull()).alias("unexpected"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    )
    return sums.select(F.expr("stack(3, 'missing', missing, 'unexpected', unexpected, 'repeated', repeated) AS (problem, n)"))


def layers(rows: DataFrame, key: list[str], layer: str) -> DataFrame:
    """Per physical key, the counts of layers 0 and 1: ``paired`` has one of each; ``ambiguous`` more than one of either."""
    n0, n1 = F.count_if(F.col(layer) == 0), F.count_if(F.col(layer) == 1)
    out = rows.groupBy(*key).agg(n0.alias("layer_0"), n1.alias("layer_1"))
    status = F.when((F.col("layer_0") > 1) | (F.col("layer_1") > 1), "ambiguous").when((F.col("layer_0") == 1) & (F.col("layer_1") == 1), "paired").when(F.col("layer_0") == 1, "only_0").when(F.col("layer_1") == 1, "only_1").otherwise("neither")
    return out.withColumn("status", status)


def reconcile(expected: DataFrame, actual: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """(outcome, n) over a full outer join on the identity: equal, missing, unexpected, differs.<column>."""
    left = expected.select(*[F.col(c).alias(f"__e_{c}") for c in key + columns], F.lit(True).alias("__e"))
    right = actual.select(*[F.col(c).alias(f"__a_{c}") for c in key + columns], F.lit(True).alias("__a"))
    on = reduce(Column.__and__, [F.col(f"__e_{c}").eqNullSafe(F.col(f"__a_{c}")) for c in key])
    joined = left.join(right, on, "full_outer")
    differ = [F.when(~F.col(f"__e_{c}").eqNullSafe(F.col(f"__a_{c}")), F.lit(f"differs.{c}")) for c in columns]
    both = F.array_compact(F.array(*differ)) if differ else F.array().cast("array<string>")
    outcome = F.when(F.col("__a").isNull(), F.array(F.lit("missing"))).when(F.col("__e").isNull(), F.array(F.lit("unexpected"))).when(F.size(both) == 0, F.array(F.lit("equal"))).otherwise(both)
    return joined.select(F.explode(outcome).alias("outcome")).groupBy("outcome").agg(F.count("*").alias("n"))


def consistent_duplicates(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per repeated key: entries, and whether all agree on ``columns``."""
    return rows.groupBy(key).agg(F.count("*").alias("entries"), F.count_distinct(F.struct(*columns)).alias("versions")).where("entries > 1").withColumn("consistent", F.col("versions") == 1)


def multiset_intersection(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how many rows the two sides share, counting repeats on both."""
    counts = lambda d, n: d.groupBy(*columns).agg(F.count("*").alias(n))
    return counts(a, "n_a").join(counts(b, "n_b"), columns).agg(F.coalesce(F.sum(F.least("n_a", "n_b")), F.lit(0)).cast("long").alias("shared"))
