"""Keep/reject routing: every record is retained or counted under one reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cascade(*rules: tuple[Column, str]) -> Column:
    """The reason of the first rule that holds, or null. A condition that is null does not hold."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for condition, reason in rules:
        out = out.when(F.coalesce(condition, F.lit(False)), F.lit(reason))
    return out


def split_by_reason(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(reason).isNull()), df.where(F.col(reason).isNotNull())


def ledger(df: DataFrame, side: str = "side", reason: str = "reason", flags: dict[str, Column] | None = None, early: tuple[str, ...] = ()) -> DataFrame:
    """(side, key, n): raw, geometry_candidates, retained, excluded.<reason>, and every flag among the retained.

    ``early``: reasons that are decided before the geometry is looked at.
    """
    counted = df.groupBy(side, reason).agg(F.count("*").alias("n"), *[F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).alias(f"flag.{k}") for k, c in (flags or {}).items()])
    r = F.col(reason)
    retained = r.isNull()
    entries = [
        F.struct(F.lit("raw").alias("key"), F.col("n").alias("n")),
        F.struct(F.lit("geometry_candidates").alias("key"), F.when(retained | ~r.isin(*early) if early else F.lit(True), F.col("n")).alias("n")),
        F.struct(F.lit("retained").alias("key"), F.when(retained, F.col("n")).otherwise(0).alias("n")),
        F.struct(F.concat(F.lit("excluded."), r).alias("key"), F.col("n").alias("n")),
        *[F.struct(F.lit(k).alias("key"), F.when(retained, F.col(f"`flag.{k}`")).otherwise(0).alias("n")) for k in (flags or {})],
    ]
    rows = counted.select(side, F.explode(F.array(*entries)).alias("e")).where("e.key is not null")
    return rows.groupBy(side, F.col("e.key").alias("key")).agg(F.coalesce(F.sum("e.n"), F.lit(0)).cast("long").alias("n"))
