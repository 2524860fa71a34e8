"""Selection of model outputs: top-k over flattened scores, thresholds, and audits of exported choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantize import sigmoid


def flattened(df: DataFrame, key: str, logits: str, labels: int) -> DataFrame:
    """One row per candidate: key, idx, query, label, logit, score."""
    rows = df.select(key, F.posexplode(logits).alias("idx", "v")).withColumn("logit", F.col("v").cast("double"))
    return rows.select(key, "idx", F.floor(F.col("idx") / labels).cast("int").alias("query"), (F.col("idx") % labels).cast("int").alias("label"), "logit", sigmoid(F.col("logit")).alias("score"))


def top_k(candidates: DataFrame, key: str, k: int, by: str = "logit") -> DataFrame:
    """The k best per key, ties to the lower index; non-finite values last. Adds the 0-based ``rank``."""
    finite = ~F.isnan(by) & (F.abs(by) != float("inf"))
    order = Window.partitionBy(key).orderBy(F.when(finite, 0).otherwise(1), F.desc(by), "idx")
    return candidates.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < k)


def partition_reason(score: Column, label: Column, threshold: float, background: int = 0) -> Column:
    """Mutually exclusive, in this order: nonfinite, at or under the threshold, background; null if exported.

    The non-finite test comes first: Spark takes NaN for greater than any threshold.
    """
    return F.when(F.isnan(score) | (F.abs(score) == float("inf")), "nonfinite_score").when(score <= threshold, "threshold").when(label == background, "background")


def boundary_ties(candidates: DataFrame, key: str, k: int, by: str = "logit") -> DataFrame:
    """Per key: the k-th best value, how many are above it, how many equal it, and whether that choice is free."""
    nth = Window.partitionBy(key).orderBy(F.desc(by), "idx")
    kth = candidates.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") == k).select(key, F.col(by).alias("boundary"))
    counts = candidates.join(kth, key).groupBy(key, "boundary").agg(F.count_if(F.col(by) > F.col("boundary")).alias("above"), F.count_if(F.col(by) == F.col("boundary")).alias("equal"))
    return counts.withColumn("ambiguous", F.col("above") + F.col("equal") > k)


def rank_violations(exported: DataFrame, key: str) -> DataFrame:
    """Per key, over exported predictions by rank: rank gaps back, rising scores, repeated (query, label)."""
    w = Window.partitionBy(key).orderBy("rank", "query", "label")
    rows = exported.withColumns({"before_rank": F.lag("rank").over(w), "before_score": F.lag("score").over(w)})
    return rows.groupBy(key).agg(
        F.count("*").alias("predictions"),
        F.count_if(F.col("rank") <= F.col("before_rank")).alias("rank_not_increasing"),
        F.count_if(F.col("score") > F.col("before_score")).alias("score_increasing"),
        (F.count("*") - F.count_distinct("query", "label")).alias("repeated_pairs"),
    )


def accounting(chosen: DataFrame, key: str, k: int) -> DataFrame:
    """Per key, exported and excluded counts, and whether they add up to k."""
    n = lambda r: F.count_if(F.col("reason") == r)
    out = chosen.groupBy(key).agg(n("nonfinite_score").alias("nonfinite"), n("threshold").alias("threshold"), n("background").alias("background"), F.count_if(F.col("reason").isNull()).alias("exported"))
    return out.withColumn("balanced", F.col("nonfinite") + F.col("threshold") + F.col("background") + F.col("exported") == k)


def match_scores(raw: DataFrame, exported: DataFrame, keys: list[str], score: str, tolerance: float) -> DataFrame:
    """(outcome, n): exported rows against the raw candidates with their keys: matched, differs, missing, unexpected.

    Scores match within ``tolerance``; two that are not numbers match, one alone does not.
    """
    a, b = raw.select(*keys, F.col(score).alias("__a"), F.lit(1).alias("__in_a")), exported.select(*keys, F.col(score).alias("__b"), F.lit(1).alias("__in_b"))
    near = (F.isnan("__a") & F.isnan("__b")) | (F.abs(F.col("__a") - F.col("__b")) <= tolerance)
    outcome = F.when(F.col("__in_b").isNull(), "missing").when(F.col("__in_a").isNull(), "unexpected").when(F.coalesce(near, F.lit(False)), "matched").otherwise("differs")
    return a.join(b, keys, "full_outer").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def float_spacing(value: Column) -> Column:
    """Distance from a float32 value to the next one away from zero."""
    size = F.abs(value.cast("float").cast("double"))
    power = F.floor(F.log2(F.greatest(size, F.lit(2.0**-126))))
    # The logarithm may be off by one next to a power of two.
    power = power + F.when(F.pow(F.lit(2.0), power + 1) <= size, 1).when((F.pow(F.lit(2.0), power) > size) & (size > 0), -1).otherwise(0)
    return F.pow(F.lit(2.0), F.greatest(power, F.lit(-126)) - 23)


def tie_aware(raw: DataFrame, key: str, k: int, threshold: float, tolerance: float, background: int = 0, score: str = "score") -> DataFrame:
    """The candidates of a key with what an export may make of them, whatever the order of ties and small errors of scores.

    ``lo`` and ``hi``: the ranks that the score allows (by range frames over the key's scores); ``mandatory`` is above the k-th
    score, ``boundary`` equal to it, ``slots`` how many of the latter are chosen; ``retained`` passes threshold and background.
    Scores that are not finite rank first, as nothing orders them, and are never retained.
    """
    finite = ~F.isnan(score) & (F.abs(score) != float("inf"))
    rows = raw.withColumn("__s", F.when(finite, F.col(score).cast("double")).otherwise(F.lit(float("inf"))))
    frame = "OVER (PARTITION BY `{0}` ORDER BY __s RANGE BETWEEN {1} AND {2})"
    all_, upto, from_ = (f"count(1) {frame.format(key, lo, hi)}" for lo, hi in (("UNBOUNDED PRECEDING", "UNBOUNDED FOLLOWING"), ("UNBOUNDED PRECEDING", f"{tolerance!r}D FOLLOWING"), (f"{tolerance!r}D PRECEDING", "UNBOUNDED FOLLOWING")))
    nth = Window.partitionBy(key).orderBy(F.desc("__s"))
    whole = Window.partitionBy(key)
    rows = rows.withColumns({"lo": F.expr(f"{all_} - {upto}"), "hi": F.least(F.lit(k - 1).cast("long"), F.expr(f"{from_} - 1")), "__n": F.row_number().over(nth)})
    rows = rows.withColumn("__cut", F.coalesce(F.max(F.when(F.col("__n") == k, F.col("__s"))).over(whole), F.min("__s").over(whole)))
    retained = finite & (F.col(score) > threshold) & (F.col("label") != background)
    rows = rows.withColumns({"mandatory": F.col("__s") > F.col("__cut"), "boundary": F.col("__s") == F.col("__cut"), "retained": retained})
    return rows.withColumn("slots", F.lit(k) - F.count_if("mandatory").over(whole)).drop("__s", "__n", "__cut")


def export_checks(raw: DataFrame, exported: DataFrame, key: str, k: int, threshold: float, tolerance: float, coordinates: tuple[str, ...] = (), background: int = 0) -> DataFrame:
    """(check_code, checked, failed) of exported rows (key, query, label, rank, score, coordinates) against raw candidates.

    Any choice among candidates that tie for the last places, any order of ties, and scores and coordinates within their
    float32 errors pass. Duplicates are counted but for one of each.
    """
    ids = [key, "query", "label"]
    known = tie_aware(raw, key, k, threshold, tolerance, background).select(*ids, F.col("score").alias("__score"), "lo", "hi", "mandatory", "boundary", "retained", "slots", *[F.col(c).alias(f"__{c}") for c in coordinates], F.lit(True).alias("__raw"))
    sent = exported.select(*ids, "rank", "score", *coordinates, F.lit(True).alias("__sent"))
    both = known.join(sent, ids, "full_outer").withColumns({"__raw": F.coalesce("__raw", F.lit(False)), "__sent": F.coalesce("__sent", F.lit(False))})
    found, met = F.col("__sent"), F.col("__raw") & F.col("__sent")
    number = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    near = lambda c: number(c) & (F.abs(F.col(c).cast("double") - F.col(f"__{c}").cast("double")) <= F.greatest(F.lit(1e-6), 4 * float_spacing(F.col(f"__{c}"))))
    per_row = {
        "known_candidate": (found, F.col("__raw")),
        "allowed_candidate": (met, F.col("retained") & (F.col("mandatory") | F.col("boundary"))),
        "rank_in_interval": (met, (F.col("rank") >= F.col("lo")) & (F.col("rank") <= F.col("hi"))),
        "score": (met, number("score") & (F.abs(F.col("score") - F.col("__score")) <= tolerance)),
        "filter": (met, (F.col("score") > threshold) & (F.col("label") != background)),
        "mandatory_exported": (F.col("mandatory") & F.col("retained"), found),
    } | {f"coordinate_{c}": (met, near(c)) for c in coordinates}
    tally = [f(F.coalesce(when, F.lit(False)) & extra).alias(f"{n}__{i}") for n, (when, ok) in per_row.items() for i, (f, extra) in enumerate(((F.count_if, F.lit(True)), (F.count_if, ~F.coalesce(ok, F.lit(False)))))]
    own = both.groupBy(key).agg(
        *tally,
        F.count_if(found).alias("unique_candidate__0"),
        (F.count_if(found) - F.count_distinct(F.when(found, F.struct("query", "label")))).alias("unique_candidate__1"),
        F.count_if(found).alias("unique_rank__0"),
        (F.count_if(found) - F.count_distinct(F.when(found, F.col("rank")))).alias("unique_rank__1"),
        F.lit(1).cast("long").alias("free_choice__0"),
        (F.count_if(met & F.col("boundary")) > F.coalesce(F.max("slots"), F.lit(0))).cast("long").alias("free_choice__1"),
    )
    names = [*per_row, "unique_candidate", "unique_rank", "free_choice"]
    total = own.agg(*[F.coalesce(F.sum(f"{n}__{i}"), F.lit(0)).alias(f"{n}__{i}") for n in names for i in (0, 1)])
    return total.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_code"), F.col(f"{n}__0").alias("checked"), F.col(f"{n}__1").alias("failed")) for n in names])))
