"""Global numbering and prefix sums without a single-task window.

Rows are range-partitioned, sorted by a total order and written once. They are numbered, and summed up, in the same
sorted stream that is written; the partitions' totals, one row for each, are summed in order and joined back by
broadcast. No row is shuffled a second time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialized

_LOCAL = (1 << 33) - 1  # bits of monotonically_increasing_id that number a partition's rows


def _sums_before(names: list[str]):
    """Each named column becomes the sum of the rows before it in the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = [0] * len(names)
        for batch in batches:
            for i, name in enumerate(names):
                at = batch.schema.get_field_index(name)
                own = pc.fill_null(batch.column(at), 0)
                upto = np.add(np.asarray(pc.cumulative_sum_checked(own)), carry[i])
                batch = batch.set_column(at, name, pa.array(upto - np.asarray(own), pa.int64()))
                carry[i] = int(upto[-1]) if len(upto) else carry[i]
            yield batch

    return run


#: Rows of a task where the number of rows is known beforehand.
TASK_ROWS = 1_000_000


def tasks_for(df: DataFrame, rows: int) -> int | None:
    """How many tasks so many rows ask for, or None where the session's number of shuffle partitions is enough."""
    own = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-rows // TASK_ROWS)
    return wanted if wanted > own else None


def ordered(df: DataFrame, by: list[str | Column], position: str = "position", sums: dict[str, Column] | None = None, tasks: int | None = None) -> DataFrame:
    """Adds the 0-based ``position`` in the order ``by`` and, by name, the sum of each long column over all rows before.

    ``tasks``: into how many ranges the rows are cut, if not into the session's number of shuffle partitions.
    """
    sums = sums or {}
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    part = "__part"
    rows = df.withColumns({f"__{n}": F.coalesce(c, F.lit(0)).cast("long") for n, c in sums.items()})
    rows = rows.withColumns({n: F.col(f"__{n}") for n in sums})
    rows = rows.repartitionByRange(*([tasks] if tasks else []), *keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id())
    if sums:
        rows = rows.mapInArrow(_sums_before(list(sums)), rows.schema)
    rows = materialized(rows, "ordered").withColumns({part: F.shiftright("__id", 33).cast("int"), position: F.col("__id").bitwiseAND(_LOCAL)}).drop("__id")
    totals = rows.groupBy(part).agg(F.count("*").alias("__n"), *[F.sum(f"__{n}").alias(f"__{n}") for n in sums])
    # One row per range partition, whatever the size of the data.
    parts = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(part, *[F.coalesce(F.sum(c).over(parts), F.lit(0)).cast("long").alias(f"__before{c}") for c in totals.columns if c != part])
    out = rows.drop(*[f"__{n}" for n in sums]).join(F.broadcast(offsets), part)
    return out.withColumns({position: F.col(position) + F.col("__before__n")} | {n: F.col(n) + F.col(f"__before__{n}") for n in sums}).drop(part, *[f"__before__{n}" for n in ("n", *sums)])
