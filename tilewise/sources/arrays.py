"""Sinks whose bytes do not depend on how Spark parts the rows: one array file, one compressed ledger.

Both write at final places in one staged file, which all executors see, and rename it when it is complete: a task that
is run again writes the same bytes at the same places. A file that is there already is not replaced.
"""

from __future__ import annotations

import io
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import ordered
from ..schema import RELATION
from ..scratch import materialized

#: Lines of a member of a ledger, and its level of compression.
MEMBER_LINES, LEVEL = 10_000, 3
#: Header of a gzip member without name, time or system (RFC 1952).
_GZIP = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff"


def _staged(path: str) -> str:
    if os.path.exists(path):
        raise FileExistsError(path)
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    return f"{path}.staging-{uuid.uuid4().hex}"


def array_header(rows: int, columns: int) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array_header_1_0(out, {"descr": "<i8", "fortran_order": False, "shape": (rows, columns)})
    return out.getvalue()


def write_array(df: DataFrame, path: str, place: str = "record_id") -> int:
    """One ``.npy`` of int64 rows, each at the row given by ``place``: 0 to n - 1, each once; returns n.

    Rows may come in any order from any partition and stream through the tasks. The header comes last; places that are missing
    or taken twice raise, and nothing is left.
    """
    names = [f.name for f in RELATION.fields]
    n = df.count()
    head, width, staging = array_header(n, len(names)), 8 * len(names), _staged(path)
    with open(staging, "wb") as out:
        out.truncate(len(head) + n * width)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(staging, "r+b", buffering=0) as out:
            for batch in batches:
                at = batch.column("__at").to_numpy()
                rows = np.stack([batch.column(c).to_numpy() for c in names], axis=1).astype("<i8")
                if len(at) and (at.min() < 0 or at.max() >= n):
                    raise ValueError("a place is outside the array")
                order = np.argsort(at, kind="stable")
                at, rows = at[order], rows[order]
                for run in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) != 1) + 1):
                    if len(run):
                        out.seek(len(head) + int(at[run[0]]) * width)
                        out.write(rows[run].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(at)], ["at"])
            os.fsync(out.fileno())

    try:
        taken = df.select(F.col(place).alias("__at"), *names).mapInArrow(put, "at long")
        # Every place once: as many different ones as rows, counted in blocks.
        wrong = taken.groupBy((F.col("at") / 65536).cast("long").alias("block")).agg(F.count("*").alias("n"), F.count_distinct("at").alias("d")).agg(F.sum("n").alias("n"), F.sum("d").alias("d")).first()
        if (wrong.n or 0, wrong.d or 0) != (n, n):
            raise ValueError("the places are not each of 0 to n - 1 once")
        with open(staging, "r+b") as out:
            out.write(head)
            os.fsync(out.fileno())
        os.rename(staging, path)
    finally:
        if os.path.exists(staging):
            os.remove(staging)
    return n


def same_bytes(spark: SparkSession, one: str, two: str, piece: int = 32 << 20) -> bool:
    """Whether two files, which all executors see, have the same bytes; they are compared piece by piece, a piece a task at a time."""
    size = os.path.getsize(one)
    if size != os.path.getsize(two):
        return False

    def differing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(one, "rb") as a, open(two, "rb") as b:
            for batch in batches:
                for k in batch.column("id").to_pylist():
                    a.seek(k * piece)
                    b.seek(k * piece)
                    if a.read(piece) != b.read(piece):
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64())], ["id"])

    pieces = -(-size // piece)
    return spark.range(pieces, numPartitions=max(1, min(pieces, 10_000))).mapInArrow(differing, "id long").isEmpty()


def member(lines: list[str]) -> bytes:
    """Lines as one gzip member whose bytes depend on nothing else."""
    raw = "".join(f"{line}\n" for line in lines).encode()
    packed = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    return _GZIP + packed.compress(raw) + packed.flush() + zlib.crc32(raw).to_bytes(4, "little") + (len(raw) & 0xFFFFFFFF).to_bytes(4, "little")


def write_ledger(df: DataFrame, path: str, order: list[str], member_lines: int = MEMBER_LINES) -> int:
    """Rows as canonical JSON lines (keys sorted, no nulls) in one gzip file, in the given order; returns the lines.

    The file is cut into members of ``member_lines`` lines of the whole order, so that its bytes depend on the rows alone. Rows that tie in
    ``order`` are put in order of their lines.
    """
    line = F.to_json(F.struct(*sorted(df.columns))).alias("line")
    rows = ordered(df.select(*[F.col(c).alias(f"__by{i}") for i, c in enumerate(order)], line), [*[f"__by{i}" for i in range(len(order))], "line"])

    def pack(some: pa.Table) -> pa.Table:
        some = some.sort_by("position")
        body = member(some["line"].to_pylist())
        return pa.table({"member": some["member"][:1], "size": pa.array([len(body)], pa.int64()), "lines": pa.array([some.num_rows], pa.int64()), "body": pa.array([body], pa.binary())})

    numbered = rows.select((F.col("position") / member_lines).cast("long").alias("member"), "position", "line")
    members = materialized(numbered.groupBy("member").applyInArrow(pack, "member long, size long, lines long, body binary"), "members")
    # One row a member goes through the window; bodies do not.
    before = F.coalesce(F.sum("size").over(Window.orderBy("member").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = members.select("member", before.alias("at"))
    total = members.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.coalesce(F.sum("lines"), F.lit(0)).alias("lines")).first()
    staging = _staged(path)
    with open(staging, "wb") as out:
        out.truncate(total.size)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(staging, "r+b", buffering=0) as out:
            for batch in batches:
                for at, body in zip(batch.column("at").to_pylist(), batch.column("body"), strict=True):
                    out.seek(at)
                    out.write(body.as_buffer())
                yield batch.select(["member"])
            os.fsync(out.fileno())

    try:
        if members.join(places, "member").select("member", "at", "body").mapInArrow(put, "member long").count() != members.count():
            raise ValueError("a member was not written")
        os.rename(staging, path)
    finally:
        if os.path.exists(staging):
            os.remove(staging)
    return total.lines
