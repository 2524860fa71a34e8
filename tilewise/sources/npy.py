"""Python data source ``npy``: int64 matrices of relations, read by row ranges and written as parts.

A header is read once on the driver; each input partition maps its own row range, so that no task reads the whole file.
The writer makes one valid ``.npy`` file per task, batch by batch, and names them on commit in a folder that must not exist yet;
with overwriting, the old folder goes when the new one is complete.
"""

from __future__ import annotations

import glob
import io
import os
import shutil
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..schema import RELATION

COLUMNS = [f.name for f in RELATION.fields]


@dataclass
class Rows(InputPartition):
    path: str
    start: int
    stop: int


@dataclass
class Part(WriterCommitMessage):
    path: str
    rows: int


class NpyReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.rows = options["path"], int(options.get("rowsPerPartition", 1_000_000))

    def partitions(self):
        out = []
        for path in sorted(glob.glob(os.path.join(self.path, "*.npy"))) if os.path.isdir(self.path) else [self.path]:
            a = np.load(path, mmap_mode="r", allow_pickle=False)
            if a.ndim != 2 or a.shape[1] != len(COLUMNS) or a.dtype != np.dtype("<i8"):
                raise ValueError(f"{path}: expected int64 rows of {len(COLUMNS)} columns, found {a.dtype} {a.shape}")
            out += [Rows(path, lo, min(len(a), lo + self.rows)) for lo in range(0, len(a), self.rows)]
        return out or [Rows(self.path, 0, 0)]

    def read(self, partition):
        if partition.stop > partition.start:
            a = np.load(partition.path, mmap_mode="r", allow_pickle=False)
            for lo in range(partition.start, partition.stop, 65536):
                rows = np.ascontiguousarray(a[lo : min(lo + 65536, partition.stop)].T)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=COLUMNS)


def header(rows: int) -> bytes:
    """The header of a file of so many rows; numpy pads it, so that its length does not depend on their number."""
    out = io.BytesIO()
    np.lib.format.write_array_header_1_0(out, {"descr": "<i8", "fortran_order": False, "shape": (rows, len(COLUMNS))})
    return out.getvalue()


class NpyWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite):
        self.path = options["path"].rstrip("/")
        if os.path.exists(self.path) and not overwrite:
            raise FileExistsError(self.path)
        self.staging = f"{self.path}.staging-{uuid.uuid4().hex}"

    def write(self, iterator):
        from pyspark import TaskContext

        context = TaskContext.get()
        os.makedirs(self.staging, exist_ok=True)
        path = os.path.join(self.staging, f"{context.partitionId():05d}-{context.taskAttemptId()}.npy")
        rows = 0
        with open(path, "wb") as out:
            out.write(header(0))
            for batch in iterator:
                out.write(np.stack([batch.column(c).to_numpy() for c in COLUMNS], axis=1).astype("<i8").tobytes())
                rows += batch.num_rows
            out.seek(0)
            out.write(header(rows))
        return Part(path, rows)

    def commit(self, messages):
        done, old = f"{self.staging}.done", f"{self.staging}.old"
        os.makedirs(done)
        for m in messages:
            if m is not None:
                os.rename(m.path, os.path.join(done, os.path.basename(m.path).split("-")[0] + ".npy"))
        if os.path.exists(self.path):
            os.rename(self.path, old)
        os.rename(done, self.path)
        shutil.rmtree(self.staging, ignore_errors=True)
        shutil.rmtree(old, ignore_errors=True)

    def abort(self, messages):
        shutil.rmtree(self.staging, ignore_errors=True)


class NpyDataSource(DataSource):
    @classmethod
    def name(cls):
        return "npy"

    def schema(self):
        return RELATION

    def reader(self, schema):
        return NpyReader(self.options)

    def writer(self, schema, overwrite):
        return NpyWriter(self.options, overwrite)
