"""Python data source ``numbered_lines``: text lines with their numbers, from plain, gzip or ZIP files.

Files are opened by Arrow's file systems, so that they may lie in any store that these reach by the path's scheme. A ZIP is read by
ranges: its central directory (ZIP64 too) to find the members, then the blocks of one member, whose CRC is checked at its end.

Options: ``path``; ``member`` for ZIP files with more than one file, ``*`` for each member in a partition of its own (``source_file`` then
names both); ``kind``, ``lines`` or ``csv``. Line numbers are
1-based and count blank lines, which are skipped; ``record`` counts the rows kept. With ``csv``, the first row is a
header without repeats, fields are given as a JSON object, and a row of another width is given as null with its number.
A filter ``record <= n`` ends the scan early.
"""

from __future__ import annotations

import contextlib
import csv
import gzip
import io
import json
import os
import zipfile
from dataclasses import dataclass

import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition, LessThan, LessThanOrEqual


def located(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), os.path.abspath(path)
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def files_below(path: str) -> list[str]:
    """The files of a folder at any depth, in order, or the file itself; hidden ones, as of commits, are left out."""
    fs, at = located(path)
    info = fs.get_file_info(at)
    if info.type == pyarrow.fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type != pyarrow.fs.FileType.Directory:
        return [path]
    found = [f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(at, recursive=True)) if f.type == pyarrow.fs.FileType.File and not os.path.basename(f.path).startswith((".", "_"))]
    return [path.rstrip("/") + f[len(at.rstrip("/")) :] for f in sorted(found)]


def opened(path: str):
    """A file that can be read from any place."""
    fs, at = located(path)
    return fs.open_input_file(at)


@dataclass
class Member(InputPartition):
    path: str
    member: str | None


class LinesReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.member, self.kind = options["path"], options.get("member"), options.get("kind", "lines")
        self.last = None

    def pushFilters(self, filters):
        for f in filters:
            bound = f.value if isinstance(f, (LessThanOrEqual, EqualTo)) else f.value - 1 if isinstance(f, LessThan) else None
            if bound is not None and f.attribute == ("record",):
                self.last = bound if self.last is None else min(self.last, bound)
            yield f  # Spark still tests every row

    def partitions(self):
        out = []
        for p in files_below(self.path):
            with opened(p) as f:
                if f.read(4)[:2] != b"PK" or not zipfile.is_zipfile(f):
                    out.append(Member(p, None))
                    continue
                with zipfile.ZipFile(f) as archive:
                    names = [i.filename for i in archive.infolist() if not i.is_dir()]
            if self.member and self.member != "*":
                names = [n for n in names if n == self.member]
            if len(names) != 1 and self.member != "*":
                raise ValueError(f"{p}: name one member, found {len(names)}")
            out += [Member(p, n) for n in names]
        return out

    def read(self, partition):
        name = os.path.basename(partition.path)
        if self.member == "*" and partition.member:
            name = f"{name}/{partition.member}"
        with contextlib.ExitStack() as stack:
            raw = stack.enter_context(opened(partition.path))
            if partition.member:
                raw = stack.enter_context(stack.enter_context(zipfile.ZipFile(raw)).open(partition.member))
            elif partition.path.endswith(".gz"):
                raw = stack.enter_context(gzip.GzipFile(fileobj=raw))
            f = stack.enter_context(io.TextIOWrapper(raw, encoding="utf-8-sig", newline=""))
            for record, (line, value) in enumerate(self._csv(f) if self.kind == "csv" else self._lines(f), 1):
                if self.last is not None and record > self.last:
                    return
                yield name, record, line, value

    @staticmethod
    def _lines(f):
        for n, line in enumerate(f, 1):
            line = line.rstrip("\r\n")
            if line.strip():
                yield n, line

    @staticmethod
    def _csv(f):
        rows = csv.reader(f, strict=True)
        header = next(rows, None)
        if not header or len(set(header)) != len(header):
            raise ValueError("a CSV file needs a header without repeated names")
        for row in rows:
            if row:
                yield rows.line_num, json.dumps(dict(zip(header, row, strict=True)), ensure_ascii=False) if len(row) == len(header) else None


class NumberedLines(DataSource):
    @classmethod
    def name(cls):
        return "numbered_lines"

    def schema(self):
        return "source_file string, record long, line long, value string"

    def reader(self, schema):
        return LinesReader(self.options)


def register(spark) -> None:
    from .npy import NpyDataSource

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(NumberedLines)
    spark.dataSource.register(NpyDataSource)
