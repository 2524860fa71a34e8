"""Geometry texts: WKT and GeoJSON read by recursive descent, with the place and cause of the first error.

A polygon text gives its parts (rings of (x, y)); other types are read to their end and give none. Further ordinates (Z, M) are
read and dropped. A ring must be closed and have no points or at least four; a text must end where its geometry ends.
``parse_geometry`` is the Arrow UDF over a column of texts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Ring = list[tuple[float, float]]
Parts = list[list[Ring]]

MOST_DETAIL = 200
POLYGONS = ("POLYGON", "MULTIPOLYGON")
_TOKEN = re.compile(r"\s*(?:([A-Za-z]+)|([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)|([+-]?(?:nan|inf(?:inity)?)\b)|([(),]))", re.I | re.A)
#: How deep the lists of points of a type are nested; a collection holds geometries.
_DEPTH = {"POINT": 0, "LINESTRING": 1, "LINEARRING": 1, "MULTIPOINT": 1, "POLYGON": 2, "MULTILINESTRING": 2, "MULTIPOLYGON": 3}
_GEOJSON = {"Point": 0, "LineString": 1, "MultiPoint": 1, "Polygon": 2, "MultiLineString": 2, "MultiPolygon": 3}


class TextError(ValueError):
    """What is wrong with a text, and where."""


def check_ring(ring: Ring, where: str) -> None:
    if ring and len(ring) < 4:
        raise TextError(f"a ring of {len(ring)} points {where}")
    if ring and ring[0] != ring[-1] and not any(v != v for p in (ring[0], ring[-1]) for v in p):
        raise TextError(f"a ring that is not closed {where}")


class _Wkt:
    def __init__(self, text: str):
        self.text, self.at, self.kind, self.value = text, 0, "", ""
        self.step()

    def step(self) -> None:
        """Move to the next token: a word, a number, a sign, or the end."""
        found = _TOKEN.match(self.text, self.at)
        if found:
            special = found[3] or (found[1] if found[1] and re.fullmatch("nan|inf(inity)?", found[1], re.I) else None)
            self.place, self.at = found.end() - len(found[0].lstrip()), found.end()
            self.value = found[0].strip()
            self.kind = "number" if found[2] or special else "word" if found[1] else self.value
            return
        rest = self.text[self.at :]
        self.place = self.at + len(rest) - len(rest.lstrip())
        self.at, self.value = self.place, rest.strip()[:1]
        self.kind = "unknown" if self.value else "end"

    def fail(self, wanted: str) -> TextError:
        seen = "the end" if self.kind == "end" else repr(self.value[:40])
        return TextError(f"{wanted} expected but {seen} found at character {self.place + 1}")

    def take(self, kind: str, wanted: str) -> str:
        if self.kind != kind:
            raise self.fail(wanted)
        value = self.value
        self.step()
        return value

    def point(self) -> tuple[float, float]:
        x = float(self.take("number", "a number"))
        y = float(self.take("number", "a number"))
        for _ in range(2):
            if self.kind == "number":
                self.step()
        return x, y

    def listed(self, item: Callable[[], object]) -> list:
        """( item, item ... ) or EMPTY."""
        if self.kind == "word" and self.value.upper() == "EMPTY":
            self.step()
            return []
        self.take("(", "'(' or EMPTY")
        out = [item()]
        while self.kind == ",":
            self.step()
            out.append(item())
        self.take(")", "',' or ')'")
        return out

    def nested(self, depth: int, rings: bool) -> list:
        if depth == 1:
            began = self.place
            # Points of a MULTIPOINT may stand in parentheses of their own.
            out = self.listed(lambda: self.listed(self.point)[0] if self.kind == "(" else self.point())
            if rings:
                check_ring(out, f"at character {began + 1}")
            return out
        return self.listed(lambda: self.nested(depth - 1, rings))

    def geometry(self) -> tuple[str, list]:
        name = self.take("word", "a geometry type").upper()
        if name not in _DEPTH and name != "GEOMETRYCOLLECTION":
            raise TextError(f"unknown geometry type {name[:40]}")
        if self.kind == "word" and self.value.upper() in ("Z", "M", "ZM"):
            self.step()
        if name == "GEOMETRYCOLLECTION":
            return name, self.listed(self.geometry)
        depth = _DEPTH[name]
        return name, self.listed(self.point) if depth == 0 else self.nested(depth, name in POLYGONS or name == "LINEARRING")


def read_wkt(text: str) -> tuple[str, list]:
    """(type, nested lists of points) of a WKT text."""
    reader = _Wkt(text)
    out = reader.geometry()
    if reader.kind != "end":
        raise reader.fail("the end")
    return out


def _positions(value: object, depth: int, rings: bool, path: str) -> list:
    if not isinstance(value, list):
        raise TextError(f"a list expected at {path}")
    if depth == 0:
        if len(value) < 2 or any(isinstance(v, bool) or not isinstance(v, (int, float)) for v in value):
            raise TextError(f"a position of numbers expected at {path}")
        return (float(value[0]), float(value[1]))
    out = [_positions(v, depth - 1, rings, f"{path}[{i}]") for i, v in enumerate(value)]
    if depth == 1 and rings:
        check_ring(out, f"at {path}")
    return out


def _no_constant(name: str) -> float:
    raise ValueError(f"Nonfinite JSON number: {name}")


def read_geojson(text: str) -> tuple[str, list, str, str]:
    """(type, nested lists of points, id, properties) of a GeoJSON geometry or feature; a text that is no record raises ValueError."""
    try:
        record = json.loads(text, parse_constant=_no_constant)
    except RecursionError as e:
        raise ValueError("a record nested too deeply") from e
    if not isinstance(record, dict):
        raise ValueError("GeoJSON record is not an object")
    feature = record.get("type") == "Feature"
    shape, path = (record.get("geometry"), "geometry") if feature else (record, "record")
    if not isinstance(shape, dict):
        raise TextError(f"an object expected at {path}")
    name = str(shape.get("type"))
    properties = json.dumps(record.get("properties") or {}, ensure_ascii=False, sort_keys=True, separators=(",", ":")) if feature else "{}"
    own_id = str(record.get("id", "")) if feature else ""
    if name == "GeometryCollection":
        return name.upper(), [], own_id, properties
    if name not in _GEOJSON:
        raise TextError(f"unknown geometry type {name[:40]}")
    rings = name.endswith("Polygon")
    positions = shape.get("coordinates")
    found = [] if positions == [] else _positions(positions, _GEOJSON[name], rings, "coordinates")
    return name.upper(), found, own_id, properties


def read(text: str, form: str) -> dict:
    """kind, parts, empty, record_error, geometry_error, own_id, properties of one text."""
    out = dict.fromkeys(("kind", "parts", "empty", "record_error", "geometry_error", "own_id", "properties"))
    try:
        if form == "geojson":
            out["kind"], found, out["own_id"], out["properties"] = read_geojson(text)
        else:
            out["kind"], found = read_wkt(text)
        if out["kind"] in POLYGONS:
            parts = [found] if out["kind"] == "POLYGON" else found
            parts = [[ring for ring in part if ring] for part in parts if part and part[0]]
            out["parts"], out["empty"] = parts, not parts
        else:
            out["empty"] = not found
    except TextError as e:
        out["geometry_error"] = str(e)[:MOST_DETAIL]
    except (ValueError, OverflowError, RecursionError) as e:
        out["record_error" if form == "geojson" else "geometry_error"] = str(e)[:MOST_DETAIL]
    return out


_POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("parts", T.ArrayType(T.ArrayType(T.ArrayType(_POINT)))),
        T.StructField("empty", T.BooleanType()),
        T.StructField("record_error", T.StringType()),
        T.StructField("geometry_error", T.StringType()),
        T.StructField("own_id", T.StringType()),
        T.StructField("properties", T.StringType()),
    ]
)
POINT_ARROW = pa.struct([("x", pa.float64()), ("y", pa.float64())])
PARTS_ARROW = pa.list_(pa.list_(pa.list_(POINT_ARROW)))


def nested_array(shapes: list[Parts | None]) -> pa.Array:
    """Parts as an Arrow array, built from offsets."""
    parts_at, rings_at, points_at, xs, ys, mask = [0], [0], [0], [], [], []
    for parts in shapes:
        mask.append(parts is None)
        for part in parts or ():
            for ring in part:
                xs += [p[0] for p in ring]
                ys += [p[1] for p in ring]
                points_at.append(len(xs))
            rings_at.append(len(points_at) - 1)
        parts_at.append(len(rings_at) - 1)
    points = pa.StructArray.from_arrays([pa.array(xs, pa.float64()), pa.array(ys, pa.float64())], fields=list(POINT_ARROW))
    rings = pa.ListArray.from_arrays(pa.array(points_at, pa.int32()), points)
    parts = pa.ListArray.from_arrays(pa.array(rings_at, pa.int32()), rings)
    return pa.ListArray.from_arrays(pa.array(parts_at, pa.int32()), parts, mask=pa.array(mask, pa.bool_()) if mask else None)


@F.arrow_udf(_SCHEMA)
def _parsed(texts: pa.Array, forms: pa.Array) -> pa.Array:
    rows = [dict.fromkeys(_SCHEMA.names) if t is None or f is None else read(t, f) for t, f in zip(texts.to_pylist(), forms.to_pylist(), strict=True)]
    columns = [nested_array([r["parts"] for r in rows]) if n == "parts" else pa.array([r[n] for r in rows], pa.bool_() if n == "empty" else pa.string()) for n in _SCHEMA.names]
    return pa.StructArray.from_arrays(columns, names=_SCHEMA.names)


def parse_geometry(text: Column, form: Column | str) -> Column:
    """struct(kind, parts, empty, record_error, geometry_error, own_id, properties); ``form`` is 'wkt' or 'geojson'.

    A null text gives a struct of nulls. Errors are at most ``MOST_DETAIL`` characters long.
    """
    return _parsed(text, F.lit(form) if isinstance(form, str) else form)
