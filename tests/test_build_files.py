"""Readers of a build's files, and differences of documents, on small files with planted faults."""

import json
import zipfile

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tilewise.operators import audit
from tilewise.sources import files


def test_sequence_files(spark, tmp_path):
    folder = tmp_path / "s"
    folder.mkdir()
    (folder / "a.ini").write_bytes(b"; x=1\r\n[Sequence]\r\nNAME = a: b \r\nseqLength:5\r\n imWidth=3\r\nimHeight = 4\r\n\r\n[Other]\r\nseqLength=9\r\n")
    (folder / "b.ini").write_text("[Sequence]\nseqLength=6\nimWidth=7\nimHeight=8\n[Empty]\n")
    got = files.sequence_info(spark, str(folder)).orderBy("frames").collect()
    assert [tuple(r) for r in got] == [("a: b", 5, 3, 4), ("", 6, 7, 8)]
    entries = {(r.path.rsplit("/", 1)[1], r.section, r.key): r.value for r in files.ini_entries(spark, str(folder)).collect()}
    assert entries[("a.ini", "Other", "seqlength")] == "9" and entries[("b.ini", "Empty", None)] is None and len(entries) == 9
    for n, body in enumerate(("[Sequence]\nseqLength=x\nimWidth=7\nimHeight=8\n", "[Sequence]\nseqLength=1\nseqLength=1\nimWidth=7\nimHeight=8\n", "seqLength=1\n", "")):
        (tmp_path / f"bad{n}.ini").write_text(body)
        if body:
            with pytest.raises(PySparkException, match="seqlength is not there once"):
                files.sequence_info(spark, str(tmp_path / f"bad{n}.ini")).collect()


def test_rows_of_tensors(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_TENSOR_BYTES", 100)
    rng = np.random.default_rng(1)
    arrays = {"x": rng.normal(size=(37, 2, 3)).astype(np.float32), "one": np.arange(5), "none": np.empty((0, 4)), "flat": np.array(2.5)}
    np.savez(tmp_path / "a.npz", **arrays)
    np.savez_compressed(tmp_path / "b.npz", **{k: v[:3] if v.ndim else v for k, v in arrays.items()})
    got = files.tensor_rows(spark, str(tmp_path), "x").orderBy("path", "row").collect()
    assert [r.row for r in got] == [*range(37), *range(3)]
    assert [r["values"] for r in got[:37]] == arrays["x"].reshape(37, 6).tolist() == [*[r["values"] for r in got[37:]], *arrays["x"].reshape(37, 6)[3:].tolist()]
    assert sorted(r["values"][0] for r in files.tensor_rows(spark, str(tmp_path), "one", "long").collect()) == [0, 0, 1, 1, 2, 2, 3, 4]
    assert files.tensor_rows(spark, str(tmp_path), "none").count() == 0
    assert [r["values"] for r in files.tensor_rows(spark, str(tmp_path / "a.npz"), "flat", "double").collect()] == [[2.5]]


@pytest.mark.parametrize("fault", ["absent", "columns", "short", "long"])
def test_faulty_tensors(spark, tmp_path, fault):
    x = np.arange(12.0).reshape(3, 4)
    path = tmp_path / "t.npz"
    np.savez(path, **({"y": x} if fault == "absent" else {"x": np.asfortranarray(x)} if fault == "columns" else {"x": x}))
    if fault in ("short", "long"):
        with zipfile.ZipFile(path) as z:
            body = z.read("x.npy")
        with zipfile.ZipFile(path, "w") as z:
            z.writestr("x.npy", body[:-8] if fault == "short" else body + b"12345678")
    with pytest.raises(PySparkException):
        files.tensor_rows(spark, str(path), "x").collect()


def test_boundary_features(spark, tmp_path):
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    shapes = [
        {"type": "Polygon", "coordinates": [square]},
        {"type": "MultiPolygon", "coordinates": [[square], [[[p[0] + 9, p[1]] for p in square]]]},
        {"type": "Polygon", "coordinates": [[[0, 0], [4, 4], [4, 0], [0, 4], [0, 0]]]},
        {"type": "Polygon", "coordinates": [square[:3]]},
        {"type": "Point", "coordinates": [1, 2]},
        {"type": "Polygon", "coordinates": []},
    ]
    (tmp_path / "all.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": g} for g in shapes]}, indent=2))
    (tmp_path / "bare.json").write_text(json.dumps(shapes[0]))
    (tmp_path / "broken.json").write_text("{")
    rows = {(r.path.rsplit("/", 1)[1], r.nth): r for r in files.boundary_features(spark, str(tmp_path)).collect()}
    assert len(rows) == 8
    assert [rows[("all.json", i)].fault is None for i in range(6)] == [True, True, False, False, False, False]
    assert [len(rows[("all.json", i)].parts) for i in range(2)] == [1, 2] and rows[("all.json", 4)].fault == "not a polygon"
    assert rows[("bare.json", 0)].fault is None and rows[("broken.json", 0)].fault


def test_locks_are_judged_each_by_itself(spark, tmp_path):
    source = lambda side, path: {"side": side, "path": path, "sha256": "0" * 64, "url": "u", "format": "csv"}
    for name, paths in (("a", ("p", "q")), ("b", ("p", "p"))):
        (tmp_path / f"{name}.json").write_text(json.dumps({"dataset": "x", "sources": [source("r1", paths[0]), source("r2", paths[1])]}))
    got = sorted((r.lock.rsplit("/", 1)[1], r.path, r.problems) for r in files.lock_entries(spark, str(tmp_path)).collect())
    assert got == [("a.json", "p", []), ("a.json", "q", []), ("b.json", "p", ["repeated_path"]), ("b.json", "p", ["repeated_path"])]


def test_differences_of_documents(spark):
    table = lambda *rows: spark.createDataFrame(rows, "k int, v string")
    wanted = table((1, '{"a":{"b":1,"c":[1,{"d":null}]},"e":""}'), (2, '{"a":1}'), (3, "[]"), (4, '{"a":1}'), (5, None), (6, "7"), (None, "1"))
    found = table((1, '{"e":"","a":{"c":[1,{"d":0}],"x":{}}}'), (2, '{"a":1.0}'), (3, "[]"), (4, "{"), (5, "true"), (6, " 7 "), (None, "1"))
    got = {(r.k, r.path): (r.problem, r.expected, r.actual) for r in audit.document_differences(wanted, found, "k", "v").collect()}
    assert got == {
        (1, "a.b"): ("missing", "1", None),
        (1, "a.x"): ("unexpected", None, "{}"),
        (1, "a.c[1].d"): ("other", "null", "0"),
        (2, "a"): ("other", "1", "1.0"),
        (4, "a"): ("missing", "1", None),
        (4, ""): ("unreadable", None, None),
        (5, ""): ("unexpected", None, "true"),
    }
    assert audit.document_differences(table(), table(), "k", "v").count() == 0


def test_differences_of_many_documents(spark, monkeypatch):
    """Texts move, not their leaves, in tasks that grow in number; equal keys over several batches are one document, in any form of key."""
    docs = [(k % 40, json.dumps({"a": [k % 3, k], "long": "x" * (1200 * (k % 5 == 0))}) if k % 7 else "{") for k in range(400)]
    wanted, found = docs[::2], [*docs[:200:2], *docs[1::4]]
    ids = lambda rows, form: spark.createDataFrame([(None if k == 3 else k, t) for k, t in rows], "k int, v string").select(form, "v")
    monkeypatch.setattr(audit, "DOCUMENT_BYTES", 2000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        for form in ("k", "cast(if(k = 5, 'nan', string(k)) as double) k", "concat('é', k) k", "array(k) k"):
            sides = [ids(rows, F.expr(form.removesuffix(" k")).alias("k")) for rows in (wanted, found)]
            result = audit.document_differences(*sides, "k", "v")
            assert result.rdd.getNumPartitions() > 20
            rows = lambda df: sorted(map(repr, df.collect()))
            assert rows(result) == rows(audit._leaf_differences(*sides, "k", "v"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
