import gzip
import json
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewise.functions import geometry
from tilewise.operators import audit, grouping, rejects
from tilewise.plans import workloads as W
from tilewise.schema import RELATION
from tilewise.scratch import materialized
from tilewise.sources import files, lines, npy, publish
from tilewise.streaming import resume


def test_npy_round_trip(spark, tmp_path):
    spark.dataSource.register(npy.NpyDataSource)
    rows = [(i, i // 3, i, i + 1, i + 5, i + 9, 1) for i in range(1000)]
    df = spark.createDataFrame(rows, RELATION).repartitionByRange(3, "record_id")
    out = str(tmp_path / "r1")
    df.write.format("npy").option("path", out).mode("append").save()
    assert sum(len(np.load(p)) for p in (tmp_path / "r1").iterdir()) == 1000
    back = spark.read.format("npy").option("path", out).option("rowsPerPartition", "100").load()
    assert sorted(map(tuple, back.collect())) == rows
    with pytest.raises(Exception, match="FileExistsError|exists"):
        df.write.format("npy").option("path", out).mode("append").save()
    df.where("record_id < 9").write.format("npy").option("path", out).mode("overwrite").save()
    assert spark.read.format("npy").option("path", out).load().count() == df.where("record_id < 9").count()
    assert [p.name for p in tmp_path.iterdir() if "staging" in p.name] == []
    np.save(tmp_path / "bad.npy", np.zeros((3, 2)))
    with pytest.raises(Exception, match="expected int64"):
        spark.read.format("npy").option("path", str(tmp_path / "bad.npy")).load().collect()


def test_numbered_lines(spark, tmp_path):
    lines.register(spark)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.jsonl", "﻿{\"a\":1}\n\n{\"a\":2}\nnot json\n")
    read = lambda p, **o: spark.read.format("numbered_lines").options(path=str(p), **o).load()
    got = [(r.record, r.line, r.value) for r in read(tmp_path / "a.zip").orderBy("record").collect()]
    assert got == [(1, 1, '{"a":1}'), (2, 3, '{"a":2}'), (3, 4, "not json")]
    assert read(tmp_path / "a.zip").where("record <= 2").count() == 2
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("x", "1\n")
        z.writestr("y", "2\n")
    with pytest.raises(Exception, match="name one member"):
        read(tmp_path / "b.zip").collect()
    assert read(tmp_path / "b.zip", member="y").first().value == "2"
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write('geometry,confidence\n"POLYGON ((0 0,\n1 0, 1 1, 0 0))",0.7\nshort\n"POINT (1 1)",0.2\n')
    got = files.footprints_csv(spark, str(tmp_path / "c.csv.gz")).orderBy("record").collect()
    assert [(r.record, r.line, r.wkt is None) for r in got] == [(1, 3, False), (2, 4, True), (3, 5, False)]
    (tmp_path / "d.csv").write_text("a,a\n1,2\n")
    with pytest.raises(Exception, match="repeated names"):
        read(tmp_path / "d.csv", kind="csv").collect()


def test_annotation_document_keeps_exact_numbers(spark, tmp_path):
    doc = """{"images":[{"id":1,"file_name":"d/a.png","width":10,"height":10}],"categories":[{"id":1,"name":"x"}],
    "annotations":[{"id":5,"image_id":1,"category_id":1,"bbox":[0.25,0.0015,0.5,2e1],"iscrowd":0},{"id":6,"image_id":1,"category_id":1,"bbox":[NaN,0,1,1]},{"id":7,"image_id":1,"category_id":1,"bbox":[0,0,1]},{"id":8,"image_id":1,"category_id":1,"bbox":[7.3125000000000000000009,0,1,1]}]}"""
    (tmp_path / "c.json").write_text(doc.replace("\n", " "))
    got = files.annotation_documents(spark, str(tmp_path / "c.json"))
    notes = got["annotations"].orderBy("ordinal").collect()
    assert [(n.ordinal, n.id, n.reason, n.box) for n in notes[:1]] == [(0, 5, None, [250, 2, 750, 20002])]
    assert [n.reason for n in notes] == [None, "nonfinite_geometry", "malformed_bbox", None]
    assert notes[3].box[0] == 7313
    assert got["images"].first().identity == "a.png" and got["categories"].first().name == "x"


def test_tracking_rows(spark, tmp_path):
    (tmp_path / "gt.txt").write_text("1,7,10,10,5,5,1,1,0.9\n\n1,8,10,10,5,5,0,1,0.9\n2,9,10,10,5,5,1,2,0.9\n2,9,10,10,0,5,1,1,0.9\n1,2\n")
    got = files.tracking_rows(spark, str(tmp_path / "gt.txt"), "r1").orderBy("ordinal").collect()
    assert [(r.ordinal, r.reason) for r in got] == [(1, None), (3, "gt_invalid_flag"), (4, "gt_non_pedestrian"), (5, "nonpositive_extent"), (6, "malformed_row")]
    assert got[0].box == [10000, 10000, 15000, 15000]
    (tmp_path / "det.txt").write_text("1,-1,1,1,2,2,nan\n1,-1,1,1,2,2,0.3\n")
    assert [r.reason for r in files.tracking_rows(spark, str(tmp_path / "det.txt"), "r2").orderBy("ordinal").collect()] == ["nonfinite_score", None]
    (tmp_path / "seq.ini").write_text("[Sequence]\nname=A\nseqLength=3\nimWidth=20\nimHeight=10\n")
    assert tuple(files.sequence_info(spark, [str(tmp_path / "seq.ini")]).first()) == ("A", 3, 20, 10)


def test_page_results_images_tensors_and_locks(spark, tmp_path):
    page = {"page_id": "p", "status": "success", "predictions": [{"prediction_index": 0, "query_index": 3, "label": 2, "score": 0.9, "x0": 1.5, "y0": 2, "x1": "nan", "y1": 4}]}
    with gzip.open(tmp_path / "p.jsonl.gz", "wt") as f:
        f.write("\n" + json.dumps(page) + "\n")
    r = files.page_results(spark, str(tmp_path / "p.jsonl.gz")).first()
    assert (r.prediction_jsonl_line, r.page_id, r.query, r.x0, r.x1) == (2, "p", 3, "1.5", "nan")
    assert (r.extents, r.box, r.reason) == (None, None, "nonfinite_geometry")
    head = struct.pack(">II5B", 31, 17, 8, 2, 0, 0, 0)
    (tmp_path / "i.png").write_bytes(b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + head + struct.pack(">I", zlib.crc32(b"IHDR" + head)))
    assert [(r.width, r.height) for r in files.image_files(spark, str(tmp_path)).collect()] == [(31, 17)]
    np.savez(tmp_path / "t.npz", boxes=np.arange(4, dtype=np.float32).reshape(1, 2, 2))
    assert files.tensors(spark, [str(tmp_path / "t.npz")], "boxes").first()["values"] == [0, 1, 2, 3]


def test_locks(spark, tmp_path):
    one = {"side": "r1", "path": "d/a", "sha256": "0" * 64, "format": "csv", "url": "u"}
    two = {**one, "side": "r2", "path": "b", "sha256": "1" * 64, "size_bytes": 7}
    edge = {"path": "edge.json", "sha256": "2" * 64, "url": "u"}

    def problems(lock, **wanted):
        (tmp_path / "lock.json").write_text(json.dumps(lock, indent=1))
        return {r.path: r.problems for r in files.lock_entries(spark, str(tmp_path / "lock.json"), **wanted).collect()}

    good = {"dataset": "x", "crs": "laea", "boundary": edge, "sources": [one, two]}
    assert problems(good, dataset="x", crs="laea") == problems(good) == {"d/a": [], "b": [], "edge.json": []}
    assert problems(good, dataset="y", crs="utm")["b"] == ["dataset", "crs"] and problems({**good, "crs": None}, crs="laea")["b"] == []
    bad = {"path": ["/a", "a/../b", "../b"], "side": ["x", None], "sha256": ["F" * 64, "0", None], "url": ["", None], "format": ["pdf", None]}
    names = {"sha256": "digest"}
    for field, values in bad.items():
        for v in values:
            got = problems({**good, "sources": [one, {**two, "side": "r2", field: v}, {**two, "path": "c"}]})
            assert got[v if field == "path" else "b"] == [names.get(field, field)], (field, v)
    assert problems({**good, "sources": [one]})["d/a"] == ["sides"]
    assert problems({**good, "sources": [one, two, {**two, "url": None}]})["b"] in (["repeated_path"], ["repeated_path", "url"])
    problems(good)
    entries = files.lock_entries(spark, str(tmp_path / "lock.json"))
    found = spark.createDataFrame([("d/a", 3, "0" * 64), ("b", 8, "9" * 64)], "path string, size long, sha256 string")
    assert {r.path: r.problems for r in files.verified_lock(entries, found).collect()} == {"d/a": [], "b": ["checksum", "size"], "edge.json": ["missing"]}


def square(x, y, side):
    return [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]


def test_footprints_keep_parts_and_holes(spark, tmp_path):
    shell, hole, far = square(-3, 5, 6), square(-2, 6, 2), square(20, 5, 3)
    shapes = [{"type": "Polygon", "coordinates": [shell, hole]}, {"type": "MultiPolygon", "coordinates": [[shell, hole], [far[::-1]]]}]
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as z:
        z.writestr("f", "".join(json.dumps(x) + "\n" for x in [{"type": "Feature", "properties": {"a": 1}, "geometry": shapes[0]}, shapes[1], {"type": "Point", "coordinates": [1, 2]}]))
    df = files.footprints_geojson(spark, str(tmp_path / "f.zip"))
    cx, cy = geometry.centroid(F.col("parts"))
    one, two, point = df.select("parts", cx.alias("x"), cy.alias("y"), geometry.area(F.col("parts")).alias("area")).orderBy("record").collect()
    assert point.parts is None and [len(p) for p in two.parts] == [2, 1]
    assert (one.area, two.area) == (32, 41)
    assert (round(one.x, 9), round(one.y, 9)) == (round((36 * 0 - 4 * -1) / 32, 9), round((36 * 8 - 4 * 7) / 32, 9))
    assert (round(two.x, 9), round(two.y, 9)) == (round((4 + 9 * 21.5) / 41, 9), round((260 + 9 * 6.5) / 41, 9))
    text = lambda ring: "(" + ", ".join(f"{x} {y}" for x, y in ring) + ")"
    wkt = f"MULTIPOLYGON ((({text(shell)[1:]}, {text(hole)}), ({text(far)}))"
    got = spark.createDataFrame([(wkt,)], "w string").select(geometry.wkt_parts(F.col("w")).alias("parts")).select("parts", geometry.centroid(F.col("parts"))[0].alias("x")).first()
    assert [len(p) for p in got.parts] == [2, 1] and round(got.x, 9) == round(two.x, 9)


def test_points_against_a_union_with_holes(spark, tmp_path):
    features = [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [square(0, 0, 10), square(2, 2, 4)]}}, {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[square(3, 3, 1)], [square(10, 0, 5)]]}}]
    (tmp_path / "b.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    polygons = files.boundary_polygons(spark, str(tmp_path / "b.json"))
    assert len(polygons) == 3
    third = 1 / 3
    points = [(1.0, 1.0, True), (2.5, 2.5, False), (3.5, 3.5, True), (2.0, 4.0, True), (3.0, 3.0, True), (10.0, 2.0, True), (12.0, 2.0, True), (12.0, 6.0, False), (15.0, 5.0, True), (-1e-300, 5.0, False), (float("nan"), 1.0, None), (None, 1.0, None), (0.0, third, True)]
    got = spark.createDataFrame([(i, x, y) for i, (x, y, _) in enumerate(points)], "i int, x double, y double").select("i", geometry.covers(polygons)("x", "y").alias("c")).orderBy("i").collect()
    assert [r.c for r in got] == [c for _, _, c in points]
    slope = geometry.covers([[[(0.0, 0.0), (0.3, 0.1), (0.0, 1.0), (0.0, 0.0)]]])
    # 0.1 and 0.3 are not thirds of each other in binary: the edge misses (0.15, 0.05) by less than a rounding.
    from fractions import Fraction as R

    on = R(0.3) * R(0.05) - R(0.1) * R(0.15)
    assert spark.range(1).select(slope(F.lit(0.15), F.lit(0.05)).alias("c")).first().c == (on >= 0)
    for ring in ([[0, 0], [1, 1], [1, 0], [0, 1], [0, 0]], [[0, 0], [1, 0], [2, 0], [0, 0]], [[0, 0], [1, 0], [1, 1]], [[0, 0], [float("inf"), 0], [1, 1], [0, 0]]):
        with pytest.raises(ValueError, match="boundary ring"):
            geometry.check_polygons([[[tuple(map(float, p)) for p in ring]]])


def test_geojson_bounds_at_any_depth(spark):
    deep = {"type": "FeatureCollection", "features": [{"geometry": {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [7, -2, 99]}, {"type": "MultiPolygon", "coordinates": [[square(1, 1, 2)]]}]}}]}
    texts = [json.dumps(deep), '{"type": "Point", "coordinates": []}', "no json", None]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(geometry.geojson_bounds("t")).collect()]
    assert got == [[1, -2, 7, 3], None, None, None]


def test_rings_without_area_are_invalid(spark):
    cases = {"POLYGON ((0 0, 2 2, 0 2, 2 0, 0 0))": "invalid_geometry", "POLYGON ((0 0, 1 1, 2 2, 0 0))": "invalid_geometry", "POLYGON ((0 0, 2 0, 2 2, 0 0))": None, "POLYGON EMPTY": "empty_geometry"}
    df = spark.createDataFrame([(k,) for k in cases], "w string").withColumn("parts", geometry.wkt_parts(F.col("w")))
    x, y = geometry.centroid(F.col("parts"))
    got = {r.w: (r.p, r.x is None) for r in df.select("w", geometry.ring_problem(F.flatten("parts")).alias("p"), x.alias("x"), y.alias("y")).collect()}
    assert got == {k: (p, p is not None) for k, p in cases.items()}


def test_schema_gate(spark):
    from pyspark.sql import types as T

    from tilewise.schema import check_schema, schema_report

    good = spark.createDataFrame([], RELATION)
    assert schema_report(good, RELATION).count() == 0
    bad = good.withColumn("y1", F.col("y1").cast("int")).drop("weight")
    assert [(r.place, r.name, r.want, r.have) for r in schema_report(bad, RELATION).orderBy("place").collect()] == [(5, "y1", "y1 bigint", "y1 int"), (6, "weight", "weight bigint", None)]
    with pytest.raises(ValueError, match="schema differs"):
        check_schema(bad, RELATION)
    assert schema_report(good, T.StructType(RELATION.fields[:6])).first().want is None


def test_self_crossing(spark):
    bow = [[{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 2.0}, {"x": 2.0, "y": 0.0}, {"x": 0.0, "y": 2.0}, {"x": 0.0, "y": 0.0}]]
    box = [[{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}, {"x": 0.0, "y": 2.0}, {"x": 0.0, "y": 0.0}]]
    df = spark.createDataFrame([(0, bow), (1, box), (2, None)], "i int, r array<array<struct<x:double,y:double>>>")
    assert [r[0] for r in df.orderBy("i").select(geometry.self_crossing("r")).collect()] == [True, False, None]


def test_release_round_trip_and_change(spark, sf_dir, tmp_path):
    groups = materialized(W.line_groups(spark, sf_dir), "g")
    records = W.line_records(spark, sf_dir, groups)
    rejected = W.line_boxes(spark, sf_dir).where("reason is not null").select("side", "reason")
    contract = {"source": "lines", "scale": 1000}
    ledger = rejects.ledger(W.line_boxes(spark, sf_dir))
    build = lambda c: publish.publish(spark, str(tmp_path / "release"), records, groups, rejected, ledger=ledger, contract=c)
    out = build(contract)
    loaded = publish.load(spark, out)
    assert loaded["r1"].count() + loaded["r2"].count() == records.count()
    assert publish.group_rows(loaded, "r1", 3).count() == groups.where("group_id = 3").first().r1_count
    assert publish.changed_files(spark, out).count() == 0
    manifest = spark.read.json(f"{out}/manifest").first()
    states = {r.state: r.n for r in groups.groupBy("state").agg(F.count("*").alias("n")).collect()}
    assert {k: n for k, n in manifest.states.asDict().items() if n} == states and json.loads(manifest.contract) == contract
    assert {(r["side"], r["key"]): r["n"] for r in manifest.ledger} == {(r.side, r.key): r.n for r in ledger.collect()}
    before = sorted(p.name for p in (tmp_path / "release" / "r1.parquet").iterdir())
    assert build({"scale": 1000, "source": "lines"}) == out and sorted(p.name for p in (tmp_path / "release" / "r1.parquet").iterdir()) == before
    with pytest.raises(FileExistsError):
        build({**contract, "scale": 10})
    checks = audit.bounds_checks(groups)
    text = publish.release_document(spark, out, "Lines", checks)
    assert (tmp_path / "release.md").read_text() == text and f"| group_count | {manifest.group_count} |" in text
    with pytest.raises(AssertionError, match="right_edge"):
        publish.release_document(spark, out, "Lines", audit.bounds_checks(groups.withColumn("global_max_x", F.lit(0).cast("long"))))
    victim = next((tmp_path / "release" / "r1.parquet").glob("part-*"))
    victim.write_bytes(victim.read_bytes() + b"x")
    (victim.parent / f".{victim.name}.crc").unlink(missing_ok=True)
    assert publish.changed_files(spark, out).count() == 1
    with pytest.raises(FileExistsError):
        build(contract)
    with pytest.raises(AssertionError, match="changed"):
        publish.release_document(spark, out, "Lines", checks)


def test_long_files_are_digested_as_streams(spark, tmp_path, monkeypatch):
    (tmp_path / "part-1").write_bytes(b"x" * 70_000)
    (tmp_path / "part-2").write_bytes(b"y")
    expected = {tuple(r) for r in publish.digests(spark, str(tmp_path)).collect()}
    monkeypatch.setattr(publish, "_WHOLE_BYTES", 10)
    assert {tuple(r) for r in publish.digests(spark, str(tmp_path)).collect()} == expected and len(expected) == 2


def test_resumed_build_takes_each_file_once(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "x0 long, y0 long, x1 long, y1 long"
    make = lambda n: spark.createDataFrame([(n, 0, n + 1, 1)], schema).coalesce(1).write.mode("append").parquet(src)
    make(1)
    make(5)
    df_schema = spark.createDataFrame([], schema).schema
    go = lambda c="a": resume.build_available(spark, src, df_schema, lambda d: d, str(tmp_path / "out"), str(tmp_path / "cp"), resume.contract_hash(v=c), 1)
    assert go() == 2
    make(9)
    assert go() == 1 and go() == 0
    r = resume.merged_bounds(spark.read.parquet(str(tmp_path / "out"))).first()
    assert (r.n, r.x0, r.x1) == (3, 1, 10)
    with pytest.raises(ValueError):
        go("b")


def test_translation_back(spark, sf_dir):
    records = W.line_records(spark, sf_dir)
    again = grouping.translate(grouping.translate(records), -1)
    assert again.select("record_id", "side", "x0", "y1").exceptAll(records.select("record_id", "side", "x0", "y1")).count() == 0
