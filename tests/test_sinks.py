"""Files with fixed bytes, verified shards, and checks of exports that know ties."""

import gzip
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewise import scratch
from tilewise.operators import postprocess
from tilewise.schema import RELATION
from tilewise.sources import arrays
from tilewise.streaming import shards

NAMES = [f.name for f in RELATION.fields]


def relation(spark, n):
    return spark.range(n, numPartitions=5).select(*[(F.col("id") * (i + 1) - i).cast("long").alias(c) if c != "record_id" else F.col("id").alias(c) for i, c in enumerate(NAMES)])


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_array_has_the_bytes_of_the_library(spark, tmp_path, n):
    rows = relation(spark, n)
    np.save(tmp_path / "plain.npy", np.array([list(r) for r in rows.orderBy("record_id").collect()], dtype="<i8").reshape(n, len(NAMES)))
    for parts in (1, 6):
        path = str(tmp_path / f"{parts}.npy")
        assert arrays.write_array(rows.repartition(parts, F.col("record_id") % 13), path) == n
        assert open(path, "rb").read() == (tmp_path / "plain.npy").read_bytes()
    with pytest.raises(FileExistsError):
        arrays.write_array(rows, str(tmp_path / "1.npy"))


@pytest.mark.parametrize("broken", ["record_id + 1", "record_id div 2", "record_id * 2", "record_id - 1", "if(record_id = 7, 8, record_id)"])
def test_places_that_are_no_numbering_leave_nothing(spark, tmp_path, broken):
    with pytest.raises(Exception, match="place"):
        arrays.write_array(relation(spark, 100).withColumn("record_id", F.expr(broken)), str(tmp_path / "a.npy"))
    assert os.listdir(tmp_path) == []


def test_ledger_bytes_depend_on_rows_alone(spark, tmp_path):
    rows = spark.range(2500, numPartitions=4).select((F.col("id") % 700).alias("index"), F.when(F.col("id") % 3 > 0, F.concat(F.lit('é"'), F.col("id").cast("string"))).alias("detail"), F.lit("r1").alias("side"))
    found = set()
    for parts in (1, 3, 7):
        path = str(tmp_path / f"{parts}.gz")
        assert arrays.write_ledger(rows.repartition(parts), path, ["index"], 100) == 2500
        found.add(open(path, "rb").read())
    assert len(found) == 1
    lines = gzip.decompress(found.pop()).decode().splitlines()
    expected = [json.dumps({k: v for k, v in (("detail", r.detail), ("index", r["index"]), ("side", r.side)) if v is not None}, ensure_ascii=False, separators=(",", ":")) for r in rows.collect()]
    assert lines == sorted(expected, key=lambda x: (json.loads(x)["index"], x))
    assert arrays.write_ledger(rows.where("false"), str(tmp_path / "none.gz"), ["index"]) == 0 and os.path.getsize(tmp_path / "none.gz") == 0
    with pytest.raises(FileExistsError):
        arrays.write_ledger(rows, str(tmp_path / "1.gz"), ["index"])


def test_shards_resume_with_what_is_sound(spark, tmp_path):
    out = str(tmp_path / "shards")
    rows = spark.range(1050, numPartitions=3).select(F.col("id").alias("n"), (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("t"))
    schema = shards._schema(rows.withColumn("shard", F.lit(0)))
    fault = lambda: {(r.shard, r.fault) for r in shards.faults(spark, out, schema, "n").collect()}
    assert shards.build(rows, out, "n", 100, source="a") == list(range(11)) and fault() == set()
    assert shards.build(rows.repartition(5), out, "n", 100, source="a") == []
    with pytest.raises(ValueError):
        shards.build(rows, out, "n", 100, source="b")
    victim = next((tmp_path / "shards" / "rows" / "shard=3").glob("part-*"))
    victim.unlink()
    shards.write(rows.where("n between 500 and 599").withColumn("t", F.lit("x")), out, "n", 100)
    assert fault() >= {(5, "damaged")} and {s for s, _ in fault()} == {3, 5}
    assert shards.build(rows, out, "n", 100, source="a") == [3, 5] and fault() == set()
    # More records: only the last shard and new ones are written.
    more = rows.union(spark.range(1050, 1210).select("id", F.lit(0), F.lit(None).cast("string")))
    assert shards.build(more, out, "n", 100, source="a") == [10, 11, 12]
    manifest = shards.read_manifest(spark, out).collect()
    assert [(r.first, r.last, r.n) for r in sorted(manifest, key=lambda r: r.shard)][-2:] == [(1100, 1199, 100), (1200, 1209, 10)]
    changed = [(r.shard, r.first, r.last + (r.shard == 4), r.n, r.digest, r.chain) for r in manifest]
    spark.createDataFrame(changed, shards._MANIFEST).coalesce(1).write.mode("overwrite").json(f"{out}/manifest")
    assert fault() == {(4, "damaged"), (4, "broken_chain"), (5, "overlap")}


def test_spacing_of_floats(spark):
    values = [0.0, 1.0, -1.0, 0.99999994, 8.0, 7.9999995, 1e-45, 1e-38, 1.2e-38, 3e38, 123456.7, 2.0**-126, 2.0**-125]
    got = [r.s for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", postprocess.float_spacing(F.col("v").cast("float")).alias("s")).orderBy("i").collect()]
    assert got == [abs(float(np.spacing(np.float32(v)))) for v in values]


def test_intervals_of_ranks_equal_counting(spark):
    rng = np.random.default_rng(6)
    k, tolerance = 7, 0.011
    rows = [(key, i // 5, i % 5, float(v)) for key in range(30) for i, v in enumerate(np.round(rng.random(20), 2))]
    rows += [(99, i // 5, i % 5, v) for i, v in enumerate([0.9, float("nan"), 0.8, 0.8, float("inf"), 0.7, 0.7, 0.7, 0.7, 0.1])] + [(100, 0, i, 0.8) for i in range(4)]
    got = postprocess.tie_aware(spark.createDataFrame(rows, "key int, query int, label int, score double").repartition(3), "key", k, 0.5, tolerance).collect()
    for r in got:
        mine = np.array([s for key, _, _, s in rows if key == r.key])
        mine = np.where(np.isfinite(mine), mine, np.inf)
        s = r.score if np.isfinite(r.score) else np.inf
        cut = np.sort(mine)[::-1][min(k, len(mine)) - 1]
        assert (r.lo, r.hi) == ((mine > s + tolerance).sum(), min(k - 1, (mine >= s - tolerance).sum() - 1))
        assert (r.mandatory, r.boundary, r.slots) == (s > cut, s == cut, k - (mine > cut).sum())
        assert r.retained == bool(np.isfinite(r.score) and r.score > 0.5 and r.label != 0)


def test_more_of_a_tie_than_there_are_places(spark):
    raw = spark.createDataFrame([(1, 0, i, s) for i, s in enumerate([0.9, 0.9, 0.8, 0.8, 0.8], 1)], "key int, query int, label int, score double")
    failed = lambda labels: {r.check_code: r.failed for r in postprocess.export_checks(raw, raw.where(F.col("label").isin(labels)).withColumn("rank", F.col("label") - 1), "key", 3, 0.5, 1e-7).collect() if r.failed}
    assert failed([1, 2, 3]) == {} and failed([1, 3]) == {"mandatory_exported": 1} and failed([1, 2, 3, 4]).keys() >= {"free_choice"}
    assert failed([1, 2]) == {}


def test_scratch_tables_are_dropped(spark):
    kept = scratch.materialized(spark.range(3), "kept")
    before = list(scratch._made)
    scratch.materialized(spark.range(4), "dropped")
    (path,) = set(scratch._made) - set(before)
    scratch.drop_scratch(spark, before)
    assert scratch._made == before and kept.count() == 3 and not os.path.exists(path.removeprefix("file:"))


def test_readers_keep_their_version(spark, tmp_path):
    from tilewise.sources import versions

    table = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, table)
    first = versions.swap(spark.range(5).select(F.col("id").alias("group_id")), table)
    held = versions.read(spark, table)
    counts = spark.createDataFrame([(1, 7), (3, 9)], "group_id long, overlap_count long")
    second = versions.with_counts(spark, table, counts)
    third = versions.with_counts(spark, table, counts.where("group_id = 1"))
    assert held.count() == 5 and held.columns == ["group_id"]
    assert sorted(map(tuple, versions.read(spark, table, second).collect())) == [(0, 0), (1, 7), (2, 0), (3, 9), (4, 0)]
    assert versions.read(spark, table).agg(F.sum("overlap_count")).first()[0] == 7 and versions.current(spark, table) == third
    with pytest.raises(RuntimeError, match="another writer"):
        versions.swap(spark.range(1), table, expected=second)
    assert versions.expire(spark, table, (first,)) == [second] and held.count() == 5
    assert sorted(p.name for p in (tmp_path / "table").iterdir() if p.name.startswith("v-")) == sorted([first, third])


def test_a_release_with_other_counts_is_refused(spark, sf_dir, tmp_path):
    from tilewise.plans import workloads as W
    from tilewise.sources import publish

    groups = scratch.materialized(W.line_groups(spark, sf_dir), "g")
    out = publish.publish(spark, str(tmp_path / "release"), W.line_records(spark, sf_dir, groups), groups)
    assert publish.load(spark, out)["groups"].count() == groups.count()
    part = next((tmp_path / "release" / "r2.parquet").glob("part-*"))
    part.with_name(f"part-again-{part.name}").write_bytes(part.read_bytes())
    with pytest.raises(ValueError, match="r2 has"):
        publish.load(spark, out)


def test_sums_of_a_release_pass_64_bits(spark, sf_dir, tmp_path):
    """A group for each row, wide enough for slabs that sum up to over 2^63 on one side; the SQL's BIGINT cannot hold that."""
    import duckdb
    from compare import connect

    from tilewise.plans.queries import QUERIES
    from tilewise.plans.sql import _RECORDS, ORACLES

    row = "i l_orderkey, 1::INTEGER l_linenumber, i l_partkey, i l_suppkey, 1::DOUBLE l_quantity, 1::DOUBLE l_extendedprice, 0.1::DOUBLE l_discount, 900000::DOUBLE l_tax, 'A' l_returnflag, if(i % 10 = 0, 'O', 'F') l_linestatus, TIMESTAMP '1995-01-01' l_shipdate"
    duckdb.sql(f"SELECT {row} FROM range(24000) r(i)").write_parquet(str(tmp_path / "lineitem.parquet"))
    con = connect(str(tmp_path))
    wanted = con.execute(f"WITH {_RECORDS} SELECT side, count(*), sum((x0 + dx)::HUGEINT), sum((y1 + dy)::HUGEINT), max(record_id) FROM rec GROUP BY side ORDER BY side").fetchall()
    assert wanted[0][2] > 2**63 > wanted[1][2]
    with pytest.raises(duckdb.ConversionException):
        con.execute(ORACLES["loader_roundtrip"]).fetchall()
    found = QUERIES["loader_roundtrip"](spark, str(tmp_path)).orderBy("side")
    assert [(r.side, r.n, r.sum_x0, r.sum_y1, r.last_id) for r in found.collect()] == wanted
    assert dict(found.dtypes)["sum_y1"] == "bigint"
    assert dict(QUERIES["loader_roundtrip"](spark, sf_dir).dtypes)["sum_x0"] == "bigint"


def test_small_shards_are_one_file_each(spark, tmp_path):
    out = tmp_path / "shards"
    shards.write(spark.range(300, numPartitions=3).select(F.col("id").alias("n")), str(out), "n", 100)
    assert [len(list((out / "rows" / f"shard={k}").glob("part-*"))) for k in range(3)] == [1, 1, 1]


def test_files_are_compared_in_pieces(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    for path, body in ((one, b"a" * 1000), (two, b"a" * 999 + b"b")):
        with open(path, "wb") as f:
            f.write(body)
    assert arrays.same_bytes(spark, one, one, 64) and not arrays.same_bytes(spark, one, two, 64)
    open(two, "ab").close()
    os.truncate(two, 999)
    assert not arrays.same_bytes(spark, one, two, 64)


def test_tasks_grow_with_the_rows(spark, sf_dir, monkeypatch):
    """Ranges of a numbered relation were as many as the session's shuffle partitions at any size."""
    from tilewise.operators import ordering
    from tilewise.plans import workloads

    expected = sorted(workloads.line_records(spark, sf_dir).select("side", "record_id", "group_id").collect())
    monkeypatch.setattr(ordering, "TASK_ROWS", 500)
    assert ordering.tasks_for(spark.range(1), 500) is None and ordering.tasks_for(spark.range(1), 6001) == 13
    cut = []
    monkeypatch.setattr(workloads.grouping, "ordered", lambda *a, **k: cut.append(k.get("tasks")) or ordering.ordered(*a, **k))
    assert sorted(workloads.line_records(spark, sf_dir).select("side", "record_id", "group_id").collect()) == expected
    assert cut[-1] == -(-len(expected) // 500) > 4


def test_weighted_samples_equal_samples_of_copies(spark):
    """Copies as a weight give the sample of the copies themselves, also where the limit lets too few through."""
    from tilewise.operators import sampling

    rows = spark.range(400).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"), (1 + F.col("id") % 3).alias("n"))
    copies = rows.withColumn("c", F.explode(F.sequence(F.lit(1), "n")))
    for k in (7, 150, 5000):
        wanted = {(r.g, r.v): r["count"] for r in sampling.bounded_samples(copies, ["g"], k, "s", "v").groupBy("g", "v").count().collect()}
        for size in (200, 10**9):
            sizes = spark.createDataFrame([(g, size) for g in (0, 1)], "g long, rows long")
            got = sampling.weighted_samples(rows, ["g"], k, "s", sizes, "n", "v").collect()
            assert sum(r.n for r in got) == sum(wanted.values())
            if k != 7:
                assert len(got) <= len(wanted) + 2
            edges = {(r.g, r.v): r.n for r in got}
            assert edges == wanted
