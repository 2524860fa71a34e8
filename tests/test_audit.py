"""Each check holds on sound tables and fires when its one invariant is broken."""

import pytest
from pyspark.sql import functions as F

from tilewise.operators import audit, grouping, overlap, pairing, postprocess, rejects, sampling
from tilewise.plans import workloads as W
from tilewise.scratch import materialized


@pytest.fixture(scope="module")
def sound(spark, sf_dir):
    groups = materialized(W.line_groups(spark, sf_dir), "test-groups")
    records = W.line_records(spark, sf_dir, groups)
    local = records.withColumns({f"l_{c}": F.col(c) for c in overlap.BOX})
    packed = grouping.translate(local).withColumn("weight", F.lit(1)).drop("dx", "dy")
    return groups, materialized(packed.drop("l_shipdate"), "test-records")


def failed(report):
    return {r.check_code for r in report.collect() if r.failed}


BROKEN_RECORDS = {
    "known_group": ("group_id", lambda: F.lit(10**9)),
    "unit_weight": ("weight", lambda: F.lit(2)),
    "nonnegative": ("y0", lambda: F.lit(-5).cast("long")),
    "positive_extent": ("x1", lambda: F.col("x0")),
    "translation": ("l_x0", lambda: F.col("l_x0") + 1),
    "extent_kept": ("l_y1", lambda: F.col("l_y1") + 1),
    "inside_slab": ("x1", lambda: F.col("x1") + 10**12),
    "inside_slice": ("record_id", lambda: F.lit(10**9)),
}


def test_sound_records_pass(sound):
    groups, records = sound
    report = audit.record_checks(records, groups)
    assert failed(report) == set()
    audit.require(report)


@pytest.mark.parametrize("code", BROKEN_RECORDS)
def test_broken_record_is_found(sound, code):
    groups, records = sound
    column, value = BROKEN_RECORDS[code]
    report = audit.record_checks(records.withColumn(column, F.when((F.col("record_id") == 3) & (F.col("side") == "r1"), value()).otherwise(F.col(column))), groups)
    assert code in failed(report)
    with pytest.raises(AssertionError, match=code):
        audit.require(report)


BROKEN_GROUPS = {
    "numbered": lambda g: g.where("group_id <> 1"),
    "key_order": lambda g: g.withColumn("semantic_key", F.when(F.col("group_id") == 2, F.lit("!")).otherwise(F.col("semantic_key"))),
    "r1_slices": lambda g: g.withColumn("r1_start", F.when(F.col("group_id") == 2, F.col("r1_start") + 1).otherwise(F.col("r1_start"))),
    "r2_slices": lambda g: g.withColumn("r2_count", F.when(F.col("group_id") == 2, F.col("r2_count") + 1).otherwise(F.col("r2_count"))),
    "slab_order": lambda g: g.withColumn("global_max_x", F.when(F.col("group_id") == 2, F.lit(10**15)).otherwise(F.col("global_max_x"))),
    "state": lambda g: g.withColumn("state", F.when(F.col("group_id") == 2, F.lit("both_empty")).otherwise(F.col("state"))),
}


def totals(g):
    return g.agg(F.sum("r1_count").alias("r1"), F.sum("r2_count").alias("r2"), F.count("*").alias("n_groups"))


def test_sound_groups_pass(sound):
    assert failed(audit.group_checks(sound[0], totals(sound[0]))) == set()


@pytest.mark.parametrize("code", BROKEN_GROUPS)
def test_broken_group_is_found(sound, code):
    broken = BROKEN_GROUPS[code](sound[0])
    assert code in failed(audit.group_checks(broken, totals(sound[0])))


def test_false_isolation_is_found(sound):
    g = sound[0].withColumn("global_max_x", F.when(F.col("group_id") == 0, F.lit(10**9)).otherwise(F.col("global_max_x")))
    assert not all(r.isolated for r in audit_isolation(g))


def audit_isolation(g):
    return grouping.isolation(g).collect()


def test_ledger_balances_and_fires(spark):
    df = spark.createDataFrame([("r1", None), ("r1", "x"), ("r2", "crowd"), ("r2", None)], "side string, reason string")
    ledger = rejects.ledger(df, early=("crowd",))
    assert all(r.balanced for r in audit.ledger_checks(ledger).collect())
    assert {(r.side, r.key): r.n for r in ledger.collect()}["r2", "geometry_candidates"] == 1
    lost = ledger.withColumn("n", F.when(F.col("key") == "retained", 0).otherwise(F.col("n")))
    assert not any(r.balanced for r in audit.ledger_checks(lost).collect())


def test_source_order(spark):
    rows = [("a", 1), ("a", 2), ("a", 5), ("b", 1), ("b", 1), ("a", 3), ("b", 9)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "at int, f string, k int")
    got = {r.f: (r.records, r.not_increasing, r.extra_blocks) for r in audit.source_order(df, "f", "k", "at").collect()}
    assert got == {"a": (4, 1, 1), "b": (3, 1, 1)}


def test_pairing_outcomes(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (4, "q"), (3, None)], "k int, v string")
    assert {r.k: r.status for r in pairing.coverage(a, b, "k", ["v"]).collect()} == {1: "matched", 2: "disagreeing", 3: "matched", 4: "missing_in_a"}
    assert {r.outcome: r.n for r in pairing.reconcile(a, b, ["k"], ["v"]).collect()} == {"equal": 2, "differs.v": 1, "unexpected": 1}
    assert {r.problem: r.n for r in pairing.completeness(a, b.unionByName(b.where("k = 1")), "k").collect()} == {"missing": 0, "unexpected": 1, "repeated": 1}


def test_top_k_puts_nonfinite_last_and_out(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, [0.1, nan, 3.0, inf, 2.0, 2.0])], "key int, v array<double>")
    c = postprocess.flattened(df, "key", "v", 3)
    top = postprocess.top_k(c, "key", 4).orderBy("rank").collect()
    assert [r.idx for r in top] == [2, 4, 5, 0]
    s = spark.createDataFrame([(nan, 1), (0.7, 1), (0.9, 0), (0.9, 2)], "score double, label int")
    got = [r[0] for r in s.select(postprocess.partition_reason(F.col("score"), F.col("label"), 0.7)).collect()]
    assert got == ["nonfinite_score", "threshold", "background", None]


def test_priority_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(1000)
    a = [r.id for r in sampling.priority_sample(df.repartition(3), 25, "s", "id").collect()]
    assert a == [r.id for r in sampling.priority_sample(df.repartition(8), 25, "s", "id").collect()] and len(set(a)) == 25


def test_further_checks_fire(spark):
    shards = spark.createDataFrame([("a", 1, 5), ("a", 6, 9), ("a", 11, 12), ("b", 1, 4), ("b", 3, 2)], "s string, lo int, hi int")
    assert {r.s: (r.shards, r.gaps, r.overlaps, r.empty) for r in audit.shard_ranges(shards, "s", "lo", "hi").collect()} == {"a": (3, 1, 0, 0), "b": (2, 0, 1, 1)}
    ids = spark.createDataFrame([("f", 1), ("f", 1), ("f", 2)], "f string, i int")
    assert tuple(audit.identity_checks(ids, ["f", "i"]).first()) == (2, 1, 2)
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "k int, n string")
    b = spark.createDataFrame([(1, "x"), (2, "z")], "k int, n string")
    assert tuple(audit.category_maps(a, b, "k", "n").first()) == (1, 1, 1)
    boxes = spark.createDataFrame([(0.0, 0.0, 1.0, 2.0, 0, 0, 1000, 2000, 0.5, 1.0), (0.0, 0.0, 1.0, 2.0, 0, 0, 1000, 2001, 5.0, 1.0)], "a double, b double, c double, d double, x0 long, y0 long, x1 long, y1 long, cx double, cy double")
    report = audit.geometry_checks(boxes, [F.col(c) for c in "abcd"], list(overlap.BOX), [F.col("cx"), F.col("cy")], F.col("cx") < 3)
    assert {r.check_code: r.failed for r in report.collect()} == {"quantization": 1, "centroid_in_box": 1, "centroid_in_boundary": 1}
    chosen = spark.createDataFrame([("w", 1), ("w", 1), ("v", 99)], "w string, i int")
    assert {r.check_code: r.failed for r in audit.selection_gate(chosen, ["w"], "i", 1, 50).collect()} == {"within_limit": 1, "distinct": 1, "in_range": 1}


def test_contract_problems():
    contract = {"top_k": 100, "postprocessing": {"operator": ">", "nms": False}}
    assert audit.contract_problems(contract, {"top_k": 100, "postprocessing": {"operator": ">", "nms": False}}) == []
    assert audit.contract_problems(contract, {"top_k": 100.0, "postprocessing": {"operator": ">="}, "x": 1}) == ["postprocessing.nms: missing", "postprocessing.operator: '>=' instead of '>'", "top_k: 100.0 instead of 100", "x: unexpected"]


def test_source_order_across_stretches(spark, monkeypatch):
    import random

    monkeypatch.setattr(audit, "ORDER_BLOCK", 7)
    rng = random.Random(3)
    rows, f = [], "a"
    for at in range(300):
        f = rng.choice(["a", "a", "b", "c", None]) if rng.random() < 0.3 else f
        rows.append((f, rng.choice([at, at, at, at - 5, None]), at))
    want: dict = {}
    last: dict = {}
    for i, (name, k, _) in enumerate(rows):
        n, falls, blocks = want.get(name, (0, 0, 0))
        fell = k is not None and last.get(name) is not None and k <= last[name]
        want[name] = (n + 1, falls + fell, blocks + (i == 0 or rows[i - 1][0] != name))
        last[name] = k
    df = spark.createDataFrame(rows, "f string, k int, at int").repartition(5)
    got = {r.f: (r.records, r.not_increasing, r.extra_blocks + 1) for r in audit.source_order(df, "f", "k", "at").collect()}
    assert got == want
    assert audit.source_order(df.limit(0), "f", "k", "at").count() == 0
