"""Checks as queries: each gives (check_code, checked, failed), and ``require`` makes failures fatal."""

from __future__ import annotations

import functools
import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantize import area
from ..scratch import materialized


def check_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row per check: rows seen and rows for which the condition does not hold (a null condition fails)."""
    sums = df.agg(F.count("*").alias("checked"), *[F.count_if(~F.coalesce(c, F.lit(False))).alias(code) for code, c in checks.items()])
    stack = ", ".join(f"'{code}', `{code}`" for code in checks)
    return sums.selectExpr("checked", f"stack({len(checks)}, {stack}) AS (check_code, failed)").select("check_code", "checked", "failed")


def require(report: DataFrame) -> None:
    """Raise with the failed checks, if there are any."""
    failed = report.where("failed > 0").orderBy("check_code").collect()
    if failed:
        raise AssertionError("; ".join(f"{r.check_code}: {r.failed} of {r.checked}" for r in failed))


def record_checks(records: DataFrame, groups: DataFrame) -> DataFrame:
    """Relation rows (with local boxes as l_x0 ...) against their groups: shift, slab, extents, weights, numbering."""
    g = groups.select("group_id", F.col("dx").alias("g_dx"), F.col("dy").alias("g_dy"), F.col("global_min_x").alias("g_lo"), F.col("global_max_x").alias("g_hi"), "r1_start", "r1_count", "r2_start", "r2_count")
    rows = records.join(g, "group_id", "left")
    start = F.when(F.col("side") == "r1", F.col("r1_start")).otherwise(F.col("r2_start"))
    count = F.when(F.col("side") == "r1", F.col("r1_count")).otherwise(F.col("r2_count"))
    c = F.col
    return check_counts(
        rows,
        {
            "known_group": c("g_dx").isNotNull(),
            "unit_weight": c("weight") == 1,
            "nonnegative": (c("x0") >= 0) & (c("y0") >= 0),
            "positive_extent": (c("x0") < c("x1")) & (c("y0") < c("y1")),
            "translation": (c("l_x0") + c("g_dx") == c("x0")) & (c("l_y0") + c("g_dy") == c("y0")) & (c("l_x1") + c("g_dx") == c("x1")) & (c("l_y1") + c("g_dy") == c("y1")),
            "extent_kept": (c("x1") - c("x0") == c("l_x1") - c("l_x0")) & (c("y1") - c("y0") == c("l_y1") - c("l_y0")),
            "inside_slab": (c("x0") >= c("g_lo")) & (c("x1") <= c("g_hi")),
            "inside_slice": (c("record_id") >= start) & (c("record_id") < start + count),
        },
    )


def coordinate_checks(records: DataFrame) -> DataFrame:
    """Relations of one shared group: no coordinate under 1, and 1 reached on both axes."""
    low = records.agg(F.min("x0").alias("low_x"), F.min("y0").alias("low_y"), F.count("*").alias("checked"), F.count_if((F.col("x0") < 1) | (F.col("y0") < 1)).alias("failed"))
    reached = low.select(F.lit("lowest_is_one").alias("check_code"), F.lit(1).cast("long").alias("checked"), F.when((F.col("low_x") == 1) & (F.col("low_y") == 1), 0).otherwise(1).cast("long").alias("failed"))
    return low.select(F.lit("at_least_one").alias("check_code"), "checked", "failed").unionByName(reached)


def measure_checks(pairs: DataFrame) -> DataFrame:
    """Measured pairs: IoU in (0, 1], a positive area, and neither more than the smaller box allows."""
    smaller = F.least(area("a_"), area("b_")).cast("double") / F.lit(1e6)
    return check_counts(pairs, {"iou_range": (F.col("iou") > 0) & (F.col("iou") <= 1), "area_positive": F.col("intersection_area") > 0, "area_within_boxes": F.col("intersection_area") <= smaller})


def frame_counts(rows: DataFrame, declared: DataFrame, sequence: str, frame: str, length: str) -> DataFrame:
    """Per sequence: frames used, the highest, the declared number, and whether all frames are among the declared ones."""
    used = rows.groupBy(sequence).agg(F.count_distinct(frame).alias("frames"), F.max(frame).alias("last_frame"), F.min(frame).alias("first_frame"))
    ok = (F.col("first_frame") >= 1) & (F.col("last_frame") <= F.col(length))
    return declared.join(used, sequence, "full_outer").select(sequence, length, F.coalesce("frames", F.lit(0)).cast("long").alias("frames"), "last_frame", F.coalesce(ok, F.col("frames").isNull() & F.col(length).isNotNull()).alias("ok"))


def group_checks(groups: DataFrame, totals: DataFrame) -> DataFrame:
    """The groups table against itself: numbering, slices as running sums, disjoint slabs, states.

    ``totals``: one row (r1, r2, n_groups), the sizes of the tables. Neighbours meet by an equi-join on group_id.
    """
    before = groups.select((F.col("group_id") + 1).alias("group_id"), *[F.col(x).alias(f"p_{x}") for x in ("r1_start", "r1_count", "r2_start", "r2_count", "global_max_x", "semantic_key")])
    sizes = {n: totals.select(n).scalar() for n in ("r1", "r2", "n_groups")}
    rows = groups.join(before, "group_id", "left").withColumns(sizes)
    c = F.col
    first = c("group_id") == 0
    last = c("group_id") == c("n_groups") - 1
    return check_counts(
        rows,
        {
            "numbered": first | c("p_semantic_key").isNotNull(),
            "key_order": first | (c("p_semantic_key") < c("semantic_key")),
            "r1_slices": F.when(first, c("r1_start") == 0).otherwise(c("r1_start") == c("p_r1_start") + c("p_r1_count")),
            "r2_slices": F.when(first, c("r2_start") == 0).otherwise(c("r2_start") == c("p_r2_start") + c("p_r2_count")),
            "r1_total": ~last | (c("r1_start") + c("r1_count") == c("r1")),
            "r2_total": ~last | (c("r2_start") + c("r2_count") == c("r2")),
            "slab_order": first | (c("p_global_max_x") <= c("global_min_x")),
            "state": c("state") == F.when((c("r1_count") > 0) & (c("r2_count") > 0), "both_nonempty").when(c("r1_count") > 0, "r1_only").when(c("r2_count") > 0, "r2_only").otherwise("both_empty"),
        },
    )


def ledger_checks(ledger: DataFrame) -> DataFrame:
    """raw = retained + all excluded, by side."""
    k = F.col("key")
    sides = ledger.groupBy("side").agg(F.sum(F.when(k == "raw", F.col("n"))).alias("raw"), F.sum(F.when(k == "retained", F.col("n"))).alias("retained"), F.sum(F.when(k.startswith("excluded."), F.col("n")).otherwise(0)).alias("excluded"))
    return sides.select("side", "raw", "retained", "excluded", (F.col("raw") == F.col("retained") + F.col("excluded")).alias("balanced"))


#: Rows that are looked at together in order of arrival.
ORDER_BLOCK = 100_000


def source_order(rows: DataFrame, file: str, index: str, arrival: str) -> DataFrame:
    """Per file, in order of arrival: repeats or steps back of the index, and blocks beyond the first.

    ``arrival`` is a total order over all files. A row begins a block if the row before it is of another file. Rows are
    looked at in stretches of ``ORDER_BLOCK``, however many are of one file; what meets at the seams is a row a stretch and file.
    """
    from .ordering import ordered

    placed = ordered(rows.select(file, index, arrival), [arrival], "__place").withColumn("__stretch", F.floor(F.col("__place") / ORDER_BLOCK))
    line, own = Window.partitionBy("__stretch").orderBy("__place"), Window.partitionBy("__stretch", file).orderBy("__place")
    here = F.struct(F.col(file).alias("f"))
    seen = placed.withColumns({"__before": F.lag(here).over(line), "__after": F.lead(here).over(line), "__last": F.lag(index).over(own)})
    parts = seen.groupBy(file, "__stretch").agg(
        F.count("*").alias("records"),
        F.count_if(F.col(index) <= F.col("__last")).alias("falls"),
        F.count_if(F.col("__before").isNotNull() & ~F.col("__before.f").eqNullSafe(F.col(file))).alias("begun"),
        F.min_by(index, "__place").alias("head"),
        F.max_by(index, "__place").alias("tail"),
        F.count_if(F.col("__before").isNull()).alias("opens"),
        F.count_if(F.col("__after").isNull()).alias("closes"),
    )
    parts = materialized(parts, "stretches")
    closing = parts.where("closes = 1").select((F.col("__stretch") + 1).alias("__stretch"), here.alias("closed"))
    parts = parts.join(closing, "__stretch", "left").withColumn("before", F.lag("tail").over(Window.partitionBy(file).orderBy("__stretch")))
    begins = (F.col("opens") == 1) & (F.col("closed").isNull() | ~F.col("closed.f").eqNullSafe(F.col(file)))
    return parts.groupBy(file).agg(
        F.sum("records").alias("records"),
        (F.sum("falls") + F.count_if(F.col("head") <= F.col("before"))).alias("not_increasing"),
        (F.sum("begun") + F.count_if(begins) - 1).alias("extra_blocks"),
    )


def examples(df: DataFrame, code: str, example: Column, n: int = 12) -> DataFrame:
    """(code, n, examples): failures by code with the first n examples in order."""
    ranked = df.select(F.col(code).alias("code"), example.alias("example"))
    w = Window.partitionBy("code").orderBy("example")
    kept = ranked.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n).groupBy("code").agg(F.array_sort(F.collect_list("example")).alias("list"))
    return ranked.groupBy("code").agg(F.count("*").alias("n")).join(kept, "code").select("code", "n", F.array_join("list", ",").alias("examples"))


def ordered_set_hash(df: DataFrame, group: str, line: Column, order: list[str]) -> DataFrame:
    """sha256 over a group's lines in order, for groups of bounded size (a page, a turn list)."""
    rows = df.select(group, F.struct(*order, line.alias("__line")).alias("s"))
    return rows.groupBy(group).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["__line"]), "\n"), 256).alias("set_hash"))


def geometry_checks(rows: DataFrame, source_box: list[Column], box: list[str], centroid: list[Column] | None = None, inside: Column | None = None, tolerance: float = 1e-6) -> DataFrame:
    """Stored boxes against their sources: quantization made anew, and centroids within box and boundary.

    ``source_box``: x0, y0, x1, y1 in source units, as decimals (exact form) or doubles (binary64 form).
    """
    from ..functions.quantize import quantized, quantized_double

    kinds = dict(rows.select(*[c.alias(f"c{i}") for i, c in enumerate(source_box)]).dtypes)
    again = [quantized_double(c) if kinds[f"c{i}"] == "double" else quantized(c) for i, c in enumerate(source_box)]
    checks = {"quantization": (again[0] == F.col(box[0])) & (again[1] == F.col(box[1])) & (again[2] == F.col(box[2])) & (again[3] == F.col(box[3]))}
    if centroid is not None:
        x, y = centroid
        checks["centroid_in_box"] = (x >= source_box[0] - tolerance) & (x <= source_box[2] + tolerance) & (y >= source_box[1] - tolerance) & (y <= source_box[3] + tolerance)
    if inside is not None:
        checks["centroid_in_boundary"] = inside
    return check_counts(rows, checks)


def bounds_checks(groups: DataFrame) -> DataFrame:
    """Occupied groups: slab and shift agree with the local bounds, and the lowest y maps to 1."""
    c = F.col
    return check_counts(
        groups.where("r1_count + r2_count > 0"),
        {
            "left_edge": c("local_min_x") + c("dx") == c("global_min_x"),
            "right_edge": c("local_max_x") + c("dx") == c("global_max_x"),
            "lowest_y": c("local_min_y") + c("dy") == 1,
            "ordered_bounds": (c("local_min_x") < c("local_max_x")) & (c("local_min_y") < c("local_max_y")),
        },
    )


def overflow_checks(rows: DataFrame, dx: Column, dy: Column) -> DataFrame:
    """Translations that would leave 64 bits, found without raising."""
    ok = lambda names, d: F.try_add(F.col(names[0]), d).isNotNull() & F.try_add(F.col(names[1]), d).isNotNull()
    return check_counts(rows, {"x_fits": ok(("x0", "x1"), dx), "y_fits": ok(("y0", "y1"), dy)})


def identity_checks(rows: DataFrame, identity: list[str]) -> DataFrame:
    """One row: distinct source identities, how many of them repeat, and the rows that share one."""
    counts = rows.groupBy(*identity).agg(F.count("*").alias("__n"))
    many = F.col("__n") > 1
    return counts.agg(F.count("*").alias("identities"), F.count_if(many).alias("repeated"), F.coalesce(F.sum(F.when(many, F.col("__n"))), F.lit(0)).alias("rows_sharing"))


def category_maps(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    """One row: names on one side only, and ids or names that are not one to one on either side."""
    names = a.select(F.col(name).alias("__n"), F.lit(1).alias("__a")).distinct().join(b.select(F.col(name).alias("__m"), F.lit(1).alias("__b")).distinct(), F.col("__n") == F.col("__m"), "full_outer")
    ambiguous = lambda d, by, of: d.groupBy(by).agg(F.count_distinct(of).alias("__k")).where("__k > 1").agg(F.count("*").alias("__k")).select("__k").scalar()
    out = names.agg(F.count_if(F.col("__b").isNull()).alias("only_a"), F.count_if(F.col("__a").isNull()).alias("only_b"))
    return out.withColumn("ambiguous", ambiguous(a, key, name) + ambiguous(a, name, key) + ambiguous(b, key, name) + ambiguous(b, name, key))


def shard_ranges(shards: DataFrame, source: str, start: str, end: str) -> DataFrame:
    """Per source, over record ranges [start, end] of its shards: gaps, overlaps and empty ranges."""
    w = Window.partitionBy(source).orderBy(start, end)
    rows = shards.withColumn("__before", F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return rows.groupBy(source).agg(
        F.count("*").alias("shards"),
        F.count_if(F.col(start) > F.col("__before") + 1).alias("gaps"),
        F.count_if(F.col(start) <= F.col("__before")).alias("overlaps"),
        F.count_if(F.col(end) < F.col(start)).alias("empty"),
    )


def selection_gate(selected: DataFrame, by: list[str], id_: str, limit: int, total: int) -> DataFrame:
    """Selected ids per window and side: distinct, within [0, total), at most ``limit`` of them."""
    per = selected.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct(id_).alias("different"), F.min(id_).alias("low"), F.max(id_).alias("high"))
    return check_counts(per, {"within_limit": F.col("n") <= limit, "distinct": F.col("n") == F.col("different"), "in_range": (F.col("low") >= 0) & (F.col("high") < total)})


def contract_problems(expected: dict, actual: dict, path: str = "") -> list[str]:
    """Places where a protocol differs from its contract: missing, unexpected or other values, by path."""
    out = []
    for k in sorted({*expected, *actual}):
        at = f"{path}{k}"
        if k not in actual:
            out.append(f"{at}: missing")
        elif k not in expected:
            out.append(f"{at}: unexpected")
        elif isinstance(expected[k], dict) and isinstance(actual[k], dict):
            out += contract_problems(expected[k], actual[k], f"{at}.")
        elif type(expected[k]) is not type(actual[k]) or expected[k] != actual[k]:
            out.append(f"{at}: {actual[k]!r} instead of {expected[k]!r}")
    return out


def _leaves(value: object, path: str) -> list[tuple[str, str]]:
    """(path, JSON text) of all values within a document that hold no others; numbers as they are written."""
    if isinstance(value, dict) and value:
        return [leaf for k, v in value.items() for leaf in _leaves(v, f"{path}.{k}" if path else k)]
    if isinstance(value, list) and value:
        return [leaf for i, v in enumerate(value) for leaf in _leaves(v, f"{path}[{i}]")]
    return [(path, value.text if isinstance(value, _Number) else json.dumps(value, sort_keys=True))]


class _Number:
    def __init__(self, text: str):
        self.text = text


def _found(text: str) -> list[tuple[str, str | None]]:
    """Leaves of a text; of one that is not JSON an empty path and no leaf."""
    try:
        return _leaves(json.loads(text, parse_int=_Number, parse_float=_Number), "")
    except (ValueError, RecursionError):
        return [("", None)]


#: Leaves of short texts, of which many are equal: at most so many texts of so many characters in a worker.
CACHED_TEXTS, CACHED_LENGTH = 1000, 1000
_found_again = functools.lru_cache(CACHED_TEXTS)(_found)


def leaves_of(text: str) -> list[tuple[str, str | None]]:
    return _found_again(text) if len(text) <= CACHED_LENGTH else _found(text)


def document_leaves(docs: DataFrame, key: str, value: str) -> DataFrame:
    """(key, path, leaf) of JSON documents; of a text that is not JSON one row with an empty path and no leaf, of null none."""

    def run(batches):
        for batch in batches:
            keys, paths, leaves = [], [], []
            for k, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if text is None:
                    continue
                found = leaves_of(text)
                keys += [k.as_py()] * len(found)
                paths += [p for p, _ in found]
                leaves += [v for _, v in found]
            yield pa.record_batch([pa.array(keys, batch.schema.field(0).type), pa.array(paths, pa.string()), pa.array(leaves, pa.string())], names=[key, "path", "leaf"])

    return docs.select(key, value).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, path string, leaf string")


def _leaf_differences(expected: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """``document_differences`` by rows of leaves, which are combined before they move: for keys with very many documents."""
    sides = [document_leaves(d, key, value).withColumn("side", F.lit(s)) for d, s in ((expected, 0), (actual, 1))]
    of = lambda s: F.array_sort(F.collect_set(F.when(F.col("side") == s, F.col("leaf"))))
    there = lambda s: F.count_if(F.col("side") == s) > 0
    both = sides[0].unionByName(sides[1]).groupBy(key, "path").agg(of(0).alias("expected"), of(1).alias("actual"), there(0).alias("e"), there(1).alias("a"), F.count_if(F.col("leaf").isNull()).alias("unread"))
    problem = F.when(F.col("unread") > 0, "unreadable").when(~F.col("a"), "missing").when(~F.col("e"), "unexpected").when(F.col("expected") != F.col("actual"), "other")
    text = lambda c: F.when(F.size(c) > 0, F.array_join(c, " | ")).alias(c)
    return both.withColumn("problem", problem).where("problem is not null").select(key, "path", "problem", text("expected"), text("actual"))


def _document_problems(sides: tuple[dict, dict]) -> list[tuple[str, str, str | None, str | None]]:
    """(path, problem, expected, actual) of one document: leaves by path, expected and actual ones."""
    out = []
    for path in {**sides[0], **sides[1]}:
        e, a = (s.get(path) for s in sides)
        if None in (e or ()) or None in (a or ()):
            problem = "unreadable"
        elif e == a:
            continue
        else:
            problem = "missing" if a is None else "unexpected" if e is None else "other"
        text = [" | ".join(sorted(v for v in s or () if v is not None)) if s and s != {None} else None for s in (e, a)]
        out.append((path, problem, *text))
    return out


#: Bytes of documents in a task that compares them.
DOCUMENT_BYTES = 32 << 20


def document_differences(expected: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """(key, path, problem, expected, actual): where JSON documents differ from those they should equal.

    ``problem``: missing, unexpected, or other (also where only the way a number is written differs); ``unreadable``
    where a text is not JSON. Documents with equal or null keys are one document with all their leaves. Texts are sized up
    first; then those of a key meet in a task, sorted by key, and only differences leave it.
    """
    docs = [d.select(key, value, F.lit(s).cast("byte").alias("__side")).where(F.col(value).isNotNull()) for d, s in ((expected, 0), (actual, 1))]
    size = docs[0].unionByName(docs[1]).agg(F.coalesce(F.sum(F.octet_length(value) + F.lit(48)), F.lit(0))).first()[0]
    parts = max(expected.sparkSession.sparkContext.defaultParallelism, -(-size // DOCUMENT_BYTES))
    sorted_docs = docs[0].unionByName(docs[1]).where(F.col(key).isNotNull()).repartition(parts, key).sortWithinPartitions(key)
    names = ("path", "problem", "expected", "actual")

    def run(batches):
        current, sides, kind = None, ({}, {}), None

        def table(rows):
            columns = [pa.array([r[0] for r in rows], kind), *[pa.array([r[i] for r in rows], pa.string()) for i in range(1, 5)]]
            return pa.record_batch(columns, names=[key, *names])

        for batch in batches:
            kind, rows = batch.schema.field(0).type, []
            for k, text, side in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != current and (k == k or current == current):  # a NaN is the key that it was
                    rows += [(current, *p) for p in _document_problems(sides)]
                    current, sides = k, ({}, {})
                for path, leaf in leaves_of(text):
                    sides[side].setdefault(path, set()).add(leaf)
            yield table(rows)
        if kind is not None:
            yield table([(current, *p) for p in _document_problems(sides)])

    schema = T.StructType([T.StructField(key, expected.schema[key].dataType), *[T.StructField(n, T.StringType()) for n in names]])
    unkeyed = _leaf_differences(*[d.where(F.col(key).isNull()) for d in docs], key, value)
    return sorted_docs.mapInArrow(run, schema).unionByName(unkeyed)
