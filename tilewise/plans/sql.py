"""DuckDB SQL with the results of the registered queries."""

import math

from ..functions.geometry import ECCENTRICITY, SEMI_MAJOR
from . import workloads as W

_ALL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
_SIX = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"

#: Boxes of lineitem, quantized: q has all rows with their reason, kept the retained ones.
_BOXES = """
boxes AS (
    SELECT *, CASE WHEN l_linestatus = 'F' THEN 'r1' ELSE 'r2' END AS side, l_suppkey AS supp, CAST(month(l_shipdate) AS INTEGER) AS mon,
           CAST(to_json([CAST(l_suppkey AS VARCHAR), CAST(month(l_shipdate) AS VARCHAR)]) AS VARCHAR) AS semantic_key,
           CAST(l_partkey % 50 AS DECIMAL(28,12)) + CAST(CAST(l_discount AS DECIMAL(12,2)) AS DECIMAL(28,12)) AS x,
           CAST(CAST(l_quantity AS DECIMAL(12,2)) AS DECIMAL(28,12)) AS y,
           CAST(CAST(l_tax AS DECIMAL(12,2)) * 100 AS DECIMAL(28,12)) AS w, CAST(CAST(l_discount AS DECIMAL(12,2)) * 50 AS DECIMAL(28,12)) AS h
    FROM lineitem
), ends AS (
    SELECT *, CAST(round_even(x * 1000, 0) AS BIGINT) AS x0, CAST(round_even(y * 1000, 0) AS BIGINT) AS y0,
           CAST(round_even((x + w) * 1000, 0) AS BIGINT) AS x1, CAST(round_even((y + h) * 1000, 0) AS BIGINT) AS y1 FROM boxes
), q AS (
    SELECT *, CASE WHEN w <= 0 OR h <= 0 THEN 'nonpositive_extent' WHEN x0 >= x1 OR y0 >= y1 THEN 'quantized_degenerate' END AS reason FROM ends
), kept AS (SELECT * FROM q WHERE reason IS NULL)"""

#: The groups table: grp.
_GROUPS = f"""{_BOXES}, agg AS (
    SELECT semantic_key, count(*) FILTER (side = 'r1') AS r1, count(*) FILTER (side = 'r2') AS r2, min(x0) AS mnx, min(y0) AS mny, max(x1) AS mxx, max(y1) AS mxy
    FROM kept GROUP BY semantic_key
), uni AS (SELECT DISTINCT semantic_key FROM boxes), num AS (
    SELECT u.semantic_key, row_number() OVER (ORDER BY u.semantic_key) - 1 AS group_id, coalesce(r1, 0) AS r1_count, coalesce(r2, 0) AS r2_count, mnx, mny, mxx, mxy
    FROM uni u LEFT JOIN agg USING (semantic_key)
), pre AS (
    SELECT *, CAST(1 + coalesce(sum(coalesce(mxx - mnx + 1, 0)) OVER b, 0) AS BIGINT) AS lo, CAST(coalesce(sum(r1_count) OVER b, 0) AS BIGINT) AS r1_start, CAST(coalesce(sum(r2_count) OVER b, 0) AS BIGINT) AS r2_start
    FROM num WINDOW b AS (ORDER BY group_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), grp AS (
    SELECT semantic_key, group_id, r1_count, r2_count, r1_start, r2_start, lo AS global_min_x, lo + coalesce(mxx - mnx, 0) AS global_max_x,
           coalesce(lo - mnx, 0) AS dx, coalesce(1 - mny, 0) AS dy, coalesce(mnx, 0) AS local_min_x, coalesce(mny, 0) AS local_min_y, coalesce(mxx, 0) AS local_max_x, coalesce(mxy, 0) AS local_max_y,
           CASE WHEN r1_count > 0 AND r2_count > 0 THEN 'both_nonempty' WHEN r1_count > 0 THEN 'r1_only' WHEN r2_count > 0 THEN 'r2_only' ELSE 'both_empty' END AS state
    FROM pre
)"""

#: Numbered records with their groups: rec.
_RECORDS = f"""{_GROUPS}, rec AS (
    SELECT k.*, g.group_id, g.dx, g.dy,
           CASE WHEN side = 'r1' THEN g.r1_start ELSE g.r2_start END + row_number() OVER (PARTITION BY k.semantic_key, side ORDER BY {_ALL}) - 1 AS record_id
    FROM kept k JOIN grp g USING (semantic_key)
)"""

_OVERLAP = "a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1"
_AREA = "(least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0))"
_IOU = f"CAST({_AREA} AS DOUBLE) / CAST((a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {_AREA} AS DOUBLE)"

#: Groups with their overlap counts: mass.
_MASS = f"""{_GROUPS}, cnt AS (
    SELECT a.semantic_key, count(*) AS n FROM kept a JOIN kept b ON a.semantic_key = b.semantic_key AND a.side = 'r1' AND b.side = 'r2' AND {_OVERLAP} GROUP BY 1
), mass AS (SELECT grp.*, coalesce(n, 0) AS overlap_count FROM grp LEFT JOIN cnt USING (semantic_key))"""

#: Boxes by the windows that hold their centre: inwin.
_WINDOWS = f"""{_BOXES}, win(win, wx0, wy0, wx1, wy1) AS (VALUES {", ".join(f"('{n}', {a}, {b}, {c}, {e})" for n, a, b, c, e in W.WINDOWS)}), inwin AS (
    SELECT win.win, kept.* FROM kept JOIN win ON x0 + x1 >= 2 * wx0 AND x0 + x1 < 2 * wx1 AND y0 + y1 >= 2 * wy0 AND y0 + y1 < 2 * wy1
)"""

#: Flattened logits: cand.
_SIGMOID = "CASE WHEN logit >= 0 THEN 1e0 / (1e0 + exp(-logit)) ELSE exp(logit) / (1e0 + exp(logit)) END"
_CANDIDATES = f"""flat AS (
    SELECT vec_id, CAST(unnest(range(60)) AS INTEGER) AS idx, CAST(unnest(embedding[1:60]) AS DOUBLE) AS logit FROM embeddings
), cand AS (SELECT vec_id, idx, CAST(idx // {W.LABELS} AS INTEGER) AS query, CAST(idx % {W.LABELS} AS INTEGER) AS label, logit, {_SIGMOID} AS score FROM flat)"""
_TOP = f"""{_CANDIDATES}, top AS (
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, idx) - 1 AS INTEGER) AS rank FROM cand) WHERE rank < {W.TOP_K}
), judged AS (SELECT *, CASE WHEN isnan(score) OR isinf(score) THEN 'nonfinite_score' WHEN score <= {W.THRESHOLD}e0 THEN 'threshold' WHEN label = 0 THEN 'background' END AS reason FROM top)"""

_POINT = "printf('%.6f', {0}) || ' ' || printf('%.6f', {1})"
_P = [_POINT.format(*p) for p in (("lon", "lat"), ("lon + size", "lat"), ("lon + size", "lat + size"), ("lon", "lat + size"))]
#: Footprints, as the workload makes them, with rings: shape.
_FOOTPRINTS = f"""base AS (
    SELECT p_partkey, 34e0 + (p_partkey % 1000) / 100e0 AS lon, -5e0 + (p_partkey % 700) / 60e0 AS lat, p_size / 1000e0 AS size, p_partkey % 40 AS m FROM part
), ringed AS (SELECT *, {" || ', ' || ".join([*_P, _P[0]])} AS ring, {" || ', ' || ".join(_P)} AS open_ring FROM base), foot AS (
    SELECT *, CASE m WHEN 0 THEN 'not a geometry' WHEN 1 THEN 'POINT (' || {_P[0]} || ')' WHEN 2 THEN 'POLYGON EMPTY' WHEN 3 THEN 'POLYGON ((' || open_ring || '))'
                     WHEN 4 THEN 'POLYGON ((' || regexp_replace(ring, '^\\S+', 'NaN') || '))' WHEN 5 THEN 'MULTIPOLYGON (((' || ring || ')))' ELSE 'POLYGON ((' || ring || '))' END AS wkt FROM ringed
), shape AS (
    SELECT *, upper(regexp_extract(wkt, '^\\s*([A-Za-z]+)', 1)) AS kind,
           list_transform(regexp_extract_all(wkt, '\\(([^()]*)\\)', 1), lambda r: list_transform(string_split(r, ','), lambda p: {{'x': TRY_CAST(string_split(trim(p), ' ')[1] AS DOUBLE), 'y': TRY_CAST(string_split(trim(p), ' ')[2] AS DOUBLE)}})) AS rings FROM foot
), good AS (
    SELECT p_partkey, kind, rings[1] AS r FROM shape WHERE kind IN ('POLYGON', 'MULTIPOLYGON') AND len(rings) = 1 AND len(rings[1]) >= 4 AND rings[1][1] = rings[1][-1] AND NOT isnan(rings[1][1].x)
), seg AS (
    SELECT p_partkey, kind, unnest(range(1, len(r))) AS i, r FROM good
), mom AS (
    SELECT p_partkey, any_value(kind) AS kind, sum(r[i].x * r[i + 1].y - r[i + 1].x * r[i].y) AS a,
           sum((r[i].x * r[i + 1].y - r[i + 1].x * r[i].y) * (r[i].x + r[i + 1].x)) AS mx, sum((r[i].x * r[i + 1].y - r[i + 1].x * r[i].y) * (r[i].y + r[i + 1].y)) AS my FROM seg GROUP BY p_partkey
), cen AS (SELECT p_partkey, kind, mx / (3 * a) AS cx, my / (3 * a) AS cy FROM mom)"""


def _inside(x: str, y: str) -> str:
    """Crossing number of the boundary, which no centroid touches."""
    terms = []
    for (ax, ay), (bx, by) in zip(W.BOUNDARY, W.BOUNDARY[1:], strict=False):
        if ay != by:
            terms.append(f"CASE WHEN {y} >= {min(ay, by)}e0 AND {y} < {max(ay, by)}e0 AND {x} < {ax}e0 + ({y} - ({ay}e0)) * ({(bx - ax) / (by - ay)!r}::DOUBLE) THEN 1 ELSE 0 END")
    return f"(({' + '.join(terms)}) % 2 = 1)"


def _laea() -> str:
    e, a = ECCENTRICITY, SEMI_MAJOR
    qp = (1 - e * e) * (1 / (1 - e * e) - math.log((1 - e) / (1 + e)) / (2 * e))
    radius = a * math.sqrt(qp / 2)
    d = a / radius
    return f"""
    WITH base AS (SELECT p_partkey, radians(34e0 + (p_partkey % 1000) / 100e0 - 37.5e0) AS dlon, sin(radians(-5e0 + (p_partkey % 700) / 60e0)) AS s FROM part),
    b AS (SELECT *, asin((({1 - e * e!r}::DOUBLE) * (s / (1 - {e * e!r}::DOUBLE * s * s) - ln((1 - {e!r}::DOUBLE * s) / (1 + {e!r}::DOUBLE * s)) / {2 * e!r}::DOUBLE)) / {qp!r}::DOUBLE) AS beta FROM base),
    k AS (SELECT *, {radius!r}::DOUBLE * sqrt(2 / (1 + cos(beta) * cos(dlon))) AS b FROM b)
    SELECT p_partkey, CAST(round_even(b * {d!r}::DOUBLE * cos(beta) * sin(dlon) * 1000e0, 0) AS BIGINT) AS qx, CAST(round_even(b / {d!r}::DOUBLE * sin(beta) * 1000e0, 0) AS BIGINT) AS qy FROM k"""


ORACLES: dict[str, str] = {
    "quantize_q1000": f"WITH {_BOXES} SELECT side, l_orderkey, l_linenumber, reason, CASE WHEN reason IS NULL THEN x0 END AS x0, CASE WHEN reason IS NULL THEN y0 END AS y0, CASE WHEN reason IS NULL THEN x1 END AS x1, CASE WHEN reason IS NULL THEN y1 END AS y1 FROM q",
    "round_half_even": "SELECT l_orderkey, l_linenumber, CAST(half AS DOUBLE) AS half, CAST(round_even(half, 0) AS BIGINT) AS rounded FROM (SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(12,2)) * 0.5 - 12 AS DECIMAL(20,3)) AS half FROM lineitem)",
    "quantize_binary64": "SELECT l_orderkey, l_linenumber, CAST(round_even((l_extendedprice / 7e0 - 3000e0) * 1000e0, 0) AS BIGINT) AS q FROM lineitem",
    "reject_ledger": f"""
        WITH {_BOXES} SELECT side, 'raw' AS key, count(*) AS n FROM q GROUP BY side
        UNION ALL SELECT side, 'geometry_candidates', count(*) FROM q GROUP BY side
        UNION ALL SELECT side, 'retained', count(*) FROM kept GROUP BY side
        UNION ALL SELECT side, 'excluded.' || reason, count(*) FROM q WHERE reason IS NOT NULL GROUP BY side, reason
        UNION ALL SELECT side, 'negative_local_coordinate', count(*) FILTER (least(x0, y0) < 0) FROM kept GROUP BY side
        UNION ALL SELECT side, 'out_of_bounds_retained', count(*) FILTER (x0 < 1000 OR y0 < 1000 OR x1 > 51000 OR y1 > 51000) FROM kept GROUP BY side""",
    "bounds_flags": f"""
        WITH {_BOXES} SELECT side, count(*) AS retained, count(*) FILTER (x0 < 0 OR y0 < 0 OR x1 > 50000 OR y1 > 50000) AS out_origin_0,
               count(*) FILTER (x0 < 1000 OR y0 < 1000 OR x1 > 51000 OR y1 > 51000) AS out_origin_1, count(*) FILTER (least(x0, y0) < 1000) AS first_pixel FROM kept GROUP BY side""",
    "xyxy_to_xywh": """
        WITH r AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'nan'::DOUBLE ELSE (value + CAST(event_id % 5 AS DOUBLE)) - value END AS w, (CAST(user_id % 17 AS DOUBLE) + 2e0) - CAST(user_id % 17 AS DOUBLE) AS h FROM events)
        SELECT event_id, CASE WHEN isnan(w) THEN 'nonfinite_geometry' WHEN w <= 0 OR h <= 0 THEN 'nonpositive_extent' END AS reason, CASE WHEN NOT isnan(w) THEN round(w, 6) END AS w, CASE WHEN NOT isnan(w) THEN h END AS h FROM r""",
    "cxcywh_to_xyxy": """
        WITH v AS (SELECT vec_id, CAST(abs(embedding[61]) AS FLOAT) AS cx, CAST(abs(embedding[62]) AS FLOAT) AS cy, CAST(abs(embedding[63]) AS FLOAT) AS w, CAST(abs(embedding[64]) AS FLOAT) AS h FROM embeddings)
        SELECT vec_id, round(CAST((cx - 0.5::FLOAT * w) * 640::FLOAT AS DOUBLE), 3) AS x0, round(CAST((cy - 0.5::FLOAT * h) * 480::FLOAT AS DOUBLE), 3) AS y0,
               round(CAST((cx + 0.5::FLOAT * w) * 640::FLOAT AS DOUBLE), 3) AS x1, round(CAST((cy + 0.5::FLOAT * h) * 480::FLOAT AS DOUBLE), 3) AS y1 FROM v""",
    "group_universe": f"WITH {_BOXES} SELECT semantic_key, any_value(supp) AS supp, any_value(mon) AS mon, min(l_orderkey) AS l_orderkey FROM boxes GROUP BY semantic_key",
    "group_numbering": f"WITH {_GROUPS} SELECT semantic_key, group_id FROM grp",
    "record_numbering": f"WITH {_RECORDS} SELECT side, record_id, group_id, {_SIX} FROM rec",
    "source_numbering": f"SELECT row_number() OVER (ORDER BY {_ALL}) - 1 AS n, {_SIX} FROM lineitem",
    "group_bounds": f"WITH {_GROUPS} SELECT semantic_key, r1 AS r1_count, r2 AS r2_count, mnx AS local_min_x, mny AS local_min_y, mxx AS local_max_x, mxy AS local_max_y FROM agg",
    "group_states": f"WITH {_GROUPS} SELECT semantic_key, r1_count, r2_count, state FROM grp",
    "group_state_histogram": f"WITH {_GROUPS} SELECT state, count(*) AS n FROM grp GROUP BY state",
    "group_slices": f"WITH {_GROUPS} SELECT group_id, r1_start, r1_count, r2_start, r2_count FROM grp",
    "slab_packing": f"WITH {_GROUPS} SELECT group_id, dx, dy, global_min_x, global_max_x, local_min_x, local_min_y, local_max_x, local_max_y FROM grp",
    "slab_isolation": f"""
        WITH {_GROUPS}, o AS (SELECT group_id, global_min_x, global_max_x, lag(global_max_x) OVER (ORDER BY group_id) AS previous_max_x FROM grp WHERE r1_count + r2_count > 0)
        SELECT *, coalesce(previous_max_x < global_min_x, true) AS isolated FROM o""",
    "cartesian_total": f"WITH {_GROUPS} SELECT CAST(sum(r1_count * r2_count) AS BIGINT) AS pairs FROM grp",
    "pack_translate": f"WITH {_RECORDS} SELECT side, record_id, group_id, x0 + dx AS x0, y0 + dy AS y0, x1 + dx AS x1, y1 + dy AS y1, CAST(1 AS BIGINT) AS weight FROM rec",
    "unpack_translate": f"WITH {_RECORDS} SELECT side, record_id, x0, y0, x1, y1 FROM rec",
    "national_pack": f"""
        WITH {_BOXES}, a AS (SELECT count(*) FILTER (side = 'r1') AS r1_count, count(*) FILTER (side = 'r2') AS r2_count, min(x0) AS min_x, min(y0) AS min_y, max(x1) AS max_x, max(y1) AS max_y FROM kept)
        SELECT *, 1 - min_x AS dx, 1 - min_y AS dy, CAST(ceil((max_x - min_x) / 1000) AS BIGINT) AS width, CAST(ceil((max_y - min_y) / 1000) AS BIGINT) AS height FROM a""",
    "group_slice": f"""WITH {_RECORDS} SELECT side, record_id, group_id, x0 + dx AS x0, y0 + dy AS y0, x1 + dx AS x1, y1 + dy AS y1 FROM rec WHERE semantic_key = '["7","3"]'""",
    "overlap_count_by_group": f"WITH {_BOXES} SELECT a.supp, count(*) AS overlap_count FROM kept a JOIN kept b ON a.supp = b.supp AND a.side = 'r1' AND b.side = 'r2' AND {_OVERLAP} GROUP BY a.supp",
    "overlap_count_global": f"WITH {_BOXES} SELECT count(*) AS overlap_count FROM (SELECT * FROM kept WHERE side = 'r1') a JOIN (SELECT * FROM kept WHERE side = 'r2') b ON {_OVERLAP}",
    "overlap_pairs_grid": f"WITH {_BOXES} SELECT a.mon, count(*) AS overlap_count, count(*) FILTER (a.supp = b.supp) AS same_supplier, round(CAST(sum({_AREA}) AS DOUBLE) / 1e6, 3) AS area FROM kept a JOIN kept b ON a.mon = b.mon AND a.side = 'r1' AND b.side = 'r2' AND {_OVERLAP} GROUP BY a.mon",
    "pair_area_iou": f"""
        WITH {_BOXES}, p AS (
            SELECT a.semantic_key, a.x0 AS a_x0, a.y0 AS a_y0, a.x1 AS a_x1, a.y1 AS a_y1, b.x0 AS b_x0, b.y0 AS b_y0, b.x1 AS b_x1, b.y1 AS b_y1, round(CAST({_AREA} AS DOUBLE) / 1e6, 6) AS intersection_area, round({_IOU}, 9) AS iou
            FROM kept a JOIN kept b ON a.semantic_key = b.semantic_key AND a.side = 'r1' AND b.side = 'r2' AND {_OVERLAP}
        ), n AS (SELECT *, row_number() OVER (PARTITION BY semantic_key ORDER BY a_x0, a_y0, a_x1, a_y1, b_x0, b_y0, b_x1, b_y1) AS nth FROM p)
        SELECT * EXCLUDE (nth) FROM n WHERE nth <= 5000""",
    "mass_summary": f"""
        WITH {_MASS} SELECT count(*) AS groups, count(*) FILTER (overlap_count > 0) AS positive, count(*) FILTER (overlap_count = 0) AS zero, CAST(sum(overlap_count) AS BIGINT) AS overlaps,
               max(greatest(global_max_x, local_max_y + dy)) AS max_coordinate FROM mass""",
    "group_size_quantiles": f"""
        WITH {_GROUPS} SELECT {", ".join(f"round(quantile_cont(CAST({s}_count AS DOUBLE), {p}), 6) AS {s}_{n}" for s in ("r1", "r2") for n, p in (("min", 0.0), ("median", 0.5), ("p95", 0.95), ("max", 1.0)))} FROM grp""",
    "window_membership": f"WITH {_WINDOWS} SELECT win, side, count(*) AS n FROM inwin GROUP BY win, side",
    "window_overlap_stats": f"""
        WITH {_WINDOWS}, w AS (SELECT *, row_number() OVER () AS rid FROM inwin), p AS (
            SELECT a.win, a.rid AS ar, b.rid AS br, {_IOU} AS iou, md5(concat_ws('|', 'tilewise', a.x0, a.y0, a.x1, a.y1, b.x0, b.y0, b.x1, b.y1)) AS priority
            FROM w a JOIN w b ON a.win = b.win AND a.side = 'r1' AND b.side = 'r2' AND {_OVERLAP}
        ), few AS (
            SELECT win, round(quantile_cont(iou, 0.05), 6) AS iou_p05, round(quantile_cont(iou, 0.5), 6) AS iou_p50, round(quantile_cont(iou, 0.95), 6) AS iou_p95
            FROM (SELECT win, iou, row_number() OVER (PARTITION BY win ORDER BY priority) AS nth FROM p) WHERE nth <= 5000 GROUP BY win
        ), s AS (
            SELECT win, count(*) AS pairs, round(min(iou), 6) AS iou_min, round(max(iou), 6) AS iou_max, round(avg(iou), 6) AS iou_mean, count(DISTINCT ar) AS h1, count(DISTINCT br) AS h2 FROM p GROUP BY win
        ), c AS (SELECT win, count(*) FILTER (side = 'r1') AS r1_count, count(*) FILTER (side = 'r2') AS r2_count FROM w GROUP BY win)
        SELECT win, r1_count, r2_count, pairs, iou_min, iou_max, iou_mean, iou_p05, iou_p50, iou_p95, r1_count - coalesce(h1, 0) AS r1_no_overlap, r2_count - coalesce(h2, 0) AS r2_no_overlap FROM c LEFT JOIN s USING (win) LEFT JOIN few USING (win)""",
    "multiset_intersection": f"WITH {_BOXES} SELECT count(*) AS shared FROM (SELECT x0, y0, x1, y1 FROM kept WHERE side = 'r1' INTERSECT ALL SELECT x0, y0, x1, y1 FROM kept WHERE side = 'r2')",
    "duplicate_geometry": f"WITH {_BOXES}, g AS (SELECT side, supp, x0, y0, x1, y1, count(*) AS n FROM kept GROUP BY ALL) SELECT side, count(*) AS distinct_boxes, CAST(sum(n - 1) AS BIGINT) AS repeated FROM g GROUP BY side",
    "coverage_full_outer": """
        WITH a AS (SELECT doc_id, doc_id % 7 AS size FROM documents), b AS (SELECT CASE WHEN doc_id % 11 = 0 THEN doc_id + 100000000 ELSE doc_id END AS doc_id, CASE WHEN doc_id % 5 = 0 THEN -1 ELSE doc_id % 7 END AS size FROM labels)
        SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'missing_in_b' WHEN a.doc_id IS NULL THEN 'missing_in_a' WHEN a.size = b.size THEN 'matched' ELSE 'disagreeing' END AS status FROM a FULL JOIN b ON a.doc_id = b.doc_id""",
    "orphan_antijoin": """
        SELECT 'all' AS parents, count(*) AS orphans, count(DISTINCT l_orderkey) AS keys FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL SELECT 'some', count(*), count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')""",
    "category_lookup": "SELECT coalesce(r_name, 'unknown') AS region, coalesce(n_name, 'unknown') AS nation, count(*) AS customers FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL",
    "selected_semijoin": """
        WITH c AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
        SELECT 'selected' AS part, count(*) AS n FROM orders WHERE o_custkey IN (FROM c) UNION ALL SELECT 'unselected', count(*) FROM orders WHERE o_custkey NOT IN (FROM c)""",
    "completeness_check": """
        WITH e AS (SELECT doc_id FROM documents WHERE lang <> 'de'), a AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY doc_id)
        SELECT 'missing' AS problem, count(*) AS n FROM e WHERE doc_id NOT IN (SELECT doc_id FROM a)
        UNION ALL SELECT 'unexpected', count(*) FROM a WHERE doc_id NOT IN (FROM e) UNION ALL SELECT 'repeated', count(*) FROM a WHERE n > 1""",
    "layer_pairing": """
        WITH r AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) FILTER (o_orderstatus = 'F') AS l0, count(*) FILTER (o_orderstatus = 'O') AS l1 FROM orders GROUP BY ALL)
        SELECT CASE WHEN l0 > 1 OR l1 > 1 THEN 'ambiguous' WHEN l0 = 1 AND l1 = 1 THEN 'paired' WHEN l0 = 1 THEN 'only_0' WHEN l1 = 1 THEN 'only_1' ELSE 'neither' END AS status, count(*) AS n, CAST(sum(l0) AS BIGINT) AS layer_0, CAST(sum(l1) AS BIGINT) AS layer_1 FROM r GROUP BY 1""",
    "reconcile_full_outer": """
        WITH e AS (SELECT l_orderkey, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity, max(l_linestatus) AS status FROM lineitem GROUP BY 1),
        a AS (SELECT CASE WHEN l_orderkey % 23 = 0 THEN -l_orderkey - 1 ELSE l_orderkey END AS l_orderkey, CASE WHEN l_orderkey % 29 = 0 THEN n + 1 ELSE n END AS n, CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE quantity END AS quantity, status FROM e WHERE quantity <> 30),
        j AS (SELECT e.l_orderkey AS ek, a.l_orderkey AS ak, e.n IS DISTINCT FROM a.n AS dn, e.quantity IS DISTINCT FROM a.quantity AS dq, e.status IS DISTINCT FROM a.status AS ds FROM e FULL JOIN a ON e.l_orderkey = a.l_orderkey)
        SELECT * FROM (SELECT 'missing' AS outcome, count(*) AS n FROM j WHERE ak IS NULL UNION ALL SELECT 'unexpected', count(*) FROM j WHERE ek IS NULL
        UNION ALL SELECT 'equal', count(*) FROM j WHERE ak = ek AND NOT (dn OR dq OR ds) UNION ALL SELECT 'differs.n', count(*) FROM j WHERE ak = ek AND dn
        UNION ALL SELECT 'differs.quantity', count(*) FROM j WHERE ak = ek AND dq UNION ALL SELECT 'differs.status', count(*) FROM j WHERE ak = ek AND ds) WHERE n > 0""",
    "lock_reconcile": """
        WITH j AS (SELECT page_id % 10 = 0 AS ds, page_id % 15 = 0 AND sha256(html) <> upper(sha256(html)) AS dh FROM pages)
        SELECT * FROM (SELECT 'equal' AS outcome, count(*) AS n FROM j WHERE NOT ds AND NOT dh UNION ALL SELECT 'differs.size', count(*) FROM j WHERE ds UNION ALL SELECT 'differs.sha', count(*) FROM j WHERE dh) WHERE n > 0""",
    "source_lookup": "SELECT l_orderkey, count(*) AS lines, min(l_linenumber) AS first_line, max(l_linenumber) AS last_line FROM lineitem WHERE l_orderkey IN (SELECT item_id * 37 FROM benchmark) GROUP BY l_orderkey",
    "metadata_alignment": f"""
        WITH {_RECORDS} SELECT side, CASE WHEN x1 - x0 = 2000 THEN 'no_array_row' WHEN record_id % 211 = 5 THEN 'group_differs' ELSE 'aligned' END AS status, count(*) AS n FROM rec GROUP BY ALL""",
    "dedup_consistency": "SELECT l_partkey, count(*) AS entries, count(DISTINCT (l_suppkey, l_returnflag)) AS versions, count(DISTINCT (l_suppkey, l_returnflag)) = 1 AS consistent FROM lineitem GROUP BY l_partkey HAVING count(*) > 1",
    "image_counts": f"""
        WITH {_BOXES}, c AS (SELECT supp, count(*) FILTER (side = 'r1') AS r1_raw, count(*) FILTER (side = 'r2') AS r2_raw, count(*) FILTER (side = 'r1' AND reason IS NULL) AS r1_retained, count(*) FILTER (side = 'r2' AND reason IS NULL) AS r2_retained FROM q GROUP BY supp)
        SELECT *, r1_raw = 0 AND r2_raw = 0 AS no_raw_on_both, r1_retained = 0 AND r2_retained = 0 AS no_retained_on_both FROM c""",
    "class_counts": f"WITH {_BOXES} SELECT side, l_returnflag AS class, count(*) AS n FROM kept GROUP BY ALL",
    "crowd_filter": f"""
        WITH {_BOXES}, r AS (SELECT side, CASE WHEN l_linenumber = 7 THEN 'invalid_iscrowd' WHEN l_linenumber = 6 THEN 'crowd' ELSE reason END AS reason FROM q)
        SELECT side, 'raw' AS key, count(*) AS n FROM r GROUP BY side UNION ALL SELECT side, 'retained', count(*) FILTER (reason IS NULL) FROM r GROUP BY side
        UNION ALL SELECT side, 'geometry_candidates', count(*) FILTER (reason IS NULL OR reason NOT IN ('crowd', 'invalid_iscrowd')) FROM r GROUP BY side
        UNION ALL SELECT side, 'excluded.' || reason, count(*) FROM r WHERE reason IS NOT NULL GROUP BY side, reason""",
    "sigmoid_topk": f"WITH {_TOP} SELECT vec_id, rank, query, label, round(score, 9) AS score, reason FROM judged",
    "topk_tie_audit": f"""
        WITH {_CANDIDATES}, c AS (SELECT vec_id, idx, CAST(floor(logit * 20) AS INTEGER) AS coarse FROM cand), n AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY coarse DESC, idx) AS nth FROM c),
        k AS (SELECT vec_id, coarse AS boundary FROM n WHERE nth = {W.TOP_K})
        SELECT vec_id, boundary, count(*) FILTER (coarse > boundary) AS above, count(*) FILTER (coarse = boundary) AS equal, count(*) FILTER (coarse >= boundary) > {W.TOP_K} AS ambiguous FROM c JOIN k USING (vec_id) GROUP BY vec_id, boundary""",
    "rank_order_check": f"""
        WITH {_TOP}, b AS (SELECT vec_id, query, label, score, CASE WHEN vec_id % 50 = 0 AND rank = 3 THEN 4 ELSE rank END AS rank FROM top),
        l AS (SELECT *, lag(rank) OVER w AS br, lag(score) OVER w AS bs FROM b WINDOW w AS (PARTITION BY vec_id ORDER BY rank, query, label))
        SELECT vec_id, count(*) AS predictions, count(*) FILTER (rank <= br) AS rank_not_increasing, count(*) FILTER (score > bs) AS score_increasing, count(*) - count(DISTINCT (query, label)) AS repeated_pairs FROM l GROUP BY vec_id""",
    "candidate_accounting": f"""
        WITH {_TOP} SELECT vec_id, count(*) FILTER (reason = 'nonfinite_score') AS nonfinite, count(*) FILTER (reason = 'threshold') AS threshold, count(*) FILTER (reason = 'background') AS background,
               count(*) FILTER (reason IS NULL) AS exported, count(*) = {W.TOP_K} AS balanced FROM judged GROUP BY vec_id""",
    "mot_style_filter": """
        WITH r AS (SELECT *, CAST(ts AS DATE) AS day, CASE WHEN TRY_CAST(props::JSON ->> '$.k' AS INTEGER) % 4 = 0 THEN 'gt_invalid_flag' WHEN event_type NOT IN ('click', 'view') THEN 'gt_non_pedestrian' WHEN isnan(value) OR isinf(value) THEN 'nonfinite_score' END AS reason FROM events)
        SELECT event_type, coalesce(reason, 'retained') AS outcome, count(*) AS n, count(DISTINCT (user_id, day)) AS frames, round(min(value), 6) AS score_min, round(max(value), 6) AS score_max FROM r GROUP BY ALL""",
    "field_count_histogram": "SELECT CAST(len(string_split(line, ',')) AS INTEGER) AS fields, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1",
    "invariants_records": f"""
        WITH {_RECORDS}, n AS (SELECT count(*) AS checked, count(*) FILTER (record_id % 997 = 5) AS bad FROM rec)
        SELECT unnest(['known_group', 'unit_weight', 'nonnegative', 'positive_extent', 'translation', 'extent_kept', 'inside_slab', 'inside_slice']) AS check_code, checked, unnest([0, bad, 0, 0, 0, 0, 0, 0]) AS failed FROM n""",
    "invariants_groups": f"""
        WITH {_GROUPS} SELECT unnest(['numbered', 'key_order', 'r1_slices', 'r2_slices', 'r1_total', 'r2_total', 'slab_order', 'state']) AS check_code, checked, CAST(0 AS BIGINT) AS failed FROM (SELECT count(*) AS checked FROM grp)""",
    "invariants_ledger": f"WITH {_BOXES} SELECT side, count(*) AS raw, count(*) FILTER (reason IS NULL) AS retained, count(*) FILTER (reason IS NOT NULL) AS excluded, true AS balanced FROM q GROUP BY side",
    "invariants_quantization": f"WITH {_BOXES} SELECT 'quantization' AS check_code, count(*) AS checked, count(*) FILTER (l_quantity = 17) AS failed FROM kept",
    "invariants_bounds": f"WITH {_GROUPS} SELECT unnest(['left_edge', 'right_edge', 'lowest_y', 'ordered_bounds']) AS check_code, checked, CAST(0 AS BIGINT) AS failed FROM (SELECT count(*) AS checked FROM grp WHERE r1_count + r2_count > 0)",
    "invariants_overflow": f"""
        WITH {_BOXES}, n AS (SELECT count(*) AS checked, count(*) FILTER (x1 > 40000) AS fx, count(*) FILTER (y1 > 40000) AS fy FROM kept)
        SELECT unnest(['x_fits', 'y_fits']) AS check_code, checked, unnest([fx, fy]) AS failed FROM n""",
    "invariants_identity": "WITH c AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) SELECT count(*) AS identities, count(*) FILTER (n > 1) AS repeated, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_sharing FROM c",
    "category_map_agreement": """
        WITH a AS (SELECT DISTINCT n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name <> 'FRANCE'), b AS (SELECT DISTINCT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
        SELECT (SELECT count(*) FROM a WHERE n_name NOT IN (FROM b)) AS only_a, (SELECT count(*) FROM b WHERE n_name NOT IN (FROM a)) AS only_b, CAST(0 AS BIGINT) AS ambiguous""",
    "shard_contiguity": """
        WITH s AS (SELECT o_orderpriority, o_orderkey // 250 AS shard, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders GROUP BY ALL),
        l AS (SELECT *, lag(last) OVER (PARTITION BY o_orderpriority ORDER BY shard) AS before FROM s)
        SELECT o_orderpriority, count(*) AS shards, count(*) FILTER (first > before + 1) AS gaps, count(*) FILTER (first <= before) AS overlaps, CAST(0 AS BIGINT) AS empty FROM l GROUP BY o_orderpriority""",
    "selection_gate": f"""
        WITH {_WINDOWS}, c AS (SELECT win, side, l_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY win, side ORDER BY {_ALL}) AS nth FROM inwin) WHERE nth <= 10),
        p AS (SELECT count(*) AS n, count(DISTINCT l_orderkey) AS d FROM c GROUP BY win, side), t AS (SELECT count(*) AS checked, count(*) FILTER (n <> d) AS bad FROM p)
        SELECT unnest(['within_limit', 'distinct', 'in_range']) AS check_code, checked, unnest([0, bad, 0]) AS failed FROM t""",
    "check_ledger": f"""
        WITH {_BOXES}, f AS (SELECT side || '.' || reason AS code, printf('%010d-%02d-%010d-%s', l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)) AS example FROM q WHERE reason IS NOT NULL),
        n AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY example) AS nth FROM f)
        SELECT code, count(*) AS n, string_agg(example, ',' ORDER BY example) FILTER (nth <= 12) AS examples FROM n GROUP BY code""",
    "source_order_check": """
        WITH p AS (SELECT conv_id AS file, turn AS idx, lag(turn) OVER (PARTITION BY conv_id ORDER BY CASE WHEN conv_id % 3 = 0 THEN -turn ELSE turn END, turn) AS before FROM conversations)
        SELECT file, count(*) AS records, count(*) FILTER (idx <= before) AS not_increasing, CAST(0 AS BIGINT) AS extra_blocks FROM p GROUP BY file""",
    "lowest_ids_per_window": f"WITH {_WINDOWS} SELECT win, side, CAST(nth AS INTEGER) AS nth, l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY win, side ORDER BY {_ALL}) AS nth FROM inwin) WHERE nth <= 10",
    "evenly_spaced_groups": f"""
        WITH {_GROUPS}, o AS (SELECT group_id, semantic_key, row_number() OVER (ORDER BY group_id) - 1 AS place, count(*) OVER () AS n FROM grp WHERE state = 'both_nonempty')
        SELECT place, group_id, semantic_key FROM o WHERE place IN (0, (n - 1) // 2, n - 1)""",
    "priority_sample": f"WITH {_MASS} SELECT semantic_key, overlap_count, md5('tilewise|' || semantic_key) AS priority FROM mass WHERE overlap_count > 0 ORDER BY priority, semantic_key LIMIT 20",
    "first_n_per_source": "SELECT source, doc_id, lang, CAST(nth AS INTEGER) AS nth FROM (SELECT source, doc_id, lang, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS nth FROM documents) WHERE nth <= 5",
    "ordered_set_hash": "SELECT conv_id, sha256(string_agg(turn || ':' || role || ':' || sha256(text), chr(10) ORDER BY turn)) AS set_hash FROM conversations GROUP BY conv_id",
    "content_hash": "SELECT page_id, sha256(html) AS sha256, md5(html) AS md5, CAST(octet_length(encode(html)) AS BIGINT) AS size FROM pages",
    "guard_regex": """
        SELECT page_id, regexp_full_match(CASE WHEN page_id % 9 = 0 THEN upper(sha256(url)) WHEN page_id % 10 = 0 THEN substring(sha256(url), 1, 63) ELSE sha256(url) END, '[0-9a-f]{64}') AS digest_ok,
               TRY_CAST(regexp_extract(url, '/(\\d+)', 1) AS INTEGER) AS number FROM pages""",
    "group_key_json": """SELECT s_suppkey, CAST(to_json([CAST(s_suppkey AS VARCHAR), s_name || ' "é"']) AS VARCHAR) AS group_key FROM supplier""",
    "url_file_identity": "SELECT page_id, nullif(regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)/*$', 1), '') AS file FROM pages",
    "scan_json_props": "WITH e AS (SELECT event_type, TRY_CAST(props::JSON ->> '$.k' AS INTEGER) AS k FROM events) SELECT event_type, count(*) AS n, count(k) AS with_k, min(k) AS k_min, max(k) AS k_max, CAST(sum(k) AS BIGINT) AS k_sum FROM e GROUP BY event_type",
    "laea_project": _laea(),
    "wkt_bounds": f"""
        WITH {_FOOTPRINTS} SELECT p_partkey, round(list_min(list_transform(rings[1], lambda p: p.x)), 6) AS min_x, round(list_min(list_transform(rings[1], lambda p: p.y)), 6) AS min_y,
               round(list_max(list_transform(rings[1], lambda p: p.x)), 6) AS max_x, round(list_max(list_transform(rings[1], lambda p: p.y)), 6) AS max_y
        FROM shape WHERE kind IN ('POLYGON', 'MULTIPOLYGON') AND len(rings) > 0 AND NOT list_bool_or(list_transform(rings[1], lambda p: isnan(p.x)))""",
    "wkt_reject_cascade": f"""
        WITH {_FOOTPRINTS} SELECT p_partkey, CASE m WHEN 0 THEN 'malformed_geometry' WHEN 1 THEN 'unsupported_geometry_type' WHEN 2 THEN 'empty_geometry' WHEN 3 THEN 'invalid_geometry' WHEN 4 THEN 'invalid_geometry'
               ELSE CASE WHEN NOT {_inside("cx", "cy")} THEN 'centroid_outside_country' END END AS reason
        FROM shape LEFT JOIN cen USING (p_partkey)""",
    "polygon_centroid": f"WITH {_FOOTPRINTS} SELECT p_partkey, round(cx, 6) AS cx, round(cy, 6) AS cy FROM cen WHERE kind = 'POLYGON'",
    "centroid_in_boundary": f"WITH {_FOOTPRINTS} SELECT p_partkey, {_inside('cx', 'cy')} AS inside FROM cen",
    "loader_roundtrip": f"WITH {_RECORDS} SELECT side, count(*) AS n, CAST(sum(x0 + dx) AS BIGINT) AS sum_x0, CAST(sum(y1 + dy) AS BIGINT) AS sum_y1, max(record_id) AS last_id, count(*) AS weight FROM rec GROUP BY side",
}
ORACLES["weighted_pair_draws"] = f"""
    WITH {_BOXES}, p AS (
        SELECT a.semantic_key, a.x0 AS ax0, a.y0 AS ay0, a.x1 AS ax1, a.y1 AS ay1, b.x0 AS bx0, b.y0 AS by0, b.x1 AS bx1, b.y1 AS by1, CAST({_AREA} AS DOUBLE) / 1e6 AS area
        FROM kept a JOIN kept b ON a.semantic_key = b.semantic_key AND a.side = 'r1' AND b.side = 'r2' AND {_OVERLAP}
    ), m AS (SELECT *, CAST(round(area * 1e9) AS HUGEINT) AS mass FROM p), c AS (
        SELECT *, sum(mass) OVER (ORDER BY semantic_key, ax0, ay0, ax1, ay1, bx0, by0, bx1, by1 ROWS UNBOUNDED PRECEDING) AS mass_end FROM m
    ), d AS (SELECT id, CAST(floor((id * 7919 % 10007) / 10007e0 * (SELECT CAST(sum(mass) AS DOUBLE) FROM m)) AS HUGEINT) AS target FROM range(10000) r(id))
    SELECT id, semantic_key, round(area, 6) AS intersection_area FROM d JOIN c ON target >= mass_end - mass AND target < mass_end"""
ORACLES["overlap_count_sweep"] = ORACLES["overlap_count_by_group"]


def _half_even(v: str) -> str:
    """Nearest integer of a thousandfold decimal, ties to even, without floating point."""
    t = f"(CAST({v} AS DECIMAL(30,26)) * CAST(1000 AS DECIMAL(4,0)))"
    return f"CAST(floor({t}) + CASE WHEN {t} - floor({t}) > 0.5 OR ({t} - floor({t}) = 0.5 AND CAST(floor({t}) AS BIGINT) % 2 <> 0) THEN 1 ELSE 0 END AS BIGINT)"


def _covered(x0: float, y0: float, x1: float, y1: float) -> str:
    return f"(x BETWEEN {x0} AND {x1} AND y BETWEEN {y0} AND {y1})"


ORACLES |= {
    "corner_boxes_exact": f"""
        WITH t AS (
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST((l_partkey % 50) || '.' || lpad(l_orderkey::VARCHAR, 10, '0') || lpad(l_suppkey::VARCHAR, 16, '0') AS DECIMAL(38,26)) AS x0,
                   CAST(l_linenumber || '.' || lpad(l_partkey::VARCHAR, 26, '0') AS DECIMAL(38,26)) AS y0,
                   CASE WHEN l_linenumber <> 7 THEN CAST((l_partkey % 50 + l_suppkey % 3) || '.' || lpad(l_suppkey::VARCHAR, 10, '0') || lpad(l_orderkey::VARCHAR, 16, '0') AS DECIMAL(38,26)) END AS x1,
                   CAST((l_linenumber + 1) || CASE WHEN l_linenumber % 2 = 0 THEN '.0005' ELSE '.0015' END AS DECIMAL(38,26)) AS y1 FROM lineitem
        ), q AS (SELECT *, {", ".join(f"{_half_even(c)} AS q_{c}" for c in ("x0", "y0", "x1", "y1"))} FROM t), r AS (
            SELECT *, CASE WHEN x1 IS NULL THEN 'nonfinite_geometry' WHEN x1 <= x0 OR y1 <= y0 THEN 'nonpositive_extent' WHEN q_x0 >= q_x1 OR q_y0 >= q_y1 THEN 'quantized_degenerate' END AS reason FROM q
        )
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(x1 - x0 AS VARCHAR) AS w, CASE WHEN x1 IS NOT NULL THEN CAST(y1 - y0 AS VARCHAR) END AS h, reason,
               {", ".join(f"CASE WHEN reason IS NULL THEN q_{c} END AS {c}" for c in ("x0", "y0", "x1", "y1"))} FROM r""",
    "multipolygon_centroid": """
        WITH s AS (SELECT p_partkey, 1e0 + p_partkey % 7 AS a, 1e0 + p_partkey % 5 AS b, p_partkey % 100 AS x, p_partkey % 50 - 20 AS y FROM part)
        SELECT p_partkey, a * a + 15 * b * b AS area, round((a * a * (x + a / 2) + 16 * b * b * (x + 50 + 2 * b) - b * b * (x + 50 + 1.5e0 * b)) / (a * a + 15 * b * b), 6) AS cx,
               round((a * a * (y + a / 2) + 16 * b * b * (y + 2 * b) - b * b * (y + 1.5e0 * b)) / (a * a + 15 * b * b), 6) AS cy, 3 AS rings FROM s""",
    "invalid_ring_cascade": """
        SELECT p_partkey, CASE WHEN p_partkey % 6 <= 2 THEN 'invalid_geometry' END AS reason, CASE WHEN p_partkey % 6 > 2 THEN 36e0 + p_partkey % 5 END AS cx, CASE WHEN p_partkey % 6 > 2 THEN -3e0 END AS cy, p_partkey % 6 > 2 AS inside FROM part""",
    "boundary_union_holes": f"""
        WITH {_FOOTPRINTS}, p AS (SELECT p_partkey, round(lon, 2) AS x, floor(lat * 2) / 2 AS y FROM base)
        SELECT p_partkey, ({_covered(34.0, -5.0, 42.0, 4.0)} AND NOT (x > 36 AND x < 40 AND y > -2 AND y < 3)) OR {_covered(37.0, -1.0, 38.0, 1.0)} OR {_covered(42.0, 0.0, 43.5, 2.0)} AS inside FROM p""",
    "geojson_coordinate_bounds": """
        WITH p AS (SELECT p_partkey, p_partkey % 181 AS x, p_partkey % 89 AS y, p_size FROM part)
        SELECT p_partkey, (x - 3)::DOUBLE AS min_x, least(-y, y)::DOUBLE AS min_y, greatest(x, x + p_size)::DOUBLE AS max_x, (y + 1)::DOUBLE AS max_y FROM p""",
    "projected_cascade": """
        SELECT p_partkey, CASE WHEN p_partkey % 11 = 3 THEN 'nonfinite_source_geometry' WHEN p_partkey % 9 = 4 THEN 'nonfinite_projected_geometry' END AS reason FROM part""",
    "measures_in_range": f"""
        WITH {_BOXES}, p AS (SELECT a.x0 AS ax, b.x0 AS bx FROM kept a JOIN kept b ON a.semantic_key = b.semantic_key AND a.side = 'r1' AND b.side = 'r2' AND {_OVERLAP})
        SELECT 'iou_range' AS check_code, count(*) AS checked, count(*) FILTER (ax = bx) AS failed FROM p UNION ALL SELECT 'area_positive', count(*), 0 FROM p UNION ALL SELECT 'area_within_boxes', count(*), 0 FROM p""",
    "national_coordinates": f"""
        WITH {_BOXES} SELECT 'at_least_one' AS check_code, count(*) AS checked, count(*) FILTER (l_linenumber = 5) AS failed FROM kept
        UNION ALL SELECT 'lowest_is_one', 1, CASE WHEN count(*) FILTER (l_linenumber = 5) > 0 THEN 1 ELSE 0 END FROM kept""",
    "sequence_frames": """
        WITH e AS (SELECT user_id, event_id % 61 AS frame FROM events), u AS (SELECT user_id, count(DISTINCT frame) AS frames, max(frame) AS last_frame, min(frame) AS first_frame FROM e GROUP BY user_id)
        SELECT user_id, CASE WHEN user_id % 7 <> 2 THEN 40 + user_id % 25 END AS length, frames, last_frame, coalesce(first_frame >= 1 AND last_frame <= 40 + user_id % 25, false) AND user_id % 7 <> 2 AS ok FROM u""",
    "centroid_audit": f"""
        WITH {_FOOTPRINTS}, c AS (SELECT p_partkey, {_inside('cx', 'cy')} AS inside FROM cen)
        SELECT 'quantization' AS check_code, count(*) AS checked, 0 AS failed FROM c UNION ALL SELECT 'centroid_in_box', count(*), count(*) FILTER (p_partkey % 40 = 6) FROM c UNION ALL SELECT 'centroid_in_boundary', count(*), count(*) FILTER (NOT inside) FROM c""",
    "schema_gate": "SELECT * FROM (VALUES (5, 'y1', 'y1 bigint', 'y1 int'), (6, 'weight', 'weight bigint', NULL)) v(place, name, want, have)",
    "sampled_quantiles": f"""
        WITH {_BOXES}, n AS (SELECT side, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS size,
            row_number() OVER (PARTITION BY side ORDER BY md5('tilewise|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey), l_orderkey, l_linenumber, l_partkey, l_suppkey) AS nth FROM kept)
        SELECT side, count(*) AS sampled, round(quantile_cont(size, 0.05), 3) AS p05, round(quantile_cont(size, 0.5), 3) AS p50, round(quantile_cont(size, 0.95), 3) AS p95 FROM n WHERE nth <= 1000 GROUP BY side""",
    "exported_against_raw": f"""
        WITH {_TOP}, o AS (SELECT CASE WHEN vec_id % 70 = 1 THEN 'missing' WHEN vec_id % 60 = 2 AND rank = 0 THEN 'moved' WHEN vec_id % 50 = 0 AND rank = 3 THEN 'differs' ELSE 'matched' END AS outcome FROM top)
        SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN outcome = 'moved' THEN unnest(['missing', 'unexpected']) ELSE unnest([outcome]) END AS outcome FROM o) WHERE outcome IS NOT NULL GROUP BY outcome""",
    "images_table": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS content, page_id % 7 <> 0 AS one, page_id % 10 = 3 AS two, page_id % 25 = 4 AS other FROM pages), s AS (
            SELECT *, one::INTEGER + two::INTEGER + other::INTEGER AS n, CASE WHEN other AND NOT (one OR two) THEN 'other' WHEN other AND sha256(content) > sha256('other') THEN 'mixed' ELSE 'content' END AS kind,
                   CASE WHEN NOT (one OR two OR other) THEN 'missing' WHEN other AND (one OR two) THEN 'conflict' WHEN one AND two THEN 'repeated' ELSE 'found' END AS status FROM p
        )
        SELECT status, count(*) AS n, CAST(sum(CASE WHEN n = 0 THEN NULL WHEN other AND NOT (one OR two) THEN 5 WHEN other THEN least(5, octet_length(encode(content))) ELSE octet_length(encode(content)) END) AS BIGINT) AS bytes,
               count(DISTINCT CASE WHEN n = 0 THEN NULL WHEN other AND NOT (one OR two) THEN sha256('other') WHEN other THEN least(sha256('other'), sha256(content)) ELSE sha256(content) END) AS digests FROM s GROUP BY status""",
    "npy_round_trip": f"""
        WITH {_RECORDS} SELECT count(*) AS n, max(record_id) AS last_id, CAST(sum(x0 + dx) AS BIGINT) AS sum_x0, CAST(sum(y1 + dy) AS BIGINT) AS sum_y1, count(*) AS weight FROM rec WHERE side = 'r2'""",
    "page_results_round_trip": """
        WITH e AS (SELECT event_id, event_id // 20 AS page, event_id % 100 AS x0, (event_id % 37) * 125 AS y0, event_id % 4 AS w FROM events),
        r AS (SELECT *, CASE WHEN w = 0 THEN 'nonpositive_extent' WHEN y0 % 2 = 0 THEN 'quantized_degenerate' ELSE 'retained' END AS outcome FROM e)
        SELECT outcome, count(*) AS n, count(DISTINCT page) AS pages, CAST(sum(CASE WHEN outcome = 'retained' THEN x0 * 1000 END) AS BIGINT) AS sum_x0, CAST(sum(CASE WHEN outcome = 'retained' THEN y0 + 1 END) AS BIGINT) AS sum_y1 FROM r GROUP BY outcome""",
}
ORACLES["wkt_parse_errors"] = """
    SELECT p_partkey, CASE m WHEN 9 THEN 'malformed_record' WHEN 0 THEN 'malformed_geometry' WHEN 7 THEN 'malformed_geometry' WHEN 8 THEN 'malformed_geometry' WHEN 10 THEN 'malformed_geometry' WHEN 1 THEN 'unsupported_geometry_type' END AS reason,
           CASE m WHEN 0 THEN 'unknown geometry type NOT' WHEN 7 THEN '2 opening and 1 closing parentheses' WHEN 8 THEN 'a vertex without two numbers' WHEN 10 THEN 'no geometry type' END AS detail
    FROM (SELECT p_partkey, p_partkey % 40 AS m FROM part)"""
ORACLES["polygon_faults"] = """
    WITH c(m, parts, reason, fx, fy) AS (VALUES
        (0, 1, NULL, NULL, NULL), (1, 1, 'Self-intersection', 2, 2), (2, 1, NULL, NULL, NULL), (3, 1, 'Hole lies outside shell', 5, 5), (4, 1, 'Self-intersection', 3, 4), (5, 1, 'Nested holes', 2, 2),
        (6, 2, 'Nested shells', 1, 1), (7, 2, 'Self-intersection', 4, 0), (8, 2, NULL, NULL, NULL), (9, 1, NULL, NULL, NULL), (10, 1, 'Interior is disconnected', 4, 2), (11, 1, 'Ring Self-intersection', 2, 2),
        (12, 1, 'Self-intersection', 2, 0), (13, 1, 'Self-intersection', 0, 0), (14, 1, 'Too few points in geometry component', 0, 0), (15, 2, NULL, NULL, NULL))
    SELECT p_partkey, parts, reason, CAST(fx + p_partkey % 97 AS DOUBLE) AS x, CAST(fy + p_partkey % 31 AS DOUBLE) AS y FROM part JOIN c ON m = p_partkey % 16"""
ORACLES["geometry_texts"] = """
    WITH c(m, form, kind, parts, vertices, record_error, geometry_error, properties) AS (VALUES
        (0, 'wkt', 'POLYGON', 1, 4, NULL, NULL, NULL), (1, 'wkt', NULL, NULL, NULL, NULL, ''','' or '')'' expected but the end found at character 23', NULL),
        (2, 'wkt', NULL, NULL, NULL, NULL, 'the end expected but ''tail'' found at character 45', NULL), (3, 'wkt', NULL, NULL, NULL, NULL, 'a number expected but ''x'' found at character 22', NULL),
        (4, 'wkt', NULL, NULL, NULL, NULL, 'unknown geometry type CIRCLE', NULL), (5, 'wkt', NULL, NULL, NULL, NULL, 'a ring of 3 points at character 16', NULL),
        (6, 'wkt', NULL, NULL, NULL, NULL, 'a ring that is not closed at character 10', NULL), (7, 'wkt', 'POLYGON', 1, 4, NULL, NULL, NULL), (8, 'geojson', 'POLYGON', 1, 4, NULL, NULL, '{}'),
        (9, 'geojson', NULL, NULL, NULL, NULL, 'a position of numbers expected at coordinates[1][0][1]', NULL), (10, 'geojson', NULL, NULL, NULL, 'Nonfinite JSON number: NaN', NULL, NULL),
        (11, 'geojson', NULL, NULL, NULL, 'GeoJSON record is not an object', NULL, NULL), (12, 'geojson', NULL, NULL, NULL, NULL, 'an object expected at geometry', NULL), (13, 'wkt', NULL, NULL, NULL, NULL, NULL, NULL),
        (14, 'wkt', 'MULTIPOINT', NULL, NULL, NULL, NULL, NULL), (15, 'geojson', 'POLYGON', 1, 4, NULL, NULL, '{"a":"é","b":1}'))
    SELECT p_partkey, form, kind, parts, vertices, record_error, geometry_error, CASE m WHEN 8 THEN '' WHEN 15 THEN CAST(p_partkey % 90000 AS VARCHAR) END AS own_id, properties FROM part JOIN c ON m = p_partkey % 16"""
ORACLES["quantize_any_power"] = """
    WITH b AS (SELECT l_orderkey, l_linenumber AS n, l_partkey, (l_partkey % 50 + 1) * 1000 AS k FROM lineitem),
    c AS (SELECT *, CASE n WHEN 7 THEN 'quantized_degenerate' WHEN 6 THEN 'nonpositive_extent' END AS reason,
                 CASE n WHEN 5 THEN 1 WHEN 2 THEN k + 1 WHEN 3 THEN k WHEN 4 THEN k ELSE k + 1 END AS right_edge FROM b)
    SELECT l_orderkey, n AS l_linenumber, l_partkey, reason, CASE WHEN reason IS NULL THEN 0 END AS x0, CASE WHEN reason IS NULL THEN 2000 END AS y0, CASE WHEN reason IS NULL THEN right_edge END AS x1, CASE WHEN reason IS NULL THEN 3500 END AS y1 FROM c"""


def _plane(lon: float, lat: float) -> tuple[float, float]:
    """The projection of one position, in plain arithmetic."""
    e, a = ECCENTRICITY, SEMI_MAJOR
    q = lambda s: (1 - e * e) * (s / (1 - e * e * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
    beta, dlon, radius = math.asin(q(math.sin(math.radians(lat))) / q(1.0)), math.radians(lon - 37.5), a * math.sqrt(q(1.0) / 2)
    b = radius * math.sqrt(2 / (1 + math.cos(beta) * math.cos(dlon)))
    return b * a / radius * math.cos(beta) * math.sin(dlon), b * radius / a * math.sin(beta)


def _plane_sql(lon: str, lat: str) -> tuple[str, str]:
    e, a = ECCENTRICITY, SEMI_MAJOR
    pole = (1 - e * e) * (1 / (1 - e * e) - math.log((1 - e) / (1 + e)) / (2 * e))
    radius, s, dlon = a * math.sqrt(pole / 2), f"sin(radians({lat}))", f"radians({lon} - 37.5e0)"
    beta = f"asin((({1 - e * e!r}::DOUBLE) * ({s} / (1 - {e * e!r}::DOUBLE * {s} * {s}) - ln((1 - {e!r}::DOUBLE * {s}) / (1 + {e!r}::DOUBLE * {s})) / {2 * e!r}::DOUBLE)) / {pole!r}::DOUBLE)"
    b = f"({radius!r}::DOUBLE * sqrt(2 / (1 + cos({beta}) * cos({dlon}))))"
    return f"{b} * {a / radius!r}::DOUBLE * cos({beta}) * sin({dlon})", f"{b} / {a / radius!r}::DOUBLE * sin({beta})"


def _in_plane(x: str, y: str) -> str:
    """Crossing number of the projected boundary."""
    ring = [_plane(*p) for p in W.BOUNDARY]
    terms = [f"CASE WHEN {y} >= {min(ay, by)!r}::DOUBLE AND {y} < {max(ay, by)!r}::DOUBLE AND {x} < {ax!r}::DOUBLE + ({y} - ({ay!r}::DOUBLE)) * ({(bx - ax) / (by - ay)!r}::DOUBLE) THEN 1 ELSE 0 END" for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False) if ay != by]
    return f"(({' + '.join(terms)}) % 2 = 1)"


ORACLES["footprint_cascade"] = f"""
    WITH {_FOOTPRINTS}, v AS (
        SELECT p_partkey, generate_subscripts(rings[1], 1) AS i, unnest(rings[1]) AS p FROM shape WHERE m NOT IN (0, 1, 2, 3, 4, 7, 9, 10)
    ), pl AS (SELECT p_partkey, i, {_plane_sql("p.x", "p.y")[0]} AS x, {_plane_sql("p.x", "p.y")[1]} AS y FROM v), nx AS (
        SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM pl WINDOW w AS (PARTITION BY p_partkey ORDER BY i)
    ), mo AS (
        SELECT p_partkey, sum(x * ny - nx * y) AS a, sum((x * ny - nx * y) * (x + nx)) AS sx, sum((x * ny - nx * y) * (y + ny)) AS sy, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM nx GROUP BY p_partkey
    ), o AS (SELECT shape.p_partkey, m, sx / (3 * a) AS cx, sy / (3 * a) AS cy, x0, y0, x1, y1 FROM shape LEFT JOIN mo USING (p_partkey)), r AS (
        SELECT *, CASE WHEN m = 10 THEN 'malformed_record' WHEN m IN (0, 3, 9) THEN 'malformed_geometry' WHEN m = 1 THEN 'unsupported_geometry_type' WHEN m = 2 THEN 'empty_geometry' WHEN m IN (4, 7) THEN 'invalid_geometry'
                       WHEN NOT {_in_plane("cx", "cy")} THEN 'centroid_outside_country' END AS reason FROM o
    )
    SELECT p_partkey, reason, {", ".join(f"CASE WHEN reason IS NULL THEN CAST(round_even({c} * 1000e0, 0) AS BIGINT) END AS {c}" for c in ("x0", "y0", "x1", "y1"))} FROM r"""


def _sized(name: str, key: str, step: int) -> str:
    return f"""SELECT k, x AS x0, y AS y0, x + side AS x1, y + side AS y1 FROM (
        SELECT {key} AS k, ({key} * {step} % 1000003) * 1000 - 300000000 AS x, ({key} * {step + 12} % 999983) * 1000 - 300000000 AS y, CAST(1 AS BIGINT) << CAST({key} * 7 % 31 AS INTEGER) AS side FROM {name})"""


ORACLES["pairs_of_all_sizes"] = f"""
    WITH a AS ({_sized("customer", "c_custkey", 7919)}), b AS ({_sized("supplier", "s_suppkey", 104729)}), p AS (
        SELECT a.k AS k, b.k AS bk, CAST(least(a.x1, b.x1) - greatest(a.x0, b.x0) AS HUGEINT) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS i,
               CAST(a.x1 - a.x0 AS HUGEINT) * (a.y1 - a.y0) AS s, CAST(b.x1 - b.x0 AS HUGEINT) * (b.y1 - b.y0) AS t FROM a JOIN b ON {_OVERLAP}
    )
    SELECT k, count(*) AS n, min(bk) AS first, round(max(CAST(i AS DOUBLE) / CAST(s + t - i AS DOUBLE)), 9) AS iou FROM p GROUP BY k"""
ORACLES["tie_aware_exports"] = f"""
    WITH {_CANDIDATES}, r AS (SELECT vec_id, idx, query, label, CAST(CAST(round(score, 2) AS FLOAT) AS DOUBLE) AS score FROM cand), s AS (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, idx DESC) - 1 AS rank, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC) AS nth FROM r
    ), cut AS (SELECT vec_id, min(score) AS cut FROM s WHERE nth <= {W.TOP_K} GROUP BY vec_id), e AS (
        SELECT s.*, row_number() OVER (PARTITION BY vec_id ORDER BY rank) = 1 AS first, score > cut AS mandatory FROM s JOIN cut USING (vec_id) WHERE rank < {W.TOP_K} AND score > {W.THRESHOLD}e0 AND label <> 0
    ), all_mandatory AS (
        SELECT count(*) AS n FROM s JOIN cut USING (vec_id) WHERE score > cut AND score > {W.THRESHOLD}e0 AND label <> 0
    ), t AS (
        SELECT count(*) FILTER (NOT (first AND vec_id % 11 = 1)) + count(*) FILTER (first AND vec_id % 11 = 6) AS sent, count(*) FILTER (first AND vec_id % 11 = 5) AS moved,
               count(*) FILTER (first AND vec_id % 11 = 2) AS ranks, count(*) FILTER (first AND vec_id % 11 = 3) AS scores, count(*) FILTER (first AND vec_id % 11 = 4) AS places, count(*) FILTER (first AND vec_id % 11 = 6) AS twice,
               count(*) FILTER (first AND mandatory AND vec_id % 11 IN (1, 5)) AS gone, count(*) FILTER (first AND mandatory AND vec_id % 11 = 6) AS again FROM e
    ), keys AS (SELECT count(DISTINCT vec_id) AS n FROM r)
    SELECT unnest(['known_candidate', 'allowed_candidate', 'rank_in_interval', 'score', 'filter', 'mandatory_exported', 'coordinate_x0', 'unique_candidate', 'unique_rank', 'free_choice']) AS check_code,
           unnest([sent, sent - moved, sent - moved, sent - moved, sent - moved, all_mandatory.n + again, sent - moved, sent, sent, keys.n]) AS checked,
           unnest([moved, 0, ranks, scores, 0, gone, places, twice, twice, 0]) AS failed FROM t, all_mandatory, keys"""
ORACLES["array_at_offsets"] = f"""
    WITH {_RECORDS} SELECT count(*) AS n, max(record_id) AS last_id, CAST(sum(x0 + dx) AS BIGINT) AS sum_x0, CAST(sum((record_id + 1) * ((y1 + dy) % 1009)) AS BIGINT) AS ordered_sum, true AS same_bytes, 128 + 56 * count(*) AS bytes FROM rec WHERE side = 'r1'"""
ORACLES["ledger_bytes"] = f"""
    WITH {_BOXES} SELECT side, reason, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS sum_index, CAST(sum(l_partkey) AS BIGINT) AS sum_part, true AS same_bytes FROM q WHERE reason IS NOT NULL GROUP BY side, reason"""
ORACLES["shard_faults"] = """
    WITH n AS (SELECT count(*) AS n FROM orders)
    SELECT unnest([1, 2, 19999999]) AS shard, unnest(['missing', 'damaged', 'unexpected']) AS fault, 'found' AS step FROM n UNION ALL SELECT unnest([1, 2]), 'written', 'resumed' FROM n"""
ORACLES["union_outlines"] = """
    WITH r AS (SELECT s_suppkey // 8 AS block, s_suppkey * 37 % 23 AS x, s_suppkey * 53 % 19 AS y, 1 + s_suppkey * 7 % 11 AS w, 1 + s_suppkey * 5 % 9 AS h FROM supplier),
    c AS (SELECT DISTINCT block, i, j FROM (SELECT block, j, unnest(range(x, x + w)) AS i FROM (SELECT *, unnest(range(y, y + h)) AS j FROM r))),
    n AS (SELECT c.block, c.i, c.j, (SELECT count(*) FROM c o WHERE o.block = c.block AND abs(o.i - c.i) + abs(o.j - c.j) = 1) AS beside FROM c)
    SELECT block, CAST(count(*) AS DOUBLE) AS area, CAST(sum(4 - beside) AS DOUBLE) AS outline FROM n GROUP BY block"""
ORACLES["versioned_groups"] = f"""
    WITH {_MASS} SELECT 'before' AS version, count(*) AS groups, CAST(NULL AS BIGINT) AS overlaps, 4 AS columns FROM mass UNION ALL SELECT 'after', count(*), CAST(sum(overlap_count) AS BIGINT), 5 FROM mass"""
ORACLES["archived_lines"] = """
    WITH p AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 10 = 3 THEN 'malformed_record' WHEN p_partkey % 9 = 4 THEN 'malformed_geometry' ELSE 'read' END AS outcome FROM part)
    SELECT outcome, count(*) AS n, CASE outcome WHEN 'malformed_record' THEN 5 WHEN 'malformed_geometry' THEN 3 ELSE 10 END AS files, CAST(sum(CASE WHEN outcome = 'read' THEN k END) AS BIGINT) AS keys, 0 AS misnumbered FROM p GROUP BY outcome"""
ORACLES["sequence_files"] = """
    SELECT 'nation ' || s_nationkey AS sequence, CAST(count(*) AS INTEGER) AS frames, CAST(max(l_quantity) AS INTEGER) AS width, CAST(min(l_quantity) AS INTEGER) AS height
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey"""
ORACLES["tensor_files"] = """
    SELECT vec_id, CAST(sum(i * CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS BIGINT) AS weighted
    FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY vec_id HAVING count(*) = 64 AND count(x) = 64 AND bool_and(isfinite(x))"""
ORACLES["lock_problems"] = """
    WITH s AS (SELECT s_suppkey % 10 AS m, s_suppkey // 20 AS lock FROM supplier), f AS (
        SELECT lock, 'source' AS role, m, count(*) FILTER (m = 7) OVER (PARTITION BY lock) AS same FROM s UNION ALL SELECT DISTINCT lock, 'boundary', 0, 0 FROM s
    )
    SELECT role, concat_ws(',', CASE WHEN lock % 5 = 4 THEN 'dataset' END, CASE WHEN m = 7 AND same > 1 THEN 'repeated_path' END, CASE m WHEN 1 THEN 'path' WHEN 2 THEN 'path' WHEN 3 THEN 'digest' WHEN 4 THEN 'url' WHEN 5 THEN 'side' WHEN 6 THEN 'format' END) AS problems,
           count(*) AS n, count(DISTINCT lock) AS locks FROM f GROUP BY ALL"""
ORACLES["release_gates"] = f"""
    WITH {_GROUPS}
    SELECT count(*) AS group_count, CAST(sum(r1_count) AS BIGINT) AS r1_count, CAST(sum(r2_count) AS BIGINT) AS r2_count,
           count(*) FILTER (r1_count > 0 AND r2_count > 0) AS both_nonempty, count(*) FILTER (r1_count > 0 AND r2_count = 0) AS r1_only, count(*) FILTER (r1_count = 0 AND r2_count > 0) AS r2_only, count(*) FILTER (r1_count = 0 AND r2_count = 0) AS both_empty,
           (SELECT count(*) FROM kept) AS ledger_retained, 2 AS ledger_sides, (SELECT count(*) FROM q WHERE reason IS NOT NULL) AS excluded, 0 AS changed_before, 1 AS changed_after, true AS documented,
           true AS same_contract_kept, true AS other_contract_refused, true AS load_refused, true AS document_refused FROM grp"""
ORACLES["resumed_stream"] = f"""
    WITH {_BOXES} SELECT count(*) AS n, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, 2 AS first_batches, 2 AS second_batches, 0 AS third_batches, true AS refused FROM kept"""
ORACLES["protocol_differences"] = """
    WITH e AS (SELECT event_id, event_id % 8 AS m FROM events), f(m, path, problem, actual) AS (VALUES
        (1, 'limits.top_k', 'other', '100.0'), (2, 'limits.top_k', 'other', '50'), (3, 'limits.operator', 'missing', NULL), (4, 'limits.nms', 'unexpected', 'false'),
        (5, 'steps[1][0]', 'missing', NULL), (5, 'steps[1]', 'unexpected', '"cut"'), (6, 'none', 'missing', NULL), (6, 'none[0]', 'unexpected', '1'), (7, '', 'unreadable', NULL),
        (7, 'kind', 'missing', NULL), (7, 'limits.top_k', 'missing', NULL), (7, 'limits.operator', 'missing', NULL), (7, 'steps[0]', 'missing', NULL), (7, 'steps[1][0]', 'missing', NULL), (7, 'none', 'missing', NULL))
    SELECT path, problem, count(*) AS n, min(event_id) AS first, max(actual) AS actual FROM e JOIN f USING (m) GROUP BY path, problem"""
ORACLES["footprint_csv_files"] = """
    WITH p AS (
        SELECT p_partkey AS k, p_partkey % 5 AS part, CASE WHEN p_partkey % 13 = 5 THEN 'malformed_record' WHEN p_partkey % 9 = 4 THEN 'malformed_geometry' ELSE 'read' END AS outcome, p_partkey % 7 = 2 AS two,
               row_number() OVER w AS record, 1 + sum(CASE WHEN p_partkey % 7 = 2 THEN 2 ELSE 1 END) OVER w AS line FROM part WINDOW w AS (PARTITION BY p_partkey % 5 ORDER BY p_partkey)
    )
    SELECT part || '.csv.gz' AS source_file, outcome, count(*) AS n, CAST(sum(k) FILTER (outcome <> 'malformed_record') AS BIGINT) AS keys, count(*) FILTER (two AND outcome <> 'malformed_record') AS two_lines, CAST(max(line) AS BIGINT) AS last_line, max(record) AS last_record
    FROM p GROUP BY part, outcome"""
ORACLES["image_headers"] = """
    WITH s AS (SELECT s_suppkey, CASE s_suppkey % 9 WHEN 4 THEN 'missing' WHEN 5 THEN 'repeated' WHEN 7 THEN 'conflict' ELSE 'found' END AS status FROM supplier)
    SELECT s_suppkey, status, CASE WHEN status <> 'missing' THEN CAST(1 + s_suppkey % 50 AS INTEGER) END AS width, CASE WHEN status <> 'missing' THEN CAST(1 + s_suppkey % 37 AS INTEGER) END AS height FROM s"""
ORACLES["boundary_files"] = """
    WITH r AS (SELECT n_nationkey AS n, n_regionkey AS region, n_nationkey * 3 % 17 AS x, n_nationkey * 5 % 11 AS y, n_nationkey % 8 IN (3, 6) AS faulty FROM nation),
    c AS (SELECT DISTINCT region, x + i AS cx, y + j AS cy FROM (SELECT *, unnest(range(6)) AS i FROM (SELECT *, unnest(range(4)) AS j FROM r)) WHERE NOT faulty AND NOT (n % 6 = 1 AND i IN (1, 2) AND j IN (1, 2))),
    p AS (SELECT c_custkey % 25 AS cx, c_custkey * 7 % 17 AS cy, count(*) AS n FROM customer GROUP BY ALL)
    SELECT region, features, faulty, area, customers FROM (SELECT region, count(*) AS features, count(*) FILTER (faulty) AS faulty FROM r GROUP BY region)
    LEFT JOIN (SELECT region, CAST(count(*) AS DOUBLE) AS area, CAST(coalesce(sum(p.n), 0) AS BIGINT) AS customers FROM c LEFT JOIN p USING (cx, cy) GROUP BY region) USING (region)"""
