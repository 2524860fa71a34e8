"""DuckDB SQL for the queries that SQL can express."""

from .license_scan import TEMPLATES
from .secret_scan import BASE, BINS, ENCODINGS, KEYWORDS, LEVELS, TOKEN
from .url_filter import METHOD_RULES

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _templates() -> str:
    return ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))


def _method_rules() -> str:
    """The method's rules as rows, to be run on every URL."""
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    return ", ".join(f"({r.priority}, {quote(r.name)}, {quote(r.pattern)})" for r in METHOD_RULES)


def _next_words() -> str:
    return ", ".join(f"lead(word, {k}) OVER w AS w{k}" for k in range(1, 10))


def _windows_at() -> str:
    """The n words from each place on, for n from 1 to 10."""
    parts = [f"SELECT rid, i, {n} AS n, concat_ws(' ', {', '.join(['word', *(f'w{k}' for k in range(1, n))])}) AS words FROM placed WHERE {'true' if n == 1 else f'w{n - 1} IS NOT NULL'} AND {n} IN (SELECT n FROM win)" for n in range(1, 11)]
    return " UNION ALL ".join(parts)


def _rounds() -> str:
    """Assignments a0 ... a5 and centroids c1 ... c5 from kept(rid, v) and c0(c, v)."""
    out = []
    for i in range(6):
        out.append(f"""a{i} AS MATERIALIZED (
            SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d
            FROM (SELECT rid, c, CAST(list_sum(list_transform(list_zip(k.v, c{i}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM kept k, c{i}) GROUP BY rid
        )""")
        if i < 5:
            out.append(f"""c{i + 1} AS MATERIALIZED (
            SELECT c{i}.c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
                SELECT c, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY dim) AS v FROM (
                    SELECT c, dim, sum(x) AS total, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM kept JOIN a{i} USING (rid)) GROUP BY c, dim
                ) GROUP BY c
            ) m ON m.c = c{i}.c
        )""")
    return ", ".join(out)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _patterns() -> str:
    """Kinds in their order with their patterns, letters of keywords in either case spelt out, and what their length is taken of."""
    either = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in KEYWORDS)
    rows = [(nth, kind, pattern.replace(f"(?i:{KEYWORDS})", f"(?:{either})"), group, least) for nth, (kind, (pattern, group, least)) in enumerate(BASE.items())]
    rows.append((len(BASE), "random", TOKEN, 0, 20))
    return ", ".join(f"({nth}, {_quoted(kind)}, {_quoted(pattern)}, {group}, {least})" for nth, kind, pattern, group, least in rows)


def _encodings() -> str:
    return ", ".join(f"({no}, '{a}', '^[' || '{a.replace('-', chr(92) + '-')}' || ']+$', [{', '.join(str(sum(c in g for c in a)) for g in ('0123456789', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz', '+/-_'))}])" for no, a in enumerate(ENCODINGS))


def _tail(z: str) -> str:
    """P(Z > z), in the approximation of ``secret_scan.upper_tail``."""
    x = f"greatest(least(abs({z}), 12.0::DOUBLE), 1e-9::DOUBLE)"
    tail = f"((1 - exp(-1.4::DOUBLE * {x})) * exp(-{x} * {x} / 2) / (1.135::DOUBLE * sqrt(2 * pi()) * {x}))"
    return f"(CASE WHEN {z} >= 0 THEN {tail} ELSE 1 - {tail} END)"


def _chi_squared(x: str, df: str) -> str:
    return f"((pow({x} / {df}, 1.0::DOUBLE / 3) - (1 - 2.0::DOUBLE / (9 * {df}))) / sqrt(2.0::DOUBLE / (9 * {df})))"


def _length_class(n: str) -> str:
    return " + ".join(f"CAST({n} >= {low} AS INTEGER)" for low, _ in LEVELS[1:])


ORACLES: dict[str, str] = {
    "op1_decontamination": f"""
        WITH b AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM benchmark
        ), cut AS (
            SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0
        ), win AS (
            SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + 9], ' ') AS words FROM cut
        ), d AS (
            SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents
        ), flat AS (
            SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
        ), placed AS (
            SELECT rid, i, word, {_next_words()} FROM flat WINDOW w AS (PARTITION BY rid ORDER BY i)
        ), occ AS (
            SELECT rid, i, n, item FROM ({_windows_at()}) JOIN win USING (n, words)
        ), hits AS (
            SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM occ) GROUP BY rid
        ), items AS (
            SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM occ) GROUP BY rid
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)""",
    "op3_url_filter": r"""
        WITH p AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), q AS (
            SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(rest, ''), '(?s)^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(coalesce(rest, ''), '(?s)^[^?#]*(\?[^#]*)', 1) AS query FROM p
        ), r AS (
            SELECT *, CASE WHEN host = 'www.example.com' OR suffix(host, '.www.example.com') THEN starts_with(path, '/en/') ELSE false END AS www,
                   (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/en/') AS example,
                   (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') AS es,
                   (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') AS fr,
                   (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') AS com FROM q
        ), m(priority, name, pattern) AS (
            VALUES """
    + _method_rules()
    + r"""
        ), t AS (SELECT DISTINCT translate(host || path || query, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target FROM q), fit AS (
            SELECT target, arg_max(name, (priority, name)) AS method FROM t JOIN m ON regexp_matches(target, pattern) GROUP BY target
        ), s AS (
            SELECT page_id, host, path, translate(host || path || query, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target,
                   CASE WHEN www THEN 'www.example.com/en/' WHEN example THEN 'example.com/en/' WHEN es THEN 'net/es/' WHEN fr THEN 'net/fr/' WHEN com THEN 'com/' END AS rule FROM r
        )
        SELECT page_id, host, path, rule, coalesce(rule, method) AS matched,
               CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL OR method IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
        FROM s LEFT JOIN fit USING (target)""",
    "op5_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op8_license_scan": f"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents
        ), b AS (
            SELECT doc_id, w, text,
                   list_filter(range(len(w)), lambda i: w[i + 1] = 'mit' AND w[i + 2] = 'license') AS mit,
                   list_filter(range(len(w)), lambda i: w[i + 1] = 'apache' AND w[i + 2] = 'license') AS apache,
                   list_filter(range(len(w)), lambda i: w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license') AS gpl FROM d
        ), t AS (
            SELECT label, list_distinct(regexp_extract_all({_LOWER.format("body")}, '{_WORD}')) AS tokens FROM (VALUES {_templates()}) v(n, label, body)
        ), l AS (
            SELECT DISTINCT doc_id, regexp_extract_all({_LOWER.format("line")}, '{_WORD}') AS words FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
        ), m AS (
            SELECT doc_id, words, label, len(list_intersect(words, tokens)) AS common, len(list_intersect(words, tokens)) / len(tokens) AS containment FROM l, t
            WHERE len(list_intersect(words, tokens)) >= ceil(0.8 * len(tokens) - 1e-9)
            QUALIFY common = max(common) OVER (PARTITION BY doc_id, words)
        ), g AS (
            SELECT doc_id, list(label) AS labels, max(containment) AS best FROM m GROUP BY doc_id
        ), base AS (
            SELECT doc_id, len(w) AS n_words, list_concat(mit, apache, gpl) AS places,
                   list_filter([CASE WHEN len(mit) > 0 THEN 'mit' END, CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END], lambda x: x IS NOT NULL) AS labels FROM b
        )
        SELECT base.doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
               coalesce(list_aggregate(list_sort(base.labels), 'string_agg', ','), '') AS base_labels,
               coalesce(list_aggregate(list_sort(list_distinct(list_concat(base.labels, coalesce(g.labels, [])))), 'string_agg', ','), '') AS labels,
               CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
        FROM base LEFT JOIN g USING (doc_id)""",
    "op11_centroids": f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT 40)
        ), {_rounds()}
        SELECT vec_id, CAST(a5.c AS INTEGER) AS cluster, a5.d AS distance, CAST(sum(a5.d) OVER (PARTITION BY a5.c) AS BIGINT) AS cluster_inertia, CAST(sum(a5.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c5.v, ',')) AS centroid_sha256
        FROM kept JOIN a5 USING (rid) JOIN c5 ON c5.c = a5.c""",
    "op13_collocations": f"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
        ), w AS MATERIALIZED (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w, generate_subscripts(w, 1) AS i FROM p
        ), f AS MATERIALIZED (
            SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f FROM w, range(1, 4) r(m) WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 10
        ), n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
        c AS (
            SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w, k FROM f, range(1, 3) r(k) WHERE m > k AND m > 1
        ), s AS (
            SELECT c.lang, c.m, c.phrase, c.a, k, x.f AS l, y.f AS r, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 :], ' ')
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
        ), around AS (
            SELECT lang, phrase, max(f) AS longer FROM (SELECT lang, array_to_string(string_split(phrase, ' ')[j : j + 1], ' ') AS phrase, f FROM f, range(1, 3) r(j) WHERE m = 3) GROUP BY ALL
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM s JOIN n USING (lang) LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a
        QUALIFY rank <= 2000""",
    "op12_secret_scan": f"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
        m AS MATERIALIZED (
            SELECT rid, nth, kind, pattern, grp, least_length, i, f, sum(length(g) + length(f)) OVER (PARTITION BY rid, nth ORDER BY i) AS stop
            FROM (
                SELECT rid, nth, kind, pattern, grp, least_length, unnest(regexp_extract_all(text, pattern)) AS f, unnest(string_split_regex(text, pattern)) AS g, unnest(range(len(string_split_regex(text, pattern)))) AS i
                FROM d, (VALUES {_patterns()}) v(nth, kind, pattern, grp, least_length) WHERE regexp_matches(text, pattern)
            ) WHERE f IS NOT NULL
        ), t AS (
            SELECT DISTINCT f AS token FROM m WHERE kind = 'random'
        ), c AS (
            SELECT token, arg_min({{{{'no': no, 'a': a, 'sizes': sizes}}}}, no) AS e FROM t, (VALUES {_encodings()}) v(no, a, pattern, sizes) WHERE regexp_matches(token, pattern) GROUP BY token
        ), q AS (
            SELECT token, e.no AS no, length(token)::DOUBLE AS n, length(e.a)::DOUBLE AS k, e.sizes AS sizes,
                   list_sum(list_transform(string_split(e.a, ''), lambda x: pow(length(token) - length(replace(token, x, '')), 2))) AS squares,
                   [length(token) - length(regexp_replace(token, p, '', 'g')) for p in ['[0-9]', '[A-Z]', '[a-z]', '[+/_-]']] AS seen,
                   translate(token, e.a, repeat('0', length(e.a) // 2) || repeat('1', length(e.a) // 2)) AS halves,
                   list_transform(string_split(token, ''), lambda x: 2 * (instr(e.a, x) - 1) - (length(e.a) - 1)) AS v FROM c
        ), r AS (
            SELECT *, greatest(squares * k / n - n, 0) AS x_cells,
                   list_sum(list_transform(range(1, 5), lambda j: CASE WHEN sizes[j] > 0 THEN pow(seen[j] - n * sizes[j] / k, 2) / (n * sizes[j] / k) ELSE 0 END)) AS x_classes,
                   CAST(len(list_filter(sizes, lambda x: x > 0)) - 1 AS DOUBLE) AS degrees,
                   (length(halves) - length(replace(halves, '01', '')) + length(halves) - length(replace(halves, '10', ''))) / 2 AS turns,
                   list_sum(list_transform(range(1, len(v)), lambda j: v[j] * v[j + 1]))::DOUBLE AS products FROM q
        ), z AS (
            SELECT token, no, n, {_chi_squared("x_cells", "(k - 1)")} AS z_cells, {_chi_squared("x_classes", "degrees")} AS z_classes,
                   abs(turns - (n - 1) / 2) / sqrt((n - 1) / 4) AS z_runs, abs(products) / (sqrt(n - 1) * (k * k - 1) / 3) AS z_serial FROM r
        ), p AS (
            SELECT token, no * {len(LEVELS)} + {_length_class("n")} AS class, least(1.0::DOUBLE, 4 * least({_tail("z_cells")}, {_tail("z_classes")}, 2 * {_tail("z_runs")}, 2 * {_tail("z_serial")})) AS p FROM z
        ), b AS MATERIALIZED (
            SELECT token, class, CAST(least({BINS}, floor(-4 * log2(p))) AS INTEGER) AS bin FROM p
        ), h AS (
            SELECT class, bin, sum(count(*)) OVER (PARTITION BY class ORDER BY bin DESC) AS rejected, sum(count(*)) OVER (PARTITION BY class) AS total FROM m JOIN b ON f = token AND kind = 'random' GROUP BY class, bin
        ), cut AS (
            SELECT class, min(bin) AS bin FROM h WHERE pow(2.0::DOUBLE, -bin / 4.0::DOUBLE) * total <= ([{", ".join(f"{level}::DOUBLE" for _, level in LEVELS)}])[class % {len(LEVELS)} + 1] * rejected GROUP BY class
        ), s AS (
            SELECT rid, nth, kind, stop - length(f) AS start, stop FROM m LEFT JOIN b ON kind = 'random' AND f = token LEFT JOIN cut USING (class)
            WHERE CASE WHEN kind = 'random' THEN b.bin < coalesce(cut.bin, {BINS} + 1) ELSE length(CASE WHEN grp = 0 THEN f ELSE regexp_extract(f, pattern, 2) END) >= least_length END
        ), g AS (
            SELECT rid, count_if(nth = 0) AS n_assign, count_if(nth = 1) AS n_access, count_if(nth = 2) AS n_hex, count_if(nth = 3) AS n_random,
                   string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nth, stop) FILTER (nth < 3) AS base, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nth, stop) AS spans FROM s GROUP BY rid
        )
        SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
               CAST(coalesce(n_random, 0) AS BIGINT) AS n_random, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN g USING (rid)""".replace("{{", "{").replace("}}", "}"),
}
