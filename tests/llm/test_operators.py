"""Operators on their own: exactness of the parts, bounds, and paths that small tables do not reach."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from tilewise.llm import bpe_codec, decontam, exact_dedup, langid, license_scan, pieces, simhash, token_count, token_shards
from tilewise.llm.common import Memo, join_back


def test_pieces_are_the_patterns_matches():
    cut = regex.compile(public_tokenizers.PATTERN).findall
    seen = []
    table = pieces.PieceTable(10**9, seen.extend, lambda: None)
    rng = random.Random(1)
    texts = ["", "'s", "''s", "a'sb'll x", "  a", "a\n\n b"] + ["".join(rng.choices("ab  é\n\t'srtvelmd1!\x1c\x85　\xa0中", k=rng.randint(0, 25))) for _ in range(5000)]
    texts += [f"a{chr(c)}1{chr(c)} {chr(c)}" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for _ in range(2):
        numbers, sizes = table.read(texts)
        at = 0
        for t, n in zip(texts, sizes, strict=True):
            assert [seen[i] for i in numbers[at : at + n]] == cut(t)
            at += n
    assert not regex.search(r"[\p{L}\p{N}\s]", "".join(map(chr, range(0x40000, 0x110000))))
    other = pieces.PieceTable(10**9, lambda w: None, lambda: None, r"\S+|\s+")
    assert other.read(["a b", "", "c"])[1].tolist() == [3, 0, 1]


def test_piece_table_starts_anew_beyond_its_limit():
    seen = []
    table = pieces.PieceTable(3, seen.extend, seen.clear)
    for text in ("a b c d", "e f", "a b"):
        numbers, _ = table.read([text])
        assert "".join(seen[i] for i in numbers) == text


def test_memo_keeps_common_keys():
    memo = Memo(8)
    for i in range(100):
        for k in memo.missing({"common", i}):
            memo.now[k] = k
        assert memo.now["common"] == "common" and len(memo.now) + len(memo.before) <= 16


def test_long_words_merge_like_the_library():
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_codec.read_ranks(path), special_tokens={})
    c = bpe_codec.codec(path, public_tokenizers.PATTERN)
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdest", k=n)) for n in (3, 50, 64, 65, 128, 400, 600, 2000)] + ["".join(rng.choices("etaoinshrdluABCé日", k=n)) for n in (100, 1000, 5000)]
    texts += ["a" * n for n in (63, 64, 65, 129, 1000, 30001)] + ["=" * 200, "-=" * 300, " " * 300 + "x", "\n" * 500, "the" * 100, "日" * 500]
    for text, (decimal, data) in zip(texts, c.read(texts), strict=True):
        assert decimal.decode() == " ".join(map(str, library.encode_ordinary(text))) and data == text.encode()


def test_many_long_words_fit_the_memory_of_a_worker():
    c = bpe_codec.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=500)) for _ in range(400))
    assert next(c.read([text]))[1] == text.encode()
    assert c.db.execute("SELECT count(*) FROM duckdb_temporary_files()").fetchone() == (0,)


def test_codec_operators(spark):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = spark.createDataFrame([(1, "it's  a test\n", "k"), (2, None, "l"), (3, "🎉", "m")], "doc_id long, text string, ids string")
    got = bpe_codec.encode_and_decode(docs, path, pattern).orderBy("doc_id").collect()
    assert [r.decoded for r in got] == ["it's  a test\n", "", "🎉"] and [r.n_tokens for r in got] == [len(r.ids) for r in got]
    back = bpe_codec.decode(spark.createDataFrame([(r.doc_id, r.ids) for r in got] + [(9, None)], "doc_id long, ids array<int>"), path, pattern).orderBy("doc_id").collect()
    assert [bytes(r.bytes) for r in back] == ["it's  a test\n".encode(), b"", "🎉".encode(), b""]


def test_transducer_counts_like_the_library():
    c = token_count.Counter(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(5)
    texts = ["", " ", "   a", "\n", "▁a▁", "<s> x </s>", "a\x00b", "é" * 200, "ab" * 500, " " * 70, "日本語" * 40]
    texts += ["".join(rng.choices("etaoinshr  .,\n▁éñ中🎉ABC012<>/", k=rng.randint(1, 80))) for _ in range(1500)]
    texts += ["".join(rng.choices(sorted(c.machine.pieces), k=rng.randint(1, 6))) for _ in range(3000)]
    expected = [len(x) for x in c.machine.model.encode(texts, num_threads=1)]
    assert c.count(texts).tolist() == expected
    c.machine.reset()
    assert c.count(texts[:300]).tolist() == expected[:300]


def test_chunk_maps_compose():
    m = token_count.counter(public_tokenizers.path("piece_bpe_32k.model")).machine
    text = "abcdefghijklmnop" * 20
    state, total = 0, 0
    for lo in range(0, len(text), 37):
        state, n = m.chunk_map(state, text[lo : lo + 37])
        total += n
    assert (state, total) == m.chunk_map(0, text) and total == m.count_chunk(text)


def test_prefix_scan_of_chunk_maps_at_random_cuts():
    m = token_count.counter(public_tokenizers.path("piece_bpe_32k.model")).machine
    rng = random.Random(9)
    entry_states = 0
    for _ in range(150):
        text = "".join(rng.choices("etaoinshrdlu" if rng.random() < 0.5 else "abAB日é1", k=rng.randint(1, 400)))
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text), rng.randint(0, 12))))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        maps = m.part_maps(parts)
        entry_states = max(entry_states, *map(len, maps))
        for end, found in zip([*cuts, len(text)], token_count.prefix_scan(maps), strict=True):
            assert found[0] == m.chunk_map(0, text[:end])
        a, b, c = (maps * 3)[:3] if len(maps) < 3 else maps[:3]
        assert token_count.compose(token_count.compose(a, b), c) == token_count.compose(a, token_count.compose(b, c))
    assert entry_states > 1


def test_fm_index_search_and_locate():
    rng = np.random.default_rng(3)
    for _ in range(60):
        text = np.append(rng.integers(0, 5, rng.integers(0, 200)), 0)
        index = decontam.FMIndex(text, 5)
        for size in (1, 2, 5):
            phrase = rng.integers(1, 5, (20, size))
            lo, hi = index.search(phrase, np.full(20, size))
            for p, a, b in zip(phrase, lo, hi, strict=True):
                expected = [i for i in range(len(text) - size + 1) if (text[i : i + size] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


def test_benchmark_in_blocks_gives_the_same(spark, sf_dir):
    docs, bench = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    one = {tuple(r) for r in decontam.contamination(docs, bench).select("doc_id", "n_hit", "items_sha256").collect()}
    many = {tuple(r) for r in decontam.contamination(docs, bench, block_bytes=1500).select("doc_id", "n_hit", "items_sha256").collect()}
    assert one == many and any(r[1] for r in one)


def test_benchmark_of_one_repeated_text_and_of_a_shared_window(spark):
    words = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([(7, words)] * 300 + [(i, f"{words} own{i} tail{i}") for i in range(100, 140)], "item_id long, text string").repartition(5)
    docs = spark.createDataFrame([(1, f"before {words} after", "k"), (2, "clean text", None), (3, f"{words} own101 tail101", None)], "doc_id long, text string, block string")
    expected = {r.doc_id: (r.n_hit, r.n_items, r.items) for r in decontam.contamination(docs, bench).collect()}
    assert expected[1][:2] == (12, 41) and expected[2] == (0, 0, []) and expected[3][0] == 14
    assert {r.doc_id: (r.n_hit, r.n_items, r.items) for r in decontam.contamination(docs, bench, block_bytes=500).collect()} == expected


def test_spans_are_cut_and_nothing_else(spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Zero ONE, two three! four", 25, "k"), (2, "clean", 5, None), (3, "one two three", 13, None), (4, None, None, None), (5, "é one-two three one two three ü", 0, None)], "doc_id long, text string, n_chars long, filled string")
    got = {r.doc_id: (r.text, r.n_chars) for r in decontam.remove_contamination(docs, bench).collect()}
    assert got == {1: ("Zero ! four", 11), 2: ("clean", 5), 4: (None, None), 5: ("é  ü", 4)}


def test_word_hashes_do_not_join_texts():
    h, starts, ends = decontam.hash_words(np.frombuffer(b"abAB c", dtype=np.uint8), np.array([2, 6]))
    assert list(zip(starts, ends, strict=True)) == [(0, 2), (2, 4), (5, 6)] and h[0] == h[1] != h[2]


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3000, 60000):
        ids = rng.choice(np.arange(50), n, p=(w := 1 / np.arange(1, 51)) / w.sum()).astype(np.uint32)
        ids[n // 2 : n // 2 + n // 4] = 7  # runs of one id
        ends = np.array([n // 3, n // 3, n])
        shard = token_shards.Shard(token_shards.pack([5, None, 9], ends, ids))
        assert (shard.ids() == ids).all() and [shard.key(i) for i in range(3)] == [5, None, 9]
        for _ in range(50):
            a, b = sorted(rng.integers(0, n + 1, 2))
            assert (shard.slice(int(a), int(b)) == ids[a:b]).all()
        assert (shard.document(2) == ids[n // 3 :]).all() and len(shard.document(1)) == 0
    with pytest.raises(ValueError):
        token_shards.Shard(b"nope" + bytes(40))
    with pytest.raises(ValueError):
        token_shards.pack([1], np.array([1]), np.array([60000], dtype=np.uint32))


def test_small_shards_hold_the_same_documents(spark, tmp_path, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    token_shards.write_shards(docs, str(tmp_path / "s"), path, pattern, shard_ids=3000)
    shards = token_shards.read_shards(spark, str(tmp_path / "s"))
    assert shards.count() > 10
    a = {tuple(r) for r in token_shards.document_rows(shards).collect()}
    assert a == {tuple(r) for r in token_shards.encode_and_read(docs, path, pattern).collect()}


def test_links_of_crowded_buckets_through_midpoints(spark):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = set()
    for b in base:
        for _ in range(25):
            x = b
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    groups = {}
    for f in fps:
        groups.setdefault(root(f), set()).add(signed(f))
    expected = {frozenset(g) for g in groups.values() if len(g) > 1}
    for limit in (simhash.BUCKET_LIMIT, 3):
        found = {}
        for r in simhash.components(simhash.links(df, limit=limit)).collect():
            found.setdefault(r.root, set()).add(r.node)
        assert {frozenset(g) for g in found.values()} == expected
        assert all(min(g) == r for r, g in found.items())


@pytest.mark.parametrize("n", [10, 10**5, 10**8, 10**11])
def test_blocks_cover_all_bits_and_every_close_pair(n):
    from itertools import combinations

    blocks, agree = simhash.plan_blocks(n)
    assert sum(w for _, w in blocks) == 64 and len(blocks) - agree == simhash.MAX_DISTANCE
    assert all(any(not set(c) & set(bad) for c in combinations(range(len(blocks)), agree)) for bad in combinations(range(len(blocks)), 4))


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long").repartition(5)
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_kneser_ney_sums_to_one():
    model = langid.train({"a": {"abc": 3, "abd": 1, "b": 2}, "b": {"xyz": 1}})
    chars = "abcdxyz"
    for context in ("a", "ab"):
        total = np.zeros(2)
        for c in [*chars, None, "q"]:
            hashes, longest, _ = langid._grams([context + c] if c else [context])
            at = len(context) + 1
            total += [model._prob(j, int(longest[at]), hashes, np.array([at]))[0] for j in range(2)]
        assert np.allclose(total, 1, atol=1e-9)  # "q" stands for all unseen characters


def test_hubs_and_many_small_components(spark):
    edges = [(10**6, i) for i in range(3000)] + [(2 * 10**6 + 3 * i, 2 * 10**6 + 3 * i + 1) for i in range(4000)] + [(2 * 10**6 + 3 * i + 1, 2 * 10**6 + 3 * i + 2) for i in range(4000)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {i: 0 for i in [*range(3000), 10**6]} | {2 * 10**6 + i: 2 * 10**6 + i - i % 3 for i in range(12000)}


def plain_kneser_ney(words):
    """Probability of a character after a context, by the definition, from word counts."""
    grams = Counter()
    for w, n in words.items():
        marked = f" {w} "
        for i in range(1, len(marked)):
            for k in range(1, langid.ORDER + 1):
                if i - k + 1 >= 0:
                    grams[marked[i - k + 1 : i + 1]] += n
    kn = {}
    for g, n in grams.items():
        kn[g] = n if len(g) == langid.ORDER or (g[0] == " " and len(g) > 1) else sum(1 for h in grams if len(h) == len(g) + 1 and h[1:] == g)
    chars = len({c for w in words for c in w})

    def prob(context, c, floor):
        lower = prob(context[1:], c, floor) if context else floor
        seen = {g: n for g, n in kn.items() if len(g) == len(context) + 1 and g[:-1] == context}
        if not seen:
            return lower
        return max(seen.get(context + c, 0) - langid.DISCOUNT, 0) / sum(seen.values()) + langid.DISCOUNT * len(seen) / sum(seen.values()) * lower

    return prob, chars


def test_scores_equal_plain_kneser_ney():
    rng = random.Random(2)
    words = {x: Counter("".join(rng.choices(alphabet, k=rng.randint(1, 6))) for _ in range(60)) for x, alphabet in (("a", "abcd"), ("b", "cdef"))}
    model = langid.train(words)
    texts = ["abc bad", "cdef fed", "a", "zz abzz", "dcba" * 5]
    entropy, n = model.text_scores(texts)
    for j, x in enumerate(model.langs):
        prob, _ = plain_kneser_ney(words[x])
        for i, t in enumerate(texts):
            nats, count = 0.0, 0
            for w in t.split():
                marked = f" {w} "
                for at in range(1, len(marked)):
                    nats -= np.log(prob(marked[max(0, at - langid.ORDER + 1) : at], marked[at], model.floor))
                    count += 1
            assert n[i] == count and abs(entropy[i, j] - nats / count) < 1e-9


def test_many_labels_and_repeated_keys_stay_in_bounds(spark, monkeypatch):
    rows = [(i, f"tekst {i} of label{i % 40} " * 3, f"l{i % 40:02}") for i in range(400)] + [(1, f"again {i} again", "l01") for i in range(200)] + [(None, "no key", "l02")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.fit(docs, languages=7).langs == sorted(r.l for r in docs.where(langid.may_learn()).groupBy(F.col("lang").alias("l")).count().orderBy(F.desc("count"), "l").limit(7).collect())
    monkeypatch.setattr(langid, "SCORED_LANGUAGES", 3)
    few = langid.fit(docs, total=200)
    assert len(few.langs) == 40
    assert langid.predict(docs, few).where("lang_pred = lang_pred").count() == len(rows)


def test_language_models_learn_only_from_allowed_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(langid.may_learn(), F.col("lang")).otherwise("xx"))
    assert langid.fit(wrong).langs == sorted(r.lang for r in docs.select("lang").distinct().collect())
    assert langid.fit(docs.where("false")).langs == []


def test_rejection_keeps_learned_languages_and_drops_others(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(docs)
    alien = spark.createDataFrame([(-1, "Быстрая коричневая лиса прыгает через ленивую собаку у старого дуба", "ru", "s", 1), (-2, "...", None, None, None), (-3, None, None, None, None)], docs.schema)
    kept = langid.keep_known(docs.unionByName(alien), model)
    assert kept.columns == docs.columns
    assert kept.where("doc_id < 0").count() == 0 and kept.count() >= 0.99 * docs.count()


def test_license_join_equals_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [license_scan.tokens(t) for _, t in license_scan.TEMPLATES]
    lines = []
    for i in range(400):
        some = rng.choice(vocabulary)
        lines.append((i, "\n".join(" ".join(rng.sample(some, rng.randint(max(1, len(some) - 4), len(some))) + rng.choices(["foo", "the", "License"], k=rng.randint(0, 3))) for _ in range(rng.randint(1, 3)))))
    got = {r.doc_id: sorted((b.block, b.label, round(b.containment, 9)) for b in r.licences.blocks) for r in license_scan.scan(spark.createDataFrame(lines, "doc_id long, text string")).collect()}
    for i, text in lines:
        expected = []
        for k, line in enumerate(text.split("\n")):
            have = set(license_scan.tokens(line))
            for label, t in license_scan.TEMPLATES:
                own = set(license_scan.tokens(t))
                if len(have & own) >= 0.8 * len(own) - 1e-9:
                    expected.append((k, label, round(len(have & own) / len(own), 9)))
        assert got[i] == sorted(expected)


def test_many_templates_are_scanned_in_passes(spark, monkeypatch):
    import cases

    more = tuple((f"own{i}", f"house number{i} section{i} clause{i} applies") for i in range(520))
    texts = ["x\nHouse number5 section5 clause5 applies here", "house number519 section519\nclause519 applies", "Released under the MIT License", cases.BODY, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    many = {r.doc_id: r.licences for r in license_scan.scan(docs, templates=license_scan.TEMPLATES + more).collect()}
    assert [sorted({b.label for b in many[i].blocks}) for i in range(6)] == [["own5"], [], ["mit"], [], [], []]
    assert {w.label for w in many[1].windows} == {"own519"}
    few = {r.doc_id: r.licences for r in license_scan.scan(docs).collect()}
    monkeypatch.setattr(license_scan, "TEMPLATES_AT_ONCE", 5)
    assert {r.doc_id: r.licences for r in license_scan.scan(docs).collect()} == few
    assert license_scan.scan(docs, templates=()).where("size(licences.blocks) = 0 and size(licences.windows) = 0").count() == 6
    with pytest.raises(ValueError, match="column"):
        license_scan.scan(docs.withColumn("Licences", docs.text))


@pytest.mark.parametrize("part_rows", [exact_dedup.PART_ROWS, 1000])
def test_bloom_filter_never_misses_a_repeat(spark, monkeypatch, part_rows):
    monkeypatch.setattr(exact_dedup, "PART_ROWS", part_rows)
    df = spark.range(5000).select((F.col("id") % 4500).alias("v"), F.lit("x").alias("bits_1_bucket"), F.lit("y").alias("part"), F.lit("z").alias("h"), F.lit(1).alias("Cell_1"))
    marked = exact_dedup.possibly_repeated(df, F.xxhash64("v"), 5000, "maybe")
    assert marked.columns == [*df.columns, "maybe"] and marked.count() == 5000
    repeated = {r.v for r in df.groupBy("v").count().where("count > 1").collect()}
    flagged = {r.v for r in marked.where("maybe").select("v").distinct().collect()}
    assert repeated <= flagged and len(flagged) < 1000
    assert exact_dedup.drop_duplicates(df.withColumn("t", F.col("v").cast("string")), "v", "t").count() == 4500


def test_drop_duplicates_keeps_columns_and_one_of_each(spark):
    import cases

    docs = cases.documents(spark)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    near = simhash.drop_near_duplicates(docs)
    assert near.columns == docs.columns and near.count() == simhash.near_duplicates(docs).select("component_id").distinct().count()


def test_join_back_splits_hot_keys(spark):
    rows = spark.createDataFrame([("h", i) for i in range(50)] + [("c", 1)], "k string, v int")
    groups = spark.createDataFrame([("h", 50), ("c", 1)], "k string, n long")
    assert join_back(rows, groups, "k", "n", 51).count() == 51


def test_shard_hits_of_a_sliced_array():
    texts = pa.array(["x", "one two", None or "", "two one two"], pa.string()).slice(1)
    hits = decontam.search_texts(texts, iter([decontam.phrases_of([(7, "one two")])]))
    assert hits.n_words.tolist() == [2, 0, 3] and hits.n_hit.tolist() == [2, 0, 2] and hits.spans[2] == [(1, 3)]


def test_token_shards_part_a_hot_key(spark, tmp_path):
    """A key with most rows, whose texts begin alike or are equal, is not one task's."""
    n = 4000
    text = F.when(F.col("id") % 2 == 0, F.lit("the same text again and again " * 6)).otherwise(F.concat(F.lit("a common beginning " * 6), F.col("id").cast("string")))
    docs = spark.range(0, n, numPartitions=4).select(F.when(F.col("id") % 10 < 6, 7).otherwise(F.col("id")).cast("long").alias("doc_id"), text.alias("text"))
    out = str(tmp_path / "shards")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would join ranges as small as these
    try:
        token_shards.write_shards(docs, out, public_tokenizers.path("byte_bpe_50k.json"), token_shards.PATTERN)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = token_shards.read_shards(spark, out)
    rows = token_shards.document_rows(shards).collect()
    assert len(rows) == n and [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == sorted(r.doc_id for r in docs.select("doc_id").collect())
    per_task = [len(token_shards.Shard(bytes(r.shard)).keys) for r in shards.collect()]
    assert len(per_task) >= 4 and max(per_task) < 0.5 * n


def test_many_notices_in_one_text_cost_in_proportion(spark):
    """Notices of one text look at their neighbours, not at each other: eight times as many take about eight times as long."""
    import time

    took = []
    for n in (200, 1600):
        text = "\n".join(("Released under the MIT License", "Licensed under CC BY-NC 4.0.", "All rights reserved")[i % 3] for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        license_scan.report(docs.limit(1)).collect()
        began = time.perf_counter()
        (r,) = license_scan.report(docs).collect()
        took.append(time.perf_counter() - began)
        assert r.labels == "all-rights-reserved,cc-by-nc,mit" and r.score == 1.0
    assert took[1] < 20 * took[0] + 5


@pytest.mark.parametrize("drop", [exact_dedup.drop_duplicates, simhash.drop_near_duplicates])
def test_rows_equal_in_key_and_text_meet_before_they_are_shuffled(spark, drop):
    """A third of all rows is one row, another third has one key: each task leaves one of them, and texts are shuffled once."""
    n = 3000
    text = F.when(F.col("id") % 3 == 0, F.lit("one text that stands again and again in this table")).otherwise(F.concat(F.lit("text number "), F.sha2(F.col("id").cast("string"), 256)))
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).cast("long")
    docs = spark.range(n, numPartitions=6).select(key.alias("doc_id"), text.alias("text"), F.lit("x").alias("WHO"), F.col("id").alias("mark"))
    out = drop(docs)
    assert out.columns == docs.columns and out.count() == 2 * n // 3 + 1
    assert out.where("doc_id = 7").count() == 1 and out.where("doc_id is null").count() == n // 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan and "WHO" in plan


def test_queries_of_the_codec_are_bounded_by_bytes():
    from tilewise.llm import bpe_codec

    words = ["\U0001f600" * 16, "a" * 64, "漢" * 8, "b"] * 2000
    for some in (words, [w.encode() for w in words]):
        lists = list(bpe_codec._batches(some))
        assert [w for part in lists for w in part] == some
        assert max(sum(min(len(w if isinstance(w, bytes) else w.encode()), bpe_codec.BLOCK_BYTES) ** 2 for w in part) for part in lists) <= bpe_codec.ROWS_PER_QUERY
    assert [len(p) for p in bpe_codec._batches(words)] == [len(p) for p in bpe_codec._batches([w.encode() for w in words])]


def test_states_of_the_counter_go_within_a_batch(monkeypatch):
    import random

    import public_tokenizers
    import sentencepiece

    from tilewise.llm import token_count

    monkeypatch.setattr(token_count, "CACHE_STATES", 50)
    path = public_tokenizers.path("piece_bpe_32k.model")
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefghinorst  ") for _ in range(rng.randrange(1, 400))) for _ in range(60)] + ["ab" * 300, ""]
    counter, most, reset = token_count.Counter(path), [], token_count.Transducer.reset

    def counted(machine):
        most.append(len(getattr(machine, "listed", ())))
        reset(machine)

    monkeypatch.setattr(token_count.Transducer, "reset", counted)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert counter.count(texts).tolist() == [len(library.encode(t)) for t in texts]
    assert len(most) > 3
