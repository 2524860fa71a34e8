"""Cases in which operators once did less than the whole job."""

import zlib
from collections import Counter

import cases
import numpy as np
import public_tokenizers

from tilewise.llm import license_scan, simhash, token_shards, url_filter


def test_unlike_texts_with_one_key_or_none_stay(spark):
    texts = [cases.BODY, cases.FRENCH, "日本語のテキスト 一 二 三 四 五", "alpha beta gamma delta epsilon zeta eta theta"]
    prints = [simhash.fingerprint_of(simhash.shingle_hashes(t)) for t in texts]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
    rows = [(500, texts[0], 1), (500, texts[1], 2), (None, texts[2], 3), (None, texts[3], 4), (500, texts[0], 1), (None, texts[3], 4), (501, texts[1], 5), (None, texts[1], 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark int").repartition(3)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("mark < 5").distinct().collect()))


def test_op2_added_tokens_are_the_librarys(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a{end}b", end, f"{end}{end} x ", f"don{end}'t  {end}\n\n y", "<|endoftext", f"<|endoftext{end}|>", "", f" {end}", "plain text"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected, start = Counter(), 0
    for i, t in enumerate(texts):
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        expected[i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())] += 1
        start += len(ids)
    got = token_shards.encode_and_read(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    assert Counter(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == expected


def labels_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan.report(docs).collect()}
    return [got[i] for i in range(len(texts))]


def test_op8_notices_wrapped_over_lines(spark):
    import textwrap

    long = [(label, t) for label, t in license_scan.TEMPLATES if len(t) > 100]
    assert len(long) == 4
    for width in (30, 76):
        texts = [f"{cases.BODY}\n" + "\n".join(f" * {x}" for x in textwrap.wrap(t, width)) + f"\n{cases.BODY}" for _, t in long]
        assert [x.split(",") for x in labels_of(spark, texts)] == [[label] for label, _ in long]
    # As the licence has it, with words that the template leaves out.
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights"
    assert labels_of(spark, [mit, "Licensed under the GNU General Public License,\nversion 3", "All\n" + cases.BODY + " rights\n" + cases.BODY + " reserved"]) == ["mit", "gpl", ""]


def test_op8_unrelated_notices_on_one_line(spark):
    texts = [
        "Licensed under CC BY 4.0. All rights reserved.",
        "All rights reserved. Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 or licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 2.0",
        "Licensed under CC BY-NC 4.0",
        " ".join([license_scan.TEMPLATES[6][1], cases.BODY, license_scan.TEMPLATES[10][1], cases.BODY, license_scan.TEMPLATES[4][1]]),
    ]
    # cc-by-nc and cc-by-sa have six of their seven words in the first, as many as cc-by: ties stay, as in the SQL.
    assert labels_of(spark, texts) == ["all-rights-reserved,cc-by,cc-by-nc,cc-by-sa", "all-rights-reserved,apache", "apache,gpl", "gpl", "cc-by-nc", "bsd,cc-by-nc,gpl"]


def test_op3_hosts_without_a_path(spark):
    urls = ["http://spam-farm.example.org", "http://cheap-pills.biz?x=1", "http://a.cheap-pills.biz#t", "http://spam-farm", "http://spam-farming.org", "http://foo.com", "http://spam-farm.com/", "http://spam-farm.org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.url_verdict.verdict for r in url_filter.judge(pages).collect()}
    assert [got[i] for i in range(len(urls))] == ["block"] * 4 + ["allow"] * 3 + ["block"]


def test_op2_grammar_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(3)
    for ids in (np.tile(rng.integers(0, 50000, 500), 800), np.zeros(5000, dtype=np.int64), rng.integers(0, 50, 20000)):
        rules, lengths, seq = token_shards.grammar(ids.astype(np.uint32))
        assert np.array_equal(token_shards.expand(seq, rules, lengths), ids)
        places = Counter(zip(seq.tolist(), seq[1:].tolist(), strict=False))
        assert len(rules) == token_shards.MAX_RULES or all(n < token_shards.MIN_COUNT or (a == b and n < 2 * token_shards.MIN_COUNT) for (a, b), n in places.items())
