"""The pipeline's stages: what goes, what stays, and the whole against plain Python."""

from collections import Counter

import cases
import plain
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tilewise.llm import langid
from tilewise.llm.bpe_codec import read_ranks


def test_stages_keep_columns_and_decide(spark, tables):
    docs = cases.documents(spark)
    at, sizes = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, tables[0])
        assert at.columns == docs.columns and at.dtypes == docs.dtypes
        sizes.append(at.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[2] < sizes[1] < sizes[0]
    last = corpus_pipeline.STAGES[-1][1](spark, at, tables[0])
    assert sorted(r.decoded for r in last.collect()) == sorted(r.text or "" for r in at.collect())


@pytest.mark.parametrize("which", ["edge cases, repeated and null keys", "sf0.001"])
def test_run_equals_plain_python(spark, sf_dir, tables, which):
    path = sf_dir if which == "sf0.001" else tables[0]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rejected = {r.text for r in langid.predict(docs, langid.fit(docs), "text").where("rejected").collect()}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.text not in rejected]
    rows = plain.one_of_each_component(plain.largest_id_of_equal_texts(rows))
    windows = plain.windows_of([(r.item_id, r.text) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()])
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    expected = Counter()
    for i, text in rows:
        hit, _ = plain.hits(text, windows)
        if not hit or len(hit) < len(plain.words(text)):
            left = plain.without_hits(text or "", hit)
            expected[i, left, tuple(library.encode_ordinary(left))] += 1
    got = corpus_pipeline.run(spark, path).collect()
    assert Counter((r.doc_id, r.decoded, tuple(r.ids)) for r in got) == expected and all(r.n_tokens == len(r.ids) for r in got)
    assert not any(plain.hits(t, {w: x for w, x in windows.items() if len(w) == 10})[0] for _, t, _ in expected)


def test_empty_input(spark, tables):
    assert corpus_pipeline.run(spark, tables[1]).count() == 0
