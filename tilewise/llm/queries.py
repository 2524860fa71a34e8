"""The registered ``opN_*`` queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, centroids, collocations, decontam, exact_dedup, langid, license_scan, secret_scan, simhash, token_count, token_shards, url_filter, warc
from .sql import ORACLES

OVER_LIMIT = 4096
#: ``WARC-Date`` of derived records: a parameter of a run, so that running it again gives the same bytes.
RECORDS_MADE = "2024-01-01T00:00:00Z"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.encode_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "url_verdict.host", "url_verdict.path", "url_verdict.rule", "url_verdict.verdict", "url_verdict.matched")


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table has no capture dates, so none is given for the responses; records have the date of the run, a parameter.
    return warc.derivatives(warc.responses_of_pages(table(spark, sf_dir, "pages")), "page_id", RECORDS_MADE)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > OVER_LIMIT)


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs))
    held = F.coalesce(~langid.may_learn("doc_id"), F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_shards": op2_token_shards,
    "op3_url_filter": op3_url_filter,
    "op4_warc_derivatives": op4_warc_derivatives,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_license_scan": op8_license_scan,
    "op9_language_id": op9_language_id,
    "op10_simhash": op10_simhash,
    "op11_centroids": op11_centroids,
    "op12_secret_scan": op12_secret_scan,
    "op13_collocations": op13_collocations,
}

__all__ = ["ORACLES", "QUERIES"]
