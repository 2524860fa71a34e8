"""A corpus preparation pipeline over the table ``documents``, in stages of Parquet to Parquet.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return the columns of ``documents``.

In all stages: columns beside key and text are carried as they are, whatever their names and nulls; texts of any length are
read whole; null keys and repeated keys are kept apart by their texts; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tilewise.llm import bpe_codec, decontam, exact_dedup, langid, simhash
from tilewise.llm.common import scratch_tables, written_alone


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one of the languages learned from the labelled ones; the others go.

    Null texts and texts without a letter go, as do all where nothing is labelled; repeated rows stay or go alike.
    """
    return langid.keep_known(docs, langid.fit(docs))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest doc_id.

    Null text equals the empty one; a null doc_id loses to any other; of rows that tie in both, any one stays.
    """
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, linked as ``op10_simhash`` links them.

    The smallest doc_id stays (null last); of several texts with that doc_id the first by SHA-256, of equal rows any one.
    """
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that they share with the benchmark; a document of nothing else goes.

    Null and empty texts stay as they are; repeated rows are cut alike; with an empty benchmark nothing changes.
    """
    return decontam.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the text that the ids decode to; a null text gives no ids and an empty text."""
    return bpe_codec.encode_and_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]

#: Language models and byte-pair merges are not SQL; tests hold the pipeline against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written to the shared folder and read again.

    Calling this runs all stages but the last. The intermediate tables of a stage are dropped once its result is written.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch_tables()
    for name, stage in STAGES[:-1]:
        docs = written_alone(stage(spark, docs, sf_dir), name, before)
    return STAGES[-1][1](spark, docs, sf_dir)
