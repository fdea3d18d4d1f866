"""A training-data pipeline over ``documents``: judge, filter, deduplicate, cut, pack.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; what a stage
returns is written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``documents``; the last one a row per packed piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kpiloom.llm import language_id, line_dedup, packing, quality_rules, simhash
from kpiloom.session import stage

TOKENIZER = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a learned language; learned from what the first stage kept."""
    return language_id.keep_known(docs, language_id.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id."""
    return simhash.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with passages that stand in an earlier one cut out."""
    return line_dedup.remove_repeats(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 1024."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", quality),
    ("language id", language),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", passages),
    ("best-fit packing", sequences),
]

#: Centroids, fingerprints and tokens are beyond SQL; a test runs the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
