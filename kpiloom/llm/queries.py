"""Registered queries of this subpackage, each next to the SQL it must agree with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kpiloom.llm import (
    bpe,
    checks,
    hilbert_shards,
    language_id,
    license_scan,
    line_dedup,
    packing,
    phrases,
    quality_classifier,
    quality_rules,
    simhash,
    spelling,
    syncmers,
    warc,
)


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_syncmers(spark: SparkSession, directory: str) -> DataFrame:
    return syncmers.edit_likeness(_table(spark, directory, "documents"))


def op2_language_id(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    return language_id.predict(docs, language_id.learn(docs))


def op3_license_scan(spark: SparkSession, directory: str) -> DataFrame:
    return license_scan.scan(_table(spark, directory, "documents"))


def op4_hilbert_shards(spark: SparkSession, directory: str) -> DataFrame:
    return hilbert_shards.shard_documents(_table(spark, directory, "documents"))


def op5_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    return quality_rules.judge(_table(spark, directory, "documents")).drop("reason")


def op6_best_fit_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack_documents(_table(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_bpe(spark: SparkSession, directory: str) -> DataFrame:
    return bpe.round_trip(_table(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_simhash(spark: SparkSession, directory: str) -> DataFrame:
    found = simhash.groups(_table(spark, directory, "documents"))
    return found.select("doc_id", simhash.hex_digits(found["fp"]).alias("fingerprint"), "component_id")


def op9_warc(spark: SparkSession, directory: str) -> DataFrame:
    index = warc.archive(_table(spark, directory, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return line_dedup.repeats(_table(spark, directory, "documents"))


def op11_collocations(spark: SparkSession, directory: str) -> DataFrame:
    return phrases.collocations(_table(spark, directory, "documents"))


def op12_quality_classifier(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    return quality_classifier.score_documents(docs, quality_classifier.learn(docs, _table(spark, directory, "labels")))


def op13_spelling_variants(spark: SparkSession, directory: str) -> DataFrame:
    return spelling.variants(_table(spark, directory, "documents"))


QUERIES = {
    "op1_syncmers": op1_syncmers,
    "op2_language_id": op2_language_id,
    "op3_license_scan": op3_license_scan,
    "op4_hilbert_shards": op4_hilbert_shards,
    "op5_quality_rules": op5_quality_rules,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_bpe": op7_bpe,
    "op8_simhash": op8_simhash,
    "op9_warc": op9_warc,
    "op10_line_dedup": op10_line_dedup,
    "op11_collocations": op11_collocations,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_spelling_variants": op13_spelling_variants,
}
CHECKS: dict[str, str] = {
    "op5_quality_rules": checks.QUALITY_RULES,
    "op9_warc": checks.WARC,
    "op11_collocations": checks.COLLOCATIONS,
}
