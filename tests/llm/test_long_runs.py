"""Runs of a million blanks, newlines, letters and marks, through every operator and every stage."""

import corpus_pipeline
import public_tokenizers
import pytest

from kpiloom.llm import (
    bpe,
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
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
M = 10**6
GOOD = " ".join(f"word{i} and some more of it" for i in range(40))
TEXTS = [" " * M, "\n" * M, "x" * M, "!" * M, "é" * M, "日" * M, " \n" * (M // 2), f"{GOOD}{' ' * M}{GOOD}", f"{GOOD}{chr(10) * M}", GOOD]

#: One row per document.
OPERATORS = {
    "syncmers": lambda d: syncmers.edit_likeness(d),
    "language_id": lambda d: language_id.predict(d, language_id.learn(d)),
    "license_scan": lambda d: license_scan.scan(d),
    "hilbert_shards": lambda d: hilbert_shards.shard_documents(d),
    "quality_rules": lambda d: quality_rules.judge(d),
    "bpe": lambda d: bpe.round_trip(d, PATH),
    "simhash": lambda d: simhash.groups(d),
    "line_dedup": lambda d: line_dedup.repeats(d),
    "quality_classifier": lambda d: quality_classifier.score_documents(d, quality_classifier.untrained()),
}


@pytest.fixture(scope="module")
def docs(docs_of):
    return docs_of(TEXTS, lang="en")


@pytest.mark.parametrize("name", list(OPERATORS))
def test_operators(docs, name):
    assert sorted(r["doc_id"] for r in OPERATORS[name](docs).select("doc_id").collect()) == list(range(len(TEXTS)))


def test_operators_with_other_rows(docs):
    pieces = packing.pack_documents(docs, PATH).collect()
    assert {r["doc_id"] for r in pieces} == set(range(len(TEXTS)))
    assert phrases.collocations(docs, least=3).count() > 0
    assert spelling.variants(docs).count() == 0  # each long word stands once


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, name, stage):
    assert stage(spark, docs, "/root/testdata/sf0.001").count() >= (0 if name != "best-fit packing" else len(TEXTS))
