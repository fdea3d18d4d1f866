import zlib

import brutes
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from corpus_samples import ODD_TEXTS
from tokenizers import Tokenizer

from kpiloom.llm import language_id, packing

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(COLUMNS)
    rows = {r["doc_id"]: r for r in docs.collect()}

    found = corpus_pipeline.quality(spark, docs, SMALL)
    assert found.columns == COLUMNS
    kept = [i for i in rows if brutes.quality(rows[i]["text"])[-1]]
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(kept)

    docs = docs.where(docs.doc_id.isin(kept))
    found = corpus_pipeline.language(spark, docs, SMALL)
    model = language_id.learn(docs)
    judged = dict(zip(kept, language_id.judge([rows[i]["text"] for i in kept], model)))
    kept = [i for i in kept if not judged[i][2]]
    assert found.columns == COLUMNS and sorted(r["doc_id"] for r in found.collect()) == sorted(kept)

    docs = docs.where(docs.doc_id.isin(kept))
    found = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    least = brutes.components(kept, [brutes.fingerprint(rows[i]["text"]) for i in kept])
    kept = sorted(set(least))
    assert found.columns == COLUMNS and sorted(r["doc_id"] for r in found.collect()) == kept

    docs = docs.where(docs.doc_id.isin(kept))
    found = corpus_pipeline.passages(spark, docs, SMALL)
    cut = brutes.without_repeats([(i, rows[i]["text"]) for i in kept])
    texts = {i: t for (i, _), t in cut.items()}
    assert found.columns == COLUMNS and {r["doc_id"]: r["text"] for r in found.collect()} == texts

    found = corpus_pipeline.sequences(spark, found, SMALL).collect()
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = []
    for i, t in texts.items():
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want += [(i, p, s, n, zlib.crc32(ids[s : s + n].tobytes())) for p, (s, n) in enumerate(packing.piece_bounds(len(ids)))]
    assert sorted(tuple(r)[:5] for r in found) == sorted(want)

    run = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(tuple(r)[:5] for r in run) == sorted(want)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_take_odd_and_empty_tables(spark, docs_of, name, stage):
    for docs in (docs_of([]), docs_of([*ODD_TEXTS, (None, "a null id, and words " * 4)], lang="en")):
        found = stage(spark, docs, SMALL)
        assert found.columns == docs.columns and found.count() <= docs.count()


def test_one_operator_per_stage():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "language id", "simhash near-dedup", "substring dedup", "best-fit packing"]
