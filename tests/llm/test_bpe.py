import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from corpus_samples import ODD_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kpiloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.text(max_size=60), st.text(alphabet="ab ", max_size=60), st.text(alphabet="aeithn'lrs\n 09", max_size=80),
    st.sampled_from(["<|endoftext|>", " <|endoftext|>x<|endoftext|>", "'ll 're", " 　 \t\n x", "½²१"]),
), max_size=6))
def test_ids_equal_the_library(texts):
    joined = "".join(texts)
    ids = bpe.Encoder(PATH).encode([*texts, joined])
    assert [x.tolist() for x in ids] == [library_ids(t) for t in [*texts, joined]]
    assert [bpe.decode_ids(x, bpe.vocabulary(PATH)) for x in ids] == [*texts, joined]


def test_words_remembered_and_forgotten(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    rng = random.Random(1)
    encoder = bpe.Encoder(PATH)
    for _ in range(12):
        texts = [" ".join("".join(rng.choice("abcdeh") for _ in range(rng.randint(1, 8))) for _ in range(30))] * 2
        assert [x.tolist() for x in encoder.encode(texts)] == [library_ids(t) for t in texts]


def test_overlapping_places():
    words = [b"a" * n for n in range(1, 40)] + [b" " * n for n in range(1, 30)] + [b"abababab", b""]
    ids, counts = bpe.merge_words(words, bpe.vocabulary(PATH))
    at = np.concatenate(([0], np.cumsum(counts)))
    for i, w in enumerate(words):
        if not w.startswith(b" "):
            assert ids[at[i] : at[i + 1]].tolist() == library_ids(w.decode())


def test_long_texts_are_drawn_word_by_word(monkeypatch):
    text = "some words, 12 of them\n" * 50
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    assert bpe.Encoder(PATH).encode([text])[0].tolist() == library_ids(text)


def test_rows(spark, docs_of, monkeypatch):
    rows = list(enumerate(ODD_TEXTS)) + [(50, "<|endoftext|> in a text"), (50, "<|endoftext|> in a text"), (None, "x")]
    docs = docs_of(rows)
    want = sorted((
        (i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
         hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        for i, t in rows for ids in [library_ids(t)]
    ), key=repr)
    assert sorted(map(tuple, bpe.round_trip(docs, PATH).collect()), key=repr) == want
    tokens = bpe.encode(docs, PATH)
    assert sorted(((r["doc_id"], r["ids"]) for r in tokens.collect()), key=repr) == sorted(
        ((i, library_ids(t)) for i, t in rows), key=repr)
    assert sorted(map(tuple, bpe.decode(tokens, PATH).collect()), key=repr) == sorted(
        ((i, t or "") for i, t in rows), key=repr)


def test_empty_table(spark, docs_of):
    assert bpe.round_trip(docs_of([]), PATH).count() == 0
    assert bpe.decode(bpe.encode(docs_of([]), PATH), PATH).count() == 0


@pytest.mark.parametrize("sizes", [[], [3], [9, 9, 9]])
def test_blocks(monkeypatch, sizes):
    import pyarrow as pa

    monkeypatch.setattr(bpe, "BLOCK_CHARS", 10)
    texts = ["x" * n for n in sizes] + [None]
    held = list(bpe.blocks(pa.array(texts, pa.string())))
    assert [t for _, part in held for t in part] == [t or "" for t in texts]
    assert [s for s, _ in held] == [sum(len(p) for _, p in held[:k]) for k in range(len(held))]
