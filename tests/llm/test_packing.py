import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from corpus_samples import ODD_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kpiloom.llm import packing
from kpiloom.session import stage

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


@given(st.lists(st.integers(1, 20), max_size=60))
@settings(max_examples=200, deadline=None)
def test_best_fit_is_best_fit(sizes):
    rooms, want = [], []
    for size in sizes:
        fitting = [b for b, room in enumerate(rooms) if room >= size]
        b = min(fitting, key=lambda b: rooms[b]) if fitting else len(rooms)
        if not fitting:
            rooms.append(20)
        rooms[b] -= size
        want.append(b)
    got = packing.best_fit(sizes, 20)
    used = {}
    for size, b in zip(sizes, got):
        used[b] = used.get(b, 0) + size
    assert sorted(used.values()) == sorted(20 - r for r in rooms)  # bins of one room are alike


@pytest.mark.parametrize("n, want", [
    (0, []), (1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)]), (17, [(0, 1), (1, 8), (9, 8)]),
])
def test_only_the_first_piece_is_shorter(n, want):
    assert packing.piece_bounds(n, 8) == want


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for parts in by.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= capacity
    return len(by)


@pytest.mark.parametrize("per_task", [10, 100, 100_000])
def test_rounds_keep_every_piece(spark, per_task):
    rng = random.Random(per_task)
    lengths = [rng.choice([1, 5, 100, 60, rng.randint(1, 100)]) for _ in range(900)]
    pieces = stage(spark.createDataFrame(
        [(i // 2, i % 2, 0, n, i) for i, n in enumerate(lengths)],
        "doc_id long, piece int, start long, length long, ids_crc32 long"))
    rows = packing.pack(pieces, 100, per_task).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows) == sorted(
        (i // 2, i % 2, n, i) for i, n in enumerate(lengths))
    # best fit over all items at once; rounds of ten items have little to choose from
    at_once = max(packing.best_fit(sorted(lengths, reverse=True), 100)) + 1
    assert check(rows, 100) <= at_once * {10: 1.2, 100: 1.05, 100_000: 1.0}[per_task]


def test_items_too_large_to_pair_end_at_once(spark):
    pieces = stage(spark.createDataFrame(
        [(i, 0, 0, 60, 0) for i in range(200)], "doc_id long, piece int, start long, length long, ids_crc32 long"))
    assert check(packing.pack(pieces, 100, 10).collect(), 100) == 200


def test_documents(spark, docs_of):
    rows = list(enumerate(ODD_TEXTS)) + [(50, "a <|endoftext|> b"), (50, "a <|endoftext|> b"), (None, "x"), (51, "word " * 1023)]
    docs = docs_of(rows)
    got = packing.pack_documents(docs, PATH).collect()
    want = []
    for i, t in rows:
        ids = np.array(ids_of(t), dtype="<u4")
        want += [(i, p, s, n, zlib.crc32(ids[s : s + n].tobytes())) for p, (s, n) in enumerate(packing.piece_bounds(len(ids)))]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    check(got, 1024)


@pytest.mark.parametrize("run", [" ", "\n", "x", "!", " \t", "日", "a "])
def test_runs_of_a_million(spark, docs_of, run):
    text = run * 10**6
    got = packing.pack_documents(docs_of([text, f"before {text}after"]), PATH).collect()
    want = []
    for i, t in enumerate([text, f"before {text}after"]):
        ids = np.array(ids_of(t), dtype="<u4")
        want += [(i, p, s, n, zlib.crc32(ids[s : s + n].tobytes())) for p, (s, n) in enumerate(packing.piece_bounds(len(ids)))]
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    check(got, 1024)


@given(st.text(max_size=200) | st.text(alphabet=" \n\t\r\u00a0\u3000'as!1é日\x00", max_size=300))
@settings(max_examples=300, deadline=None)
def test_ids_are_the_librarys(text):
    text = text.encode("utf-8", "ignore").decode()
    assert packing.ids_of(text, packing.fast_encoding(PATH), PATH).tolist() == ids_of(text)[:-1]


def test_sequences_hold_the_ids(spark, docs_of):
    texts = [f"document {i} " * (1 + 37 * i % 300) for i in range(40)]
    pieces = stage(packing.token_pieces(docs_of(texts), PATH, with_ids=True))
    placed = packing.pack(pieces)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(pieces, placed).collect()}
    for r in placed.collect():
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == ids_of(
            texts[r["doc_id"]])[r["start"] : r["start"] + r["length"]]


def test_empty_table(spark, docs_of):
    assert packing.pack_documents(docs_of([]), PATH).count() == 0
