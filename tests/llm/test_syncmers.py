import hashlib
import random

import numpy as np
import pytest
from corpus_samples import ODD_TEXTS
from pyspark.sql import functions as F

from kpiloom.llm import syncmers


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgéü") for _ in range(rng.randint(1, 9))) for _ in range(n))


@pytest.mark.parametrize("k, s", [(32, 8), (16, 4), (13, 4)])
def test_definition(k, s):
    text = prose(random.Random(k), 400)
    points = syncmers.code_points(text)
    at, mark = syncmers.syncmers(points, k, s)
    assert set(np.diff(at, prepend=0, append=len(text) - k).tolist()) <= set(range(k - s + 1))
    whole = {}
    for i in range(len(text) - k + 1):  # whether and how a window is chosen depends on itself alone
        alone = syncmers.syncmers(syncmers.code_points(text[i : i + k]), k, s)
        whole[i] = alone[1].tolist()
    assert at.tolist() == [i for i, m in whole.items() if m]
    assert mark.tolist() == [m[0] for m in whole.values() if m]


def plain_hash(window):
    """Hash of a substring whose length is a power of two, in whole numbers."""
    m, full = [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], (1 << 64) - 1

    def raw(x):
        if len(x) == 1:
            return ord(x) * m[0] & full
        half = len(x) // 2
        return (raw(x[:half]) * (m[1] + len(x)) + raw(x[half:])) & full

    h = raw(window)
    h = (h ^ h >> 30) * m[1] & full
    h = (h ^ h >> 27) * m[2] & full
    return h ^ h >> 31


@pytest.mark.parametrize("k, s", [(32, 8), (16, 4), (13, 4), (2, 1)])
def test_least_inner_substring_lies_at_an_edge(k, s):
    """The definition, window by window, from hashes recomputed without the module."""
    text = prose(random.Random(k + 50), 120) + "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"
    want = []
    for i in range(len(text) - k + 1):
        inner = [plain_hash(text[i + j : i + j + s]) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            want.append(i)
    assert syncmers.syncmers(syncmers.code_points(text), k, s)[0].tolist() == want and len(want) > 20


@pytest.mark.parametrize("n", [4, 8, 20, 40, 63, 64, 100, 400])
def test_texts_of_any_length_that_keep_three_quarters_are_alike(n):
    rng, near = random.Random(n), []
    for _ in range(40):
        text, other = prose(rng, n)[:n], prose(rng, n)[:n]
        kept = n - n // 4
        edited = syncmers.marks_of_edited(text, syncmers.marks_of(text), kept, other[: n // 4])
        near.append(syncmers.likeness(syncmers.marks_of(text), edited))
    assert np.mean(near) > 0.5 and (n > 100 or n >= 64 or min(near) > 0.3)


def test_stretches_and_packing(monkeypatch):
    text = prose(random.Random(1), 500)
    want = syncmers.marks_of(text)
    monkeypatch.setattr(syncmers, "STEP", 100)
    got = syncmers.marks_of(text)
    assert all((a == b).all() for a, b in zip(want, got))
    back = syncmers.unpacked_marks(syncmers.packed_marks(got))
    assert all((a == b).all() for a, b in zip(want, back))


def test_edited_marks_equal_those_of_the_edited_text():
    rng = random.Random(2)
    for n in [0, 1, 3, 4, 20, 31, 32, 33, 40, 56, 60, 90, 200, 1000]:
        text, other = prose(rng, n + 1)[:n], prose(rng, n + 1)[: rng.choice([0, 5, n])]
        kept = n - n // 4
        got = syncmers.marks_of_edited(text, syncmers.marks_of(text), kept, other[: n // 4])
        want = syncmers.marks_of(text[:kept] + other[: n // 4])
        assert [x.tolist() for x in got] == [x.tolist() for x in want]


def test_likeness():
    rng = random.Random(3)
    text, other = prose(rng, 600), prose(rng, 600)
    a, b = syncmers.marks_of(text), syncmers.marks_of(other)
    assert syncmers.likeness(a, a) == 1.0 and syncmers.likeness(a, b) < 0.02
    cut = len(text) // 4
    edited = syncmers.marks_of(text[:-cut] + other[:cut])
    assert 0.68 < syncmers.likeness(a, edited) < 0.8
    swapped = syncmers.marks_of(text[len(text) // 2 :] + text[: len(text) // 2])
    assert 0.4 < syncmers.likeness(a, swapped) < 0.6  # order counts
    none = syncmers.marks_of("")
    assert syncmers.likeness(none, none) == 1.0 and syncmers.likeness(none, a) == 0.0


def brute(rows):
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        m = len(text) // 4
        edited = text[: len(text) - m] + following[:m]
        a, e, n = (syncmers.marks_of(x) for x in (text, edited, following))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), syncmers.packed_marks(a),
                    syncmers.packed_marks(e), syncmers.likeness(a, e), syncmers.likeness(a, n)))
    return out


@pytest.mark.parametrize("n", [1, 2, 60])
def test_query_rows_against_brute_force(spark, docs_of, n):
    rng = random.Random(4)
    texts = (ODD_TEXTS + [prose(rng, rng.randint(1, 200)) for _ in range(60)])[-n - 5 : -5]
    rows = sorted((rng.randrange(-10**12, 10**12), t) for t in texts)
    got = syncmers.edit_likeness(docs_of(rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_odd_texts(spark, docs_of):
    rows = list(enumerate(ODD_TEXTS))
    got = syncmers.edit_likeness(docs_of(rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_repeats_null_ids_and_empty(spark, docs_of):
    rows = [(None, "null id " * 20), *[(5, "same text " * 30)] * 40, (9, None)]
    got = sorted(map(tuple, syncmers.edit_likeness(docs_of(rows)).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)
    assert syncmers.edit_likeness(docs_of([])).count() == 0


def test_columns_of_fingerprints(spark, docs_of):
    found = syncmers.fingerprints(docs_of(["some words " * 20, "some words " * 20, "others, quite others, " * 9]))
    a, b = found.where("doc_id < 2").select(F.col("fingerprint").alias("x")), found.where("doc_id = 1")
    rows = a.join(b).select(syncmers.compare(F.col("x"), F.col("fingerprint")).alias("near")).collect()
    assert [r["near"] for r in rows] == [1.0, 1.0]
