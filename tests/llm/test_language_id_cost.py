"""Floors and k-means look at filled slots only, and find what whole vectors of every cut would."""

import random

import numpy as np
import pyarrow as pa
import pytest
from corpus_samples import ODD_TEXTS

from kpiloom.llm import language_id


def texts():
    rng = random.Random(5)
    letters = "abcdefghij éß12 ,.日本\U00010400"
    return [*filter(None, ODD_TEXTS), "", "7", "a", " a", "1" * 9000 + "abc", "x" * 8192, "xy" * 4096 + "z", "12 ab" * 300] + [
        "".join(rng.choices(letters, k=n)) for n in (2, 3, 4, 5, 63, 64, 65, 700, 3000, 8191, 8193, 20000)
    ]


@pytest.fixture
def weights():
    rng = np.random.default_rng(3)
    centers = rng.random((7, language_id.DIMENSIONS)).astype(np.float32)
    return rng.random(language_id.DIMENSIONS) + 0.1, centers / np.linalg.norm(centers, axis=1, keepdims=True)


def test_cosines_of_cuts_like_whole_vectors(weights):
    idf, centers = weights
    for text in texts():
        want = []
        for cut in [text[:n] for n in language_id.CUTS if n < len(text)] + [text]:
            if (counts := language_id.gram_counts(cut)) is not None:
                v = np.log1p(counts) * idf
                cosines = centers @ v / np.linalg.norm(v)
                want.append((int(np.argmax(cosines)), language_id.length_of(counts), cosines.max()))
        got = list(zip(*language_id.prefix_cosines(text, idf, np.ascontiguousarray(centers.T))))
        assert [g[:2] for g in got] == [w[:2] for w in want], text[:40]
        assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-5, atol=0)


def test_no_whole_vector_for_a_cut(weights, monkeypatch):
    """All cuts of a text together cost what its grams do, not one vector of ``DIMENSIONS`` each."""
    idf, centers = weights
    made = []
    for name in ("unit", "gram_counts"):
        monkeypatch.setattr(language_id, name, lambda *a, f=getattr(language_id, name), name=name: (made.append(name), f(*a))[1])
    text = "ver ung ka to " * 150
    assert len(language_id.prefix_cosines(text, idf, np.ascontiguousarray(centers.T))[0]) == 13 and not made
    cut, slot, before, after = language_id.prefix_grams(text)
    assert (before < after).all() and len(np.unique(slot)) < len(slot) < 13 * len(np.unique(slot))
    assert len(np.unique(np.stack([cut, slot]), axis=1).T) == len(slot)


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_vectors_of_counts_of_every_width(weights, kind):
    idf, _ = weights
    some = [t for t in ["ab c", "a" * 300, "cd" * 40_000, "ef g", *texts()] if language_id.gram_counts(t) is not None] * 20
    counts = [language_id.gram_counts(t) for t in some]
    filled = [np.flatnonzero(c) for c in counts]
    batch = pa.RecordBatch.from_arrays([
        pa.array(["aa"] * len(some)), pa.array([f.astype(np.uint16).tobytes() for f in filled], kind),
        pa.array([c[f].astype(np.min_scalar_type(c.max())).tobytes() for c, f in zip(counts, filled)], kind),
    ], ["lang", "slots", "counts"])
    for batches in ([batch], [batch.slice(0, 1), batch.slice(1, 2), batch.slice(3), batch.slice(0, 0)]):
        row = 0
        for _, langs, at, v, ends in language_id._vectors(batches, idf):
            assert len(langs) == len(ends) - 1 <= 256
            for a, b in zip(ends, ends[1:]):
                assert np.array_equal(at[a:b], filled[row])
                assert np.allclose(v[a:b], language_id.unit(counts[row], idf)[filled[row]], rtol=1e-6, atol=0)
                row += 1
        assert row == len(some) > 256
