import zlib

import numpy as np
import pytest
from corpus_samples import ODD_TEXTS

from kpiloom.llm import quality_classifier as qc

LABELS = "doc_id long, quality int, toxic int, text string"


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def corpus(n=240):
    draw = np.random.default_rng(3)
    syllables = ["an", "the", "ing", "ou", "re", "st", "ble", "or"]

    def word():
        return "".join(draw.choice(syllables, draw.integers(1, 4)))

    rows = []
    for i in range(n):
        words = [word() for _ in range(draw.integers(20, 80))]
        kind = i % 4
        if kind == 1:
            words = [words[0]] * len(words)
        elif kind == 2:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), int(kind in (0, 3))))
    return rows


@pytest.fixture(scope="module")
def model(spark, docs_of):
    rows = corpus()
    docs = docs_of([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, q, 0, "clash") for i, _, q in rows if i % 3], LABELS)
    return qc.learn(docs, labels)


def test_held_out_accuracy(spark, docs_of, model):
    rows = corpus()
    out = {r["doc_id"]: r for r in qc.score_documents(docs_of([(i, t) for i, t, _ in rows]), model).collect()}
    tested = [(i, q) for i, _, q in rows if held_out(i)]
    assert len(out) == len(rows) and all(out[i]["held_out"] == held_out(i) for i, *_ in rows)
    assert np.mean([out[i]["predicted"] == q for i, q in tested]) >= 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in out.values())


def test_held_out_labels_are_never_learned_from(spark, docs_of):
    rows = corpus(60)
    docs = docs_of([(i, t) for i, t, _ in rows])
    one = qc.learn(docs, spark.createDataFrame([(i, q, 0, "") for i, _, q in rows], LABELS))
    two = qc.learn(docs, spark.createDataFrame([(i, 1 - q if held_out(i) else q, 0, "") for i, _, q in rows], LABELS).repartition(5))
    assert np.array_equal(one.vectors, two.vectors) and np.array_equal(one.weights, two.weights)


def slow_slots(text):
    """Features by plain loops: slots of words, neighbouring pairs and character grams."""
    data, mask, out = b" " + text.encode() + b" ", (1 << 64) - 1, []

    def slot(h, kind):
        return ((h + kind) * 0x9E3779B97F4A7C15 & mask) >> 48

    odd = [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F]
    for n in (3, 4):
        for i in range(len(data) - n + 1):
            if any(c in b" \t\n\x0b\x0c\r" for c in data[i + 1 : i + n - 1]):
                continue
            h = data[i] * odd[0] & 0xFFFFFFFF
            for k in range(1, n):
                h ^= (data[i + k] + k) * odd[k] & 0xFFFFFFFF
                h = (h << 7 | h >> 25) & 0xFFFFFFFF
            out.append(slot(h, n))
    before = None
    for w in data.split():
        h = sum((c + 1) * pow(0x100000001B3, k, 1 << 64) for k, c in enumerate(w)) & mask
        out.append(slot(h, 1))
        if before is not None:
            out.append(slot(0 if h == before else (before * 31 + h) & mask, 2))
        before = h
    return sorted(out)


def test_slots_by_plain_loops_alone_and_in_company():
    texts = ["one two two  three\n", "", "é", "a b", " x ", "word word word"]
    at, whose = qc.slots([t.encode() for t in texts])
    for k, t in enumerate(texts):
        assert sorted(at[whose == k].tolist()) == slow_slots(t)
        assert sorted(qc.slots([t.encode()])[0].tolist()) == slow_slots(t)


def test_scores_are_the_softmax_of_the_mean_vector(model):
    texts = ["the an ou", "an an an an", "the### ou###", "", "z" * 50]
    got = qc.scores(texts, *model.per_slot())
    for t, p in zip(texts, got):
        at = slow_slots(t)
        mean = model.vectors[at].mean(axis=0) if at else np.zeros(qc.DIMENSIONS)
        z = mean @ model.weights + model.bias
        assert p == pytest.approx(np.exp(z[1]) / np.exp(z).sum(), abs=1e-6)


def test_a_step_follows_the_gradient():
    bags = [qc.bag("one two three"), qc.bag("### $$$ ###")]
    model = qc.train(bags, [1, 0])
    assert qc.scores(["one two three"], *model.per_slot())[0] > 0.9 and qc.scores(["### $$$ ###"], *model.per_slot())[0] < 0.1


def test_odd_rows(spark, docs_of, model):
    texts = ODD_TEXTS + [" " * 10**6, "\n" * 10**6, "x" * 3 * 10**6, "ab " * 10**6, (None, "no id"), (None, None)]
    rows = qc.score_documents(docs_of(texts), model).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (0, 1, 2)}
    assert len(empty) == 1 and not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert qc.score_documents(docs_of([]), model).collect() == []


def test_odd_labels(spark, docs_of):
    docs = docs_of([(1, "good text here"), (1, "good text here"), (4, "bad"), (5, None), (None, "x")])
    labels = spark.createDataFrame(
        [(1, 1, 0, ""), (1, 1, 0, ""), (4, 0, 0, ""), (4, 1, 0, ""), (5, None, 0, ""), (9, 0, 0, ""), (None, 1, 0, ""), (5, 7, 0, "")],
        LABELS,
    )
    model = qc.learn(docs, labels)
    assert qc.scores(["good text here"], *model.per_slot())[0] > 0.5
    nothing = qc.learn(docs, labels.where("doc_id = 77"))
    assert {r["score"] for r in qc.score_documents(docs, nothing).collect()} == {0.5}
    assert qc.score_documents(docs_of([]), qc.learn(docs_of([]), labels)).collect() == []


def test_sample_is_bounded(spark, docs_of):
    rows = corpus(200)
    labels = spark.createDataFrame([(i, q, 0, "") for i, _, q in rows], LABELS)
    model = qc.learn(docs_of([(i, t) for i, t, _ in rows]), labels, sample=40)
    good = [q == int(p >= 0.7) for (_, _, q), p in zip(rows, qc.scores([t for _, t, _ in rows], *model.per_slot()))]
    assert np.mean(good) > 0.7
