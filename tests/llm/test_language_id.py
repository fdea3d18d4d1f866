import random
import zlib

import numpy as np
import pytest
from corpus_samples import ODD_TEXTS
from pyspark.sql import functions as F

from kpiloom.llm import language_id

SYLLABLES = {"aa": "ka to mi ru shi no".split(), "bb": "ger ung sch lich ein ver".split(), "cc": "ción os ado mente ll ez".split()}


def corpus(n):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 80))]
        rows.append((i, " ".join(words), lang))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("extra")).repartition(3)


def test_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Ein Text, mit Ümläuten und 12 Zahlen; 日本語 \U00010400 " * 30
    want = language_id.gram_counts(text)
    letters = sum(c.isalpha() for c in text)
    monkeypatch.setattr(language_id, "CHUNK", 7)
    assert (language_id.gram_counts(text) == want).all() and want.sum() > letters
    assert language_id.gram_counts("12 +- 3") is None and language_id.gram_counts("") is None
    assert (language_id.gram_counts("ABC d") == language_id.gram_counts("abc d")).all()


def test_held_out_accuracy_and_folds(spark):
    rows = corpus(400)
    docs = frame(spark, rows)
    got = {r["doc_id"]: r for r in language_id.predict(docs, language_id.learn(docs)).collect()}
    truth = {i: lang for i, _, lang in rows}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [i for i, r in got.items() if r["held_out"]]
    assert len(held) > 50 and np.mean([got[i]["lang_pred"] == truth[i] for i in held]) > 0.97
    assert not any(r["rejected"] for r in got.values())


def test_held_out_labels_are_not_learned(spark):
    rows = corpus(200)
    spoiled = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in rows]
    one, two = (language_id.learn(frame(spark, x)) for x in (rows, spoiled))
    assert one.langs == two.langs and np.allclose(one.centroids, two.centroids) and np.allclose(one.idf, two.idf)


def test_idf_counts_all_learning_documents(spark):
    rows = corpus(60)
    model = language_id.learn(frame(spark, rows))
    learning = [language_id.gram_counts(t) > 0 for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5]
    want = np.log((len(learning) + 1) / (np.sum(learning, axis=0) + 1)) + 0.1
    assert np.allclose(model.idf, want)


def test_judged_like_brute_force(spark):
    rows = corpus(120)
    docs = frame(spark, rows)
    model = language_id.learn(docs)
    got = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    for i, text, _ in rows:
        v = np.log1p(language_id.gram_counts(text)) * model.idf
        cosines = [float(v @ c / np.linalg.norm(v)) for c in model.centroids]
        assert abs(got[i]["score"] - max(cosines)) < 1e-4
        assert got[i]["lang_pred"] == model.langs[int(np.argmax(cosines))]


def test_rejection_odd_texts_and_keeping(spark, docs_of):
    rows = corpus(200)
    model = language_id.learn(frame(spark, rows))
    docs = docs_of([*ODD_TEXTS, "Привет, как дела сегодня вечером", rows[0][1], rows[0][1]])
    got = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    for i in (0, 1, 2, 3):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    n = len(ODD_TEXTS)
    assert got[n]["rejected"] and not got[n + 1]["rejected"]
    kept = language_id.keep_known(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in got.items() if not r["rejected"])


def test_nothing_to_learn_from(spark, docs_of):
    for docs in (docs_of([]), docs_of(["some text", None], lang=None)):
        model = language_id.learn(docs)
        rows = language_id.predict(docs, model).collect()
        assert all(r["lang_pred"] == "und" and r["rejected"] for r in rows) and len(rows) == docs.count()
    rows = language_id.predict(docs_of([(None, "ka to"), (3, "ka to")]), language_id.learn(frame(spark, corpus(50)))).collect()
    assert {r["doc_id"]: r["held_out"] for r in rows}[None] is False


def test_no_language_is_left_out(spark):
    """1,200 languages, each of its own letters, most of them rare: all are learned and predicted."""
    draw = random.Random(12)

    def text(k):
        letters = [chr(0x4E00 + 8 * k + j) for j in range(8)]
        return " ".join("".join(draw.choices(letters, k=draw.randint(2, 5))) for _ in range(30))

    rows = [(k * 16 + j, text(k), f"l{k:04d}") for k in range(1200) for j in range(3 if k else 16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    model = language_id.learn(docs)
    learned = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 5}
    assert len(learned) > 1100 and set(model.langs) == learned
    out = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, model).collect()}
    right = [out[i] == lang for i, _, lang in rows if lang in learned]
    assert sum(right) > 0.97 * len(right)


def test_a_model_too_large_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MODEL_BYTES", 100_000)
    docs = spark.createDataFrame([(i, "some words", f"l{i}") for i in range(9)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="MODEL_BYTES"):
        language_id.learn(docs)


def test_counts_of_prefixes(monkeypatch):
    text = "12 Ab, \U00020000x " + "ver ung 3 sch " * 40
    want = [language_id.gram_counts(text[:n]) for n in language_id.CUTS if n < len(text)]
    got = [c.copy() for c in language_id.prefix_counts(text)]
    assert len(want) == 10 and all((a == b).all() for a, b in zip([w for w in want if w is not None], got, strict=True))


def test_every_learning_document_is_learned_from(spark):
    """One of 3,000 documents has a language's other half: a draw of some hundreds would nearly always miss it."""
    rows = [(i, "ka to mi ru shi no " * 5, "aa") for i in range(3000)] + [(9000 + i, "ger ung sch lich", "bb") for i in range(40)]
    odd = next(i for i in range(4000, 4100) if zlib.crc32(str(i).encode()) % 5)
    model = language_id.learn(frame(spark, rows + [(odd, "qwx vyz jfj", "aa")]))
    again = language_id.learn(frame(spark, rows + [(odd, "qwx vyz jfj", "aa")]).repartition(7))
    assert model.langs == again.langs and np.array_equal(model.centroids, again.centroids) and np.array_equal(model.floors, again.floors)
    (lang, score, rejected), = language_id.judge(["qwx vyz jfj"], model)
    assert (lang, rejected) == ("aa", False) and score > 0.99
