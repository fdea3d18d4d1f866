"""Texts of no learned language are rejected at any length; clean held-out rows stay."""

import random
import zlib

import numpy as np

from kpiloom.llm import language_id

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"
ALPHABETS = {
    "Cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "Greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "Han": "".join(chr(0x4E00 + 7 * i) for i in range(800)), "Latin": "abcdefghijklmnopqrstuvwxyz",
}


def words(rng, letters, n):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n))


def test_long_texts_of_no_learned_language(spark):
    docs = spark.read.parquet(DOCUMENTS)
    model = language_id.learn(docs)
    rng = random.Random(2)
    for name, letters in ALPHABETS.items():
        sizes = (20, 50, 200, 1000, 5000) if name != "Latin" else (50, 200, 1000, 5000)
        judged = language_id.judge([words(rng, letters, n) for n in sizes], model)
        assert all(rejected for *_, rejected in judged), (name, judged)
    held = [r["text"] for r in docs.collect() if r["lang"] and r["text"] and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    held = [t for t in held if language_id.gram_counts(t) is not None]
    assert len(held) > 150 and not any(r for *_, r in language_id.judge(held, model))
    starts = [t[:n] for t in held for n in (40, 150, 600)]
    assert np.mean([r for *_, r in language_id.judge(starts, model)]) < 0.01
