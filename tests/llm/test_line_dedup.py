import random
import re

import brutes
from corpus_samples import ODD_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import line_dedup


def sentences(rng, n):
    return " ".join(
        " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(1, 14))).capitalize() + rng.choice(".!?")
        for _ in range(n)
    )


def test_against_brute_force(spark, docs_of):
    rng = random.Random(5)
    passages = [sentences(rng, 9) for _ in range(6)]
    rows = list(enumerate(ODD_TEXTS))
    for i in range(60):
        words = sentences(rng, 12).split(" ")
        for _ in range(rng.randint(0, 2)):
            words.insert(rng.randrange(len(words)), rng.choice(passages))
        words.insert(rng.randrange(len(words)), "\n")
        rows.append((100 + i, " ".join(words)))
    rows += [(200, rows[-1][1]), (201, rows[-2][1].upper()), (None, rows[-3][1]), (202, passages[0]), (202, passages[0])]
    docs = docs_of(rows)
    want = brutes.without_repeats(rows)
    got = [(r["doc_id"], r["text"]) for r in line_dedup.repeats(docs).collect()]
    assert sorted(got, key=repr) == sorted([(i, want[i, t]) for i, t in rows], key=repr)
    kept = line_dedup.remove_repeats(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(got, key=repr)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) and r["size"] == "extra" for r in kept.collect())


@given(st.text(max_size=120) | st.text(alphabet="aB1_é ÀŒǅĳʯªß.,;'\")\n\t\x1c\x85\xa0×İ日", max_size=200))
@settings(max_examples=500, deadline=None)
def test_the_faster_patterns_give_the_same_units(text):
    got = list(line_dedup.units(text))
    fast, line_dedup._OTHER = line_dedup._OTHER, re.compile("")  # finds something in every text
    try:
        assert got == list(line_dedup.units(text))
    finally:
        line_dedup._OTHER = fast
    assert [u[:-1] for u in got] == [u[:-1] for u in line_dedup.units(text, hashed=False)]


def test_offsets_point_into_the_original(spark, docs_of):
    rng = random.Random(6)
    passage = sentences(rng, 12)
    texts = [f"{sentences(rng, 3)} not ended {passage} and ünïcödé \U0001f600 {sentences(rng, 3)}" for _ in range(8)]
    rows = {r["doc_id"]: r for r in line_dedup.repeats(docs_of(texts)).collect()}
    assert rows[0]["text"] == texts[0] and rows[0]["n_cut"] == 0 and rows[0]["cut"] == ""
    for i in range(1, 8):
        places = [tuple(map(int, p.split("-"))) for p in rows[i]["cut"].split(";")]
        assert len(places) == 1 == rows[i]["n_cut"]
        start, stop = places[0]
        assert rows[i]["text"] == texts[i][:start] + texts[i][stop:]
        left = rows[i]["text"]
        assert len(set(passage.split()) & set(left.split())) < 8  # all but a short end of it is gone
        assert rows[i]["chars_cut"] == stop - start


def test_short_repeats_and_clean_texts_stay(spark, docs_of):
    rng = random.Random(7)
    texts = [sentences(rng, 10) + " The end of it. Yes." for _ in range(12)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.repeats(docs_of(texts)).collect()}
    assert got == dict(enumerate(texts))


def test_hot_line_and_empty_table(spark, docs_of, monkeypatch):
    from kpiloom.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 5)
    rng = random.Random(8)
    line = "This very line stands in all of the documents of the whole corpus, always in the same words.\n"
    rows = [(i, line + sentences(rng, 4)) for i in range(60)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.repeats(docs_of(rows)).collect()}
    want = brutes.without_repeats(rows)
    assert got == {i: want[i, t] for i, t in rows}
    assert got[0] == rows[0][1] and all(line not in got[i] for i in range(1, 60))
    assert line_dedup.repeats(docs_of([])).count() == 0
    assert line_dedup.remove_repeats(docs_of([])).count() == 0
