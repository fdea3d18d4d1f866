import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus_samples import ODD_TEXTS

from kpiloom.llm import spelling


def words_of(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def one_edit(a, b):
    """Whether one inserted, deleted or replaced code point makes b of a."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    k = len(os.path.commonprefix([a, b]))
    return len(b) - len(a) == 1 and a[k:] == b[k + 1 :]


def brute(rows):
    words = words_of(rows)
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), form[w] and words[form[w]]) for w, n in words.items()}


def result(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def typo(draw, word):
    at, letter = draw.randrange(len(word)), draw.choice("abcdé÷ÿ")
    return draw.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]])


def corpus(seed, n=60):
    draw = random.Random(seed)
    base = ["".join(draw.choices("abcdeé", k=draw.randrange(6, 12))) for _ in range(20)]
    rows = []
    for i in range(n):
        ws = []
        for _ in range(draw.randrange(80)):
            w = draw.choice(base[: draw.randrange(1, 21)])
            for _ in range(draw.choice([0] * 12 + [1, 1, 2])):
                w = typo(draw, w)
            ws.append(draw.choice([w, w, w.upper()]))
        rows.append((i, draw.choice([" ", "1", "_\n"]).join(ws)))
    return rows


@pytest.mark.parametrize("cell, leaf", [(20_000, 8), (15, 2)])
def test_equal_to_brute_force(spark, docs_of, monkeypatch, cell, leaf):
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "LEAF", leaf)
    rows = corpus(1) + corpus(2)[:5] * 2 + [(900 + k, "colourful " * 4 ** (4 - k) + "colorful " * 4**k) for k in range(5)]
    rows += [(i, "chained chainedx chainedxy ") for i in (1, 2)] + [(k, "chained " * 1500 + "chainedx " * 40) for k in (3, 4, 5)]
    want = brute(rows)
    assert any(form and root != form for _, form, root, *_ in want)
    assert result(spelling.variants(docs_of(rows))) == want


def test_odd_texts(spark, docs_of):
    rows = list(enumerate(ODD_TEXTS)) + [(None, "repeated words Repeated"), (None, None), (7, "repeated repeatex repeatex")] * 2
    assert result(spelling.variants(docs_of(rows))) == brute(rows)
    assert spelling.variants(docs_of([])).collect() == []
    assert spelling.variants(docs_of([None, "short"])).collect() == []


def test_long_words(spark, docs_of):
    long = "x" * 10**6
    rows = [(i, f"{t} {t}") for i, t in enumerate([long, "y" + long, long[:-1] + "z", " " * 10**6, "\n" * 10**6, "÷" * 300])]
    assert result(spelling.variants(docs_of(rows))) == brute(rows)


def pairs(points, queries):
    p, q = (spelling.letters_of([w.encode("latin-1") for w in ws], len(ws[0])) for ws in (points, queries))
    found = [np.stack(x) for x in spelling.search(p, spelling.counts_of(p), q, spelling.counts_of(q))]
    out = [tuple(x) for f in found for x in f.T.tolist()]
    assert len(out) == len(set(out))
    return {(queries[a], points[b]) for a, b in out}


@pytest.mark.parametrize("held", [4_000_000, 50])
def test_search_over_anagrams_and_repeated_letters(monkeypatch, held):
    monkeypatch.setattr(spelling, "HELD", held)
    draw = random.Random(5)
    points = sorted({"".join(draw.sample("abcdefg", 7)) for _ in range(300)} | {"".join(draw.choices("abÿ", k=7)) for _ in range(200)})
    same = sorted({"".join(draw.choices("abÿg", k=7)) for _ in range(200)} | set(points[::3]))
    shorter = sorted({w[:k] + w[k + 1 :] for w in points[::2] for k in (0, 3, 6)} | {"aaaaaa", "abcdef"})
    for queries in (same, shorter):
        assert pairs(points, queries) == {(a, b) for a in queries for b in points if one_edit(a, b)}


def test_cells_hold_every_pair(monkeypatch):
    draw = random.Random(9)
    words = sorted({"".join(draw.choices("abcde", weights=[9, 5, 3, 2, 1], k=8)).encode() for _ in range(2000)})
    counts = spelling.counts_of(spelling.letters_of(words, 8))
    tree = spelling.plan(counts[::4], 40)
    own = spelling.cell_of(tree, counts)
    assert len(set(own.tolist())) > 20 and np.bincount(own).max() < len(words) / 5
    reach = set(zip(*(x.tolist() for x in spelling.cells_near(tree, counts, 1))))
    apart = np.abs(counts[:, None].astype(int) - counts[None]).sum(axis=2)
    for a, b in zip(*np.nonzero(apart <= 2)):
        assert (a, own[b]) in reach
