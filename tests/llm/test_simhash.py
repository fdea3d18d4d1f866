import random

import brutes
import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import simhash
from kpiloom.llm.components import components
from corpus_samples import ODD_TEXTS


def flipped(fp, bits):
    for b in bits:
        fp ^= 1 << b
    return fp


def test_code_is_perfect():
    code = simhash.cosets(2)
    light = np.bitwise_count(code.patterns[code.starts])
    assert light.max() == 3 and (np.bitwise_count(code.patterns) <= 3).sum() == 2048
    values = np.random.default_rng(1).integers(0, 1 << 23, 1000)
    assert (code.syndrome(code.home(values)) == 0).all()
    assert (np.bitwise_count(values ^ code.home(values)) <= 3).all()


def test_reach_covers_homes():
    rng = random.Random(2)
    base = np.array([rng.getrandbits(64) for _ in range(300)], dtype=np.uint64)
    near = np.array([flipped(int(x), rng.sample(range(64), 2)) for x in base], dtype=np.uint64)
    one, two = base.view(np.int64), near.view(np.int64)
    code = simhash.cosets(2)
    home1, home2 = simhash.home_anchors(one, code), simhash.home_anchors(two, code)
    reach1, reach2 = simhash.reached_anchors(one, 2), simhash.reached_anchors(two, 2)
    at1, at2 = set(zip(*map(np.ndarray.tolist, reach1))), set(zip(*map(np.ndarray.tolist, reach2)))
    for i in range(300):  # of two ends, the one with the lower home reaches the other's
        assert (i, home2[i]) in at1 if home1[i] <= home2[i] else (i, home1[i]) in at2


@pytest.mark.parametrize("crowded", [512, 3])
def test_groups_against_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    monkeypatch.setattr(simhash, "PAIRS", 50)
    rng = random.Random(crowded)
    fps = []
    for _ in range(12):
        center = rng.getrandbits(64)
        fps += [flipped(center, rng.sample(range(64), rng.randint(0, 4))) for _ in range(25)]
    path = [rng.getrandbits(64)]
    for _ in range(40):  # a path: each one bit or two from the last
        path.append(flipped(path[-1], rng.sample(range(64), rng.randint(1, 2))))
    fps += path + [0, 0, 1, (1 << 64) - 1]
    signed = [x - (1 << 64) if x >> 63 else x for x in dict.fromkeys(fps)]
    unsigned = [x % (1 << 64) for x in signed]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    roots = {r["node"]: r["root"] for r in components(simhash.links(nodes)).collect()}
    named = [roots.get(x, x) for x in signed]
    want = brutes.components(list(range(len(signed))), unsigned)
    first = {}
    for name, w in zip(named, want):
        assert first.setdefault(name, w) == w
    assert len(set(named)) == len(set(want))


def test_a_crowd_beside_other_anchors(spark, monkeypatch):
    """Fingerprints that agree in bits 0 to 45 reach the same few anchors: no meeting place holds more than its bound."""
    rng = random.Random(7)
    base, n = rng.getrandbits(46), 20_000
    fps = {base | rng.getrandbits(18) << 46 for _ in range(n)} | {flipped(base, [k]) | 5 << 50 for k in (3, 9)}
    signed = [x - (1 << 64) if x >> 63 else x for x in sorted(fps)]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(4)
    sizes, meet = [], simhash._meet

    def watched(rows, distance):
        sizes.append(rows.groupBy("key").agg(F.count_if("at_home").alias("home"), F.count("*").alias("n"))
                     .where("home > 0").agg(F.max("n")).first()[0])
        return meet(rows, distance)

    monkeypatch.setattr(simhash, "_meet", watched)
    roots = {r["node"]: r["root"] for r in components(simhash.links(nodes)).collect()}
    assert sizes[0] <= 65_536 and sizes[0] < len(signed)
    # by brute force: neighbours by flipping one or two of the bits that differ
    flips = [1 << b for b in (3, 9, *range(46, 64))]
    flips += [a | b for a in flips for b in flips if a < b]
    known, seen, want = set(fps), set(), 0
    for start in fps:
        if start in seen:
            continue
        want += 1
        todo, group = [start], {start}
        while todo:
            x = todo.pop()
            for f in flips:
                if x ^ f in known and x ^ f not in group:
                    group.add(x ^ f)
                    todo.append(x ^ f)
        seen |= group
        assert len({roots.get(x - (1 << 64) if x >> 63 else x, x) for x in group}) == 1
    assert len({roots.get(x, x) for x in signed}) == want


def test_one_row_of_each_component_stays(spark, docs_of):
    a, b = "one text of some words here", "quite another text with other words in it"
    kept = lambda rows: sorted(
        ((r["doc_id"], r["text"]) for r in simhash.keep_one(docs_of(rows)).collect()), key=repr)
    assert kept([(1, a), (2, a), (2, b)]) == [(1, a), (2, b)]
    assert kept([(1, a), (1, a), (1, a)]) == [(1, a)]
    assert kept([(None, a), (None, a), (None, b)]) == sorted([(None, a), (None, b)])
    assert kept([(None, a), (7, a), (9, b), (9, b), (None, b)]) == [(7, a), (9, b)]
    assert kept([(3, None), (3, ""), (4, None)]) in ([(3, None)], [(3, "")])


def test_query_rows_against_brute_force(spark, docs_of):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = list(ODD_TEXTS)
    for _ in range(20):
        words = rng.choices(vocabulary, k=rng.randint(1, 120))
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 4)):
            changed = list(words)
            changed[rng.randrange(len(words))] = "other"
            texts.append(" ".join(changed).upper())
    docs = docs_of([(100 - i, t) for i, t in enumerate(texts)])
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in simhash.groups(docs).collect()}
    ids = [100 - i for i in range(len(texts))]
    fps = [brutes.fingerprint(t) for t in texts]
    assert got == dict(zip(ids, zip(fps, brutes.components(ids, fps))))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in got.values()})


def test_long_text_in_runs(monkeypatch):
    text = " ".join(f"w{i % 977} \n" for i in range(5000))
    want = brutes.fingerprint(text)
    from kpiloom.llm import common

    monkeypatch.setattr(simhash, "word_runs", lambda data: common.word_runs(data, 100))
    monkeypatch.setattr(simhash, "HASHES", 64)
    assert simhash.fingerprint(text) == want == brutes.fingerprint(text)


def test_empty_null_and_repeated(spark, docs_of):
    assert simhash.groups(docs_of([])).count() == 0
    assert simhash.keep_one(docs_of([])).count() == 0
    rows = simhash.groups(docs_of([(5, "a b c"), (5, "a b c"), (None, "a b c"), (None, "x y z q")])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows if r["doc_id"]) == [(5, 5), (5, 5)]
    assert sorted(str(r["component_id"]) for r in rows) == ["5", "5", "5", "None"]


def test_hot_groups(spark, docs_of, monkeypatch):
    from kpiloom.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 5)
    texts = [(i, "copied text of some words") for i in range(40)] + [(100 + i, f"text {i} of its own {i}") for i in range(20)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.groups(docs_of(texts)).collect()}
    assert len(got) == 60 and all(got[i] == 0 for i in range(40))
    edges = spark.createDataFrame([(0, i) for i in range(1, 60)] + [(100 + i, 101 + i) for i in range(50)], "a long, b long")
    roots = components(edges).collect()
    assert len(roots) == 111 and len({r["root"] for r in roots}) == 2
