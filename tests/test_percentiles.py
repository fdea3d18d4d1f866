"""Exact percentiles: both ways against numpy, with skew, ties, NULLs and tiny groups."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.operators.percentiles import group_percentiles

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def _rows(seed):
    rng = random.Random(seed)
    rows = []
    for key, n in (("hot", 5000), ("warm", 300), ("one", 1), ("two", 2), ("empty", 4)):
        for _ in range(n):
            smooth = None if key == "empty" or rng.random() < 0.1 else rng.gauss(0, 1e3)
            stepped = None if key == "empty" else float(rng.choice([1, 1, 1, 1, 2, 3]))
            rows.append((key, smooth, stepped))
    rng.shuffle(rows)
    return rows


def _expected(values):
    kept = [v for v in values if v is not None]
    return [None] * len(PROBS) if not kept else [float(np.quantile(kept, p)) for p in PROBS]


def _same(got, want):
    got = [None] * len(PROBS) if got is None else got
    return all((g is None and w is None) or math.isclose(g, w, rel_tol=1e-12, abs_tol=1e-9) for g, w in zip(got, want))


@pytest.mark.parametrize("large", [10_000, 1_000, 2])
def test_against_numpy(spark, large):
    rows = _rows(7)
    df = spark.createDataFrame(rows, "k string, smooth double, stepped double").repartition(6)
    out = {r["k"]: r for r in group_percentiles(df, ["k"], ["smooth", "stepped"], PROBS, large).collect()}
    assert set(out) == {r[0] for r in rows}
    for key, r in out.items():
        assert _same(r["smooth"], _expected([x[1] for x in rows if x[0] == key])), key
        assert _same(r["stepped"], _expected([x[2] for x in rows if x[0] == key])), key


def test_whole_table_is_one_group(spark):
    rows = _rows(3)
    df = spark.createDataFrame(rows, "k string, smooth double, stepped double")
    want = _expected([r[1] for r in rows])
    for large in (10_000, 10):
        out = group_percentiles(df, [], ["smooth"], PROBS, large).collect()
        assert len(out) == 1 and _same(out[0]["smooth"], want)


def test_a_wrong_sketch_does_not_matter(spark, monkeypatch):
    """Bands that miss the rank widen to the open side; the result stays exact."""
    from kpiloom.operators import percentiles

    real = percentiles.F.percentile_approx
    monkeypatch.setattr(percentiles.F, "percentile_approx", lambda c, p, a: percentiles.F.transform(
        real(c, p, 2), lambda v, i: v + (i % 3 - 1) * 200))
    rows = _rows(11)
    df = spark.createDataFrame(rows, "k string, smooth double, stepped double").repartition(5)
    out = {r["k"]: r for r in percentiles.group_percentiles(df, ["k"], ["smooth"], PROBS, 0).collect()}
    for key, r in out.items():
        assert _same(r["smooth"], _expected([x[1] for x in rows if x[0] == key])), key


@pytest.mark.parametrize("ranked", [3, 40])
def test_a_ranking_task_has_a_fixed_bound(spark, monkeypatch, ranked):
    """Whatever the group and its ties, no target keeps more distinct values than the bound."""
    from kpiloom.operators import percentiles

    rng = np.random.default_rng(7)
    parts = {
        "even": rng.random(9000), "ties": rng.choice([1.0, 2.0, 2.5, 3.0], 9000),
        "heavy": np.concatenate((np.full(8000, 5.0), rng.random(4000) * 10)), "wide": rng.normal(size=9000) * 10.0 ** rng.integers(-9, 9, 9000),
        "small": rng.random(5),
    }
    rows = [(k, float(v), float(v) * -3) for k, vs in parts.items() for v in vs]
    sizes = []
    narrowed = percentiles._narrowed

    def watched(values, goals, each, bound):
        values, goals = narrowed(values, goals, each, bound)
        sizes.extend(r["n"] for r in values.groupBy(*each).agg(F.count("*").alias("n")).collect())
        return values, goals

    monkeypatch.setattr(percentiles, "_narrowed", watched)
    monkeypatch.setattr(percentiles, "BINS", 8)
    monkeypatch.setattr(percentiles, "SKETCH_ACCURACY", 20)  # so that bands are wide
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(3)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = percentiles.group_percentiles(df, ["k"], ["x", "y"], probs, large=100, ranked=ranked)
    for r in got.collect():
        for c, sign in (("x", 1), ("y", -3)):
            assert r[c] == pytest.approx(list(np.quantile(parts[r["k"]] * sign, probs)))
    assert got.count() == len(parts)
    assert sizes and max(sizes) <= ranked
