"""Summaries kept up to date: exact counts, bounded rank errors, any order of merging."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.operators import incremental


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = []
    for i in range(30_000):
        cell = "HOT" if rng.random() < 0.4 else f"C{rng.randrange(20)}"
        data.append((i, cell, rng.randrange(10), rng.random() < 0.1, rng.choice([None, rng.gauss(0, 5)]), float(rng.randrange(3))))
    data += [(40_000, None, 1, False, 1.0, 1.0), (40_001, "EMPTY", 1, False, None, 2.0), (40_002, "C1", None, False, 1.0, None)]
    frame = spark.createDataFrame(data, "event_id long, cell_name string, d int, is_anomaly boolean, x double, y double")
    return frame.withColumn("ts", F.expr("timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(d)")).drop("d").cache()


def added(spark, path, rows, order):
    for k in order:
        incremental.add_batch(rows.where(f"event_id % 5 = {k}"), path, f"batch {k}", ["x", "y"])
    incremental.add_batch(rows.where(f"event_id % 5 = {order[0]}"), path, f"batch {order[0]}", ["x", "y"])  # tried again
    return path


def test_medians_within_the_stated_error_in_any_order(spark, tmp_path, rows):
    normal = {}
    for r in rows.where("NOT is_anomaly AND cell_name IS NOT NULL").collect():
        for c in "xy":
            normal.setdefault((r["cell_name"], c), []).append(r[c])
    for n, order in enumerate(([0, 1, 2, 3, 4], [3, 0, 4, 2, 1])):
        path = added(spark, str(tmp_path / f"s{n}"), rows, order)
        got = {r["cell_name"]: r for r in incremental.baselines(spark, path, ["x", "y"]).collect()}
        assert got.keys() == {cell for cell, _ in normal}
        for (cell, c), values in normal.items():
            kept = np.array([v for v in values if v is not None])
            if not len(kept):
                assert got[cell][c] is None
                continue
            error = max(incremental.RANK_ERROR, 1 / len(kept))
            assert (kept < got[cell][c]).mean() <= 0.5 + error and (kept <= got[cell][c]).mean() >= 0.5 - error


def test_profile_and_missing_cells(spark, tmp_path, rows):
    path = added(spark, str(tmp_path / "s"), rows, [4, 3, 2, 1, 0])
    found = incremental.profile(spark, path, ["x", "y"]).first()
    assert found["n_rows"] == rows.count() and found["n_features"] == 2
    assert found["n_entities"] == pytest.approx(rows.select("cell_name").distinct().dropna().count(), rel=0.02)
    got = {r["column"]: r["missing_count"] for r in incremental.missing_by_column(spark, path).collect()}
    want = {c: rows.where(F.col(c).isNull()).count() for c in rows.columns}
    assert got == {c: n for c, n in want.items() if n}


def test_new_days_do_not_read_history(spark, tmp_path, rows):
    """Adding a batch touches its own rows and the claims, nothing else of the table."""
    path = str(tmp_path / "s")
    incremental.add_batch(rows.where("event_id % 5 = 0"), path, "a", ["x"])
    (tmp_path / "s" / "entities" / "_run=1").rename(tmp_path / "gone")
    incremental.add_batch(rows.where("event_id % 5 = 1"), path, "b", ["x"])
    assert spark.read.parquet(f"{path}/entities").select("_run").distinct().count() == 1
