"""Runs are seen once or not at all: retries, two writers, crashes."""

import os

import pytest
from pyspark.sql import functions as F

from kpiloom.session import stage
from kpiloom.sources import commits, sinks


def run_rows(spark, n, tag):
    return stage(spark.range(n).select(F.lit(tag).alias("tag"), (F.col("id") + 1).alias("pos")), "run")


def ids(spark, path):
    rows = spark.read.parquet(path).select("tag", "record_id").collect()
    return sorted((r["record_id"], r["tag"]) for r in rows)


def test_a_retried_run_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert commits.append_once(run_rows(spark, 5, "a"), path, "a", "pos")
    assert commits.append_once(run_rows(spark, 3, "b"), path, "b", "pos")
    assert not commits.append_once(run_rows(spark, 5, "a"), path, "a", "pos")
    assert ids(spark, path) == [(i, "a" if i < 6 else "b") for i in range(1, 9)]
    with pytest.raises(ValueError):
        commits.append_once(run_rows(spark, 4, "a"), path, "a", "pos")


def test_two_writers_get_disjoint_ids(spark, tmp_path, monkeypatch):
    """Another writer claims between reading the claims and making one's own."""
    path = str(tmp_path / "t")
    state, met = commits._state, []

    def slow(session, where, run):
        found = state(session, where, run)
        if run == "slow" and not met:
            met.append(commits.append_once(run_rows(spark, 4, "fast"), path, "fast", "pos"))
        return found

    monkeypatch.setattr(commits, "_state", slow)
    assert commits.append_once(run_rows(spark, 3, "slow"), path, "slow", "pos") and met == [True]
    assert ids(spark, path) == [(i, "fast" if i < 5 else "slow") for i in range(1, 8)]


@pytest.mark.parametrize("step", ["claim", "write", "move"])
def test_a_crash_leaves_no_visible_rows(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    commits.append_once(run_rows(spark, 2, "before"), path, "before", "pos")

    def crash(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as broken:
        if step == "claim":
            broken.setattr(commits, "claim", crash)
        elif step == "write":
            broken.setattr(type(run_rows(spark, 1, "x").write), "parquet", crash)
        else:
            move = commits._Files.move
            broken.setattr(commits._Files, "move", lambda self, a, b: crash() if "_run=" in b else move(self, a, b))
        rows = spark.range(3).select(F.lit("lost").alias("tag"), (F.col("id") + 1).alias("pos"))
        with pytest.raises(RuntimeError):
            commits.append_once(rows, path, "lost", "pos")
    assert ids(spark, path) == [(1, "before"), (2, "before")]
    # another run goes on, and the lost one comes back with its own ids
    commits.append_once(run_rows(spark, 2, "after"), path, "after", "pos")
    assert commits.append_once(run_rows(spark, 3, "lost"), path, "lost", "pos")
    found = ids(spark, path)
    assert len(found) == len({i for i, _ in found}) == 7 and {i for i, _ in found} == set(range(1, 8))


def test_cases_are_recorded_in_order_once(spark, tmp_path):
    df = spark.range(0, 500, numPartitions=5).select(((F.col("id") * 7919) % 500).alias("v"))
    path = str(tmp_path / "history")
    assert sinks.record_cases(df, path, ["v"], run="day-1")
    assert not sinks.record_cases(df, path, ["v"], run="day-1")
    assert sinks.record_cases(df, path, ["v"], run="day-2")
    rows = spark.read.parquet(path).collect()
    assert sorted(r["record_id"] for r in rows) == list(range(1, 1001))
    assert all((r["record_id"] - 1) % 500 == r["v"] for r in rows)
    assert not [f for f in os.listdir(f"{path}/_writing") if not f.startswith(".")]


def test_a_run_tried_again_is_not_sorted_again(spark, tmp_path, monkeypatch):
    df = spark.range(0, 60, numPartitions=3).select(F.col("id").alias("v"))
    path = str(tmp_path / "history")
    assert sinks.record_cases(df, path, ["v"], run="day-1")
    monkeypatch.setattr(sinks, "global_row_number", lambda *a, **k: pytest.fail("sorted again"))
    assert not sinks.record_cases(df, path, ["v"], run="day-1")
    with pytest.raises(ValueError):  # as before: the run has other rows now
        sinks.record_cases(df.where("v > 5"), path, ["v"], run="day-1")
    assert spark.read.parquet(path).count() == 60
