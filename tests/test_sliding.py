"""Windows without pairs, held against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import cases, detect, quality, sliding

SCHEMA = "event_id long, cell_name string, s int, x double, prediction int, probability double"
HOUR = 3600


def samples_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn(
        "ts", F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)")).repartition(3)


def cases_of(spark, rows):
    frame = spark.createDataFrame(rows, "case_id long, cell_name string, s int")
    return frame.select("case_id", "cell_name", F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)").alias("t0"))


@pytest.fixture(scope="module")
def data():
    """A third of all rows in one cell, many at equal times, some before the epoch, nulls."""
    rng = random.Random(11)
    rows, asked = [], []
    for i in range(2400):
        cell = "HOT" if rng.random() < 0.35 else f"C{rng.randrange(40)}"
        s = rng.choice([rng.randrange(-2 * HOUR, 30 * HOUR), rng.randrange(-8, 100) * 900])
        rows.append((i, cell, s, rng.choice([None, rng.random()]), rng.randrange(2), rng.random()))
        if rng.random() < 0.15:
            asked.append((i, cell, s))
    rows += [(5000, None, 10, 1.0, 1, 0.9), (5001, "HOT", None, 1.0, 1, 0.9), (5002, "LONE", 77, 1.0, 1, 0.9)]
    asked += [(6000, None, 10), (6001, "HOT", None), (6002, "NONE", 50), (6003, "LONE", 77 + 10**6), (6004, "HOT", -10**6)]
    return rows, asked


def inside(rows, cell, t0, before, after):
    return [r for r in rows if cell is not None and t0 is not None and r[1] == cell and r[2] is not None
            and t0 - before <= r[2] <= t0 + after]


@pytest.mark.parametrize("before, after, parts", [
    (6 * HOUR, 0, 16), (300, 0, 16), (0, 900, 1), (100, 1500, 2), (6 * HOUR, 6 * HOUR, 64), (16, 0, 16),
])
def test_aggregates_by_brute_force(spark, data, before, after, parts):
    rows, asked = data
    values = {
        "n": (F.lit(1).cast("bigint"), "sum"), "x": (F.col("x"), "sum"), "least": (F.col("x"), "min"),
        "most": (F.col("probability"), "max"),
    }
    got = sliding.window_aggregates(cases_of(spark, asked), samples_of(spark, rows), before, after, values, parts=parts)
    want = {}
    for case, cell, t0 in asked:
        found = inside(rows, cell, t0, before, after)
        xs = [r[3] for r in found if r[3] is not None]
        if found:
            want[case] = (len(found), sum(xs) if xs else None, min(xs, default=None), max(r[5] for r in found))
    out = {r["case_id"]: (r["n"], r["x"], r["least"], r["most"]) for r in got.collect()}
    assert out.keys() == want.keys() and len(out) > 300
    for case, (n, x, least, most) in want.items():
        assert out[case][0] == n and out[case][2:] == (least, most)
        assert out[case][1] == (None if x is None else pytest.approx(x))


@pytest.mark.parametrize("before, after, parts", [(6 * HOUR, 0, 16), (300, 0, 1), (0, 900, 16), (100, 1500, 2), (0, 6 * HOUR, 4)])
def test_last_row_by_brute_force(spark, data, before, after, parts):
    rows, asked = data
    got = sliding.last_in_window(
        cases_of(spark, asked), samples_of(spark, rows), before, after, ["event_id", "x"], parts=parts)
    want = {}
    for case, cell, t0 in asked:
        found = inside(rows, cell, t0, before, after)
        if found:
            last = max(found, key=lambda r: (r[2], r[0]))
            want[case] = (cell, last[0], last[3])
    assert {r["case_id"]: (r["cell_name"], r["event_id"], r["x"]) for r in got.collect()} == want


@pytest.mark.parametrize("before, after, n, parts", [(6 * HOUR, 0, 3, 16), (300, 0, 1, 1), (100, 1500, 5, 2), (0, 6 * HOUR, 2, 4)])
def test_first_rows_by_brute_force(spark, data, before, after, n, parts):
    rows, asked = data
    got = sliding.first_in_window(
        cases_of(spark, asked), samples_of(spark, rows), before, after, n, ["event_id", "x"], parts=parts)
    want = []
    for case, cell, t0 in asked:
        found = sorted(inside(rows, cell, t0, before, after), key=lambda r: (r[2], r[0]))
        want += [(case, cell, r[0], r[3]) for r in found[:n]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and len(want) > 300


def test_first_rows_of_cases_and_samples_that_come_twice(spark):
    rows = [(i, "A", s, float(i), 1, 0.1) for i, s in ((9, 100), (5, 100), (5, 100), (7, 100), (3, 101))]
    got = sliding.first_in_window(cases_of(spark, [(1, "A", 100), (1, "A", 100), (2, "A", 160)]), samples_of(spark, rows), 60, 0, 3, ["event_id"])
    want = sorted([(1, 5), (1, 5), (1, 7)] * 2 + [(2, 5), (2, 5), (2, 7)])
    assert sorted((r["case_id"], r["event_id"]) for r in got.collect()) == want


def test_several_windows_in_one_pass(spark, data):
    rows, asked = data
    windows = {"back": (300, 0), "ahead": (0, 900), "early": (HOUR, 0)}
    got = sliding.last_in_windows(cases_of(spark, asked), samples_of(spark, rows), windows, ["event_id"])
    out = {r["case_id"]: tuple(r[w] and r[w]["event_id"] for w in windows) for r in got.collect()}
    for case, cell, t0 in asked:
        want = tuple(
            max(inside(rows, cell, t0, b, a), key=lambda r: (r[2], r[0]), default=(None,))[0] for b, a in windows.values())
        assert out.get(case, (None,) * 3) == want


def test_ties_at_equal_time_go_to_the_largest_tiebreak(spark):
    rows = [(i, "A", s, float(i), 0, 0.1) for i, s in ((5, 100), (9, 100), (7, 100), (3, 101))]
    got = sliding.last_in_window(cases_of(spark, [(1, "A", 100), (2, "A", 101)]), samples_of(spark, rows), 60, 0, ["event_id"], parts=4)
    assert {r["case_id"]: r["event_id"] for r in got.collect()} == {1: 9, 2: 3}


def test_equal_to_the_batches(spark, data):
    rows, asked = data
    samples, found = samples_of(spark, rows), cases_of(spark, asked)
    batches = cases.lookback_batch(found, samples, 6 * HOUR)

    def shown(df):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)

    features = ["x", "probability"]
    assert shown(quality.window_quality(found, samples, features, 6 * HOUR)) == shown(quality.batch_quality(batches, features))
    assert shown(quality.window_stats(found, samples, features, 6 * HOUR)) == shown(quality.batch_stats(batches, features))
    assert shown(detect.detect_windows(found, samples, 6 * HOUR)) == shown(detect.detect_batches(batches))
    first = sliding.first_in_window(found, samples.where("prediction = 1"), 6 * HOUR, 0, 3)
    assert shown(detect.anomaly_samples(first)) == shown(detect.anomaly_samples(batches))


@pytest.mark.parametrize("name", ["verification_payload", "anomaly_samples", "insight_payload", "insight_payload_whole"])
def test_queries_of_first_and_last_rows_make_no_pairs(spark, tmp_path, monkeypatch, name):
    """Cases meet samples by their numbers or places, never by an interval of time."""
    import __spark_entry__

    rows = spark.range(400).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 97)").alias("ts"),
        (F.col("id") % 3).alias("user_id"), F.when(F.col("id") % 4 == 0, "error").otherwise("view").alias("event_type"),
        F.lit(1.0).alias("value"), F.concat(F.lit("k=") , (F.col("id") % 90).cast("string")).alias("props"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(cases, "interval_join", lambda *a, **k: pytest.fail("pairs of cases and samples"))
    assert __spark_entry__.queries()[name](spark, str(tmp_path)).count() > 50


def test_no_join_and_no_pairs_in_the_plan(spark, data):
    rows, asked = data
    samples, found = samples_of(spark, rows), cases_of(spark, asked)
    for df in (
        quality.window_quality(found, samples, ["x"], 6 * HOUR), detect.detect_windows(found, samples, 6 * HOUR),
        sliding.last_in_windows(found, samples, {"before": (300, 0), "after": (0, 900)}),
    ):
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_cell_is_spread_over_its_buckets(spark):
    """Half of all rows in one cell within one window: no window partition holds more than a few parts of them."""
    rows = [(i, "HOT" if i % 2 else f"C{i}", i * 10, 1.0, 0, 0.5) for i in range(2000)]
    width = sliding._width(6 * HOUR, 0, sliding.PARTS)
    samples = samples_of(spark, rows).select("cell_name", sliding._bucket(F.unix_micros(F.col("ts").cast("timestamp")), width).alias("b"))
    assert samples.groupBy("cell_name", "b").count().agg(F.max("count")).first()[0] <= 2 * 1000 / sliding.PARTS


def test_empty_tables(spark):
    rows = [(1, "A", 5, 1.0, 0, 0.5)]
    none = cases_of(spark, [(1, "A", 5)]).where("case_id < 0")
    assert quality.window_quality(none, samples_of(spark, rows), ["x"], 300).collect() == []
    assert sliding.last_in_window(none, samples_of(spark, rows), 300, 0).collect() == []
    assert quality.window_quality(cases_of(spark, [(1, "A", 5)]), samples_of(spark, rows).where("event_id < 0"), ["x"], 300).collect() == []
    with pytest.raises(ValueError):
        sliding.window_aggregates(none, samples_of(spark, rows), 0, 0, {})
