import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.operators import quality
from kpiloom.plans.quality_audit import audit
from tests.conftest import table

SMOKE = "timestamp timestamp_ntz, cell_id string, throughput double, latency double, packet_loss double"


@pytest.fixture(scope="module")
def smoke(spark):
    """100 hourly rows, six missing throughputs, the first five rows again."""
    rows = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id) AS timestamp, 'cell_001' AS cell_id, "
        "CASE WHEN id BETWEEN 10 AND 15 THEN NULL ELSE 100e0 + id % 9 END AS throughput, 10e0 + id % 7 AS latency, "
        "(id % 10) * 1e-1 AS packet_loss, id FROM range(100)"
    )
    return quality.append_rows(rows, rows.filter("id < 5")).drop("id")


def test_smoke_table(smoke):
    found = audit(smoke)
    assert found.score.first()["n_duplicates"] == 5
    assert found.score.first()["total_rows"] == 105
    missing = found.missing_columns.collect()
    assert [(r["column"], r["missing_count"], r["data_type"]) for r in missing] == [("throughput", 6, "double")]
    overview = found.missing.first()
    assert (overview["total_missing"], overview["rows_with_missing"], overview["complete_rows"]) == (6, 6, 99)
    assert found.cleaned.count() == 100
    summary = found.summary.first()
    assert (summary["total_rows"], summary["clean_rows"], summary["rows_removed"]) == (105, 100, 5)
    want = round(100 - (6 / 105 * 100) / 5 - 5 / 105 * 100, 2)
    assert summary["quality_score"] == found.score.first()["quality_score"] == want
    assert found.types.count() == 5


def test_empty_table(spark):
    empty = spark.createDataFrame([], "a double, b string")
    assert quality.quality_score(empty).first()["quality_score"] == 100.0
    assert quality.duplicate_count(empty).first()["n_duplicates"] == 0
    assert quality.outlier_report(empty).count() == 0
    assert quality.missing_overview(empty).first()["total_missing"] == 0


def test_exactly_half_missing_stays(spark):
    df = spark.createDataFrame([(1, None, None, 4), (None, None, None, 4), (1, 2, None, None)], "a int, b int, c int, d int")
    assert quality.drop_sparse_rows(df).count() == 2
    odd = spark.createDataFrame([(1, None, None), (1, 2, None)], "a int, b int, c int")
    assert table(quality.drop_sparse_rows(odd), "a", "b") == [(1, 2)]


def test_null_rows_count_as_copies(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a int, b int")
    assert quality.duplicate_count(df).first()["n_duplicates"] == 1
    assert quality.drop_exact_duplicates(df).count() == 2


def test_outliers_by_hand(spark):
    rng = random.Random(5)
    values = [rng.gauss(10, 2) for _ in range(200)] + [60.0, -40.0]
    df = spark.createDataFrame([(v, 3.0, None) for v in values], "x double, flat double, none double")
    report = {r["column"]: r for r in quality.outlier_report(df, only_hits=False, large=50).collect()}
    assert set(report) == {"x", "flat"}
    q1, q3 = np.quantile(values, [0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    x = report["x"]
    assert x["iqr_outliers"] == sum(v < low or v > high for v in values)
    assert x["z_score_outliers"] == int((abs((np.array(values) - np.mean(values)) / np.std(values, ddof=1)) > 3).sum())
    assert x["lower_bound"] == pytest.approx(low) and x["upper_bound"] == pytest.approx(high)
    assert report["flat"]["iqr_outliers"] == 0 and report["flat"]["z_score_outliers"] == 0
    assert [r["column"] for r in quality.outlier_report(df).collect()] == ["x"]


def test_one_row_has_no_z_outlier(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    assert quality.zscore_outliers(df).first()["z_score_outliers"] == 0


def test_batch_quality_bands(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (1, None, 1.0), (2, None, None)], "case_id int, a double, b double")
    out = {r["case_id"]: r for r in quality.batch_quality(df, ["a", "b"]).collect()}
    assert out[1]["missing_pct"] == 25.0 and out[1]["severity"] == "medium"
    assert out[2]["missing_pct"] == 100.0 and out[2]["severity"] == "high"


@pytest.mark.parametrize("bucket_seconds", [60, 3600, 10_000_000])
def test_timestamp_issues_do_not_depend_on_buckets(spark, bucket_seconds):
    rng = random.Random(2)
    times = {c: sorted(rng.randrange(0, 50_000) for _ in range(200)) for c in ("A", "B")}
    times["C"] = [7]
    rows = [(c, t) for c, ts in times.items() for t in ts]
    df = spark.createDataFrame(rows, "cell_name string, s int").withColumn(
        "ts", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)"))
    out = {r["cell_name"]: r for r in quality.timestamp_issues(df, 300, bucket_seconds=bucket_seconds).collect()}
    for c, ts in times.items():
        unique = sorted(set(ts))
        gaps = [b - a for a, b in zip(unique, unique[1:])]
        assert out[c]["duplicate_timestamps"] == len(ts) - len(unique)
        assert out[c]["gaps"] == sum(g > 300 for g in gaps)
        assert out[c]["max_gap_seconds"] == (max(gaps) if gaps else None)


def test_range_violations_one_sided(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (9.0,), (None,)], "x double")
    out = quality.range_violations(df, {"x": (2.0, None), "absent": (0.0, 1.0)}).collect()
    assert [tuple(r) for r in out] == [("x", 1, 0)]


def _colliding(df):
    """Digests that throw most rows together, so only the exact grouping tells them apart."""
    return [F.col("a") % 2, F.lit(1)]


@pytest.mark.parametrize("digest", [quality.row_digest, _colliding])
@pytest.mark.parametrize("limit", [None, 0])
def test_duplicates_by_digest(spark, monkeypatch, digest, limit):
    """Every report equals plain grouping: colliding digests, NULLs that swap places, signed zeros, too many repeats."""
    if limit is not None:
        monkeypatch.setattr(quality, "BROADCAST_LIMIT_BYTES", limit)
    rows = [(i % 40, None if i % 3 else "x", 0.0 if i % 2 else -0.0, None) for i in range(400)]
    rows += [(1000 + i, str(i), float(i), True) for i in range(50)] + [(3, "7", float("nan"), True), (3, "7", float("nan"), True)]
    rows += [(7, None, None, None), (None, None, None, None), (None, None, 7.0, None)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d boolean").repartition(3)
    plain = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    want = sum(r["n"] - 1 for r in plain.collect())
    assert quality.duplicate_count(df, digest).first()[0] == want > 0
    distinct = quality.drop_exact_duplicates(df, digest)
    assert sorted(map(repr, distinct.collect())) == sorted(map(repr, plain.drop("n").collect()))
    score = quality.quality_score(df, digest).first()
    missing = sum(v is None for r in rows for v in r)
    assert (score["total_rows"], score["n_duplicates"]) == (len(rows), want)
    assert score["quality_score"] == round(max(0, 100 - missing * 100 / (4 * len(rows)) - want * 100 / len(rows)), 2)
    summary = quality.clean_summary(df, 0.5, digest).first()
    assert summary["clean_rows"] == quality.clean(df).count() == plain.dropna(thresh=3).count()


def test_only_repeated_rows_are_grouped_whole(spark):
    df = spark.range(1000).select("id", F.col("id").cast("string").alias("text")).unionByName(
        spark.range(5).select("id", F.col("id").cast("string").alias("text")))
    copies, others = quality._by_digest(df)
    assert copies.count() == 5 and others.count() == 995


def test_duplicates_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert quality.duplicate_count(df).first()[0] == 0 and quality.drop_exact_duplicates(df).count() == 0
    assert tuple(quality.clean_summary(df).first()) == (0, 0, 0, 100.0)
