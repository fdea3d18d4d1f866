import datetime as dt

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.operators import features
from kpiloom.session import stage
from kpiloom.sources import kpi, sinks
from tests.conftest import table


def test_ratio_zero_and_absent(spark):
    df = spark.createDataFrame([(1, 8.0, 10.0), (2, 0.0, 0.0), (3, 5.0, 0.0)], "id int, rrc_succ double, rrc_att double")
    assert table(features.add_ratio(df), "id", "rrc_rate") == [(1, 0.8), (2, None), (3, None)]
    assert table(features.add_ratio(df.drop("rrc_att")), "id", "rrc_rate") == [(1, None), (2, None), (3, None)]


def test_numeric_features_keep_schema_order_and_skip_label(spark):
    df = spark.createDataFrame([], "s string, b int, is_anomaly boolean, a double, c bigint")
    assert features.numeric_features(df) == ["b", "a", "c"]


def test_baselines_normals_only_and_missing_entity(spark):
    rows = [("A", False, 1.0), ("A", False, 3.0), ("A", False, None), ("A", True, 99.0), ("B", True, 5.0), (None, False, 7.0)]
    df = spark.createDataFrame(rows, "cell_name string, is_anomaly boolean, x double")
    assert table(features.entity_baselines(df, ["x"]), "cell_name", "x") == [("A", 2.0)]
    base = stage(features.entity_baselines(df, ["x"]))
    joined = features.with_baseline(df, base, ["x"])
    assert joined.count() == 6
    assert joined.filter("cell_name = 'B'").first()["base_x"] is None


def test_deviation_with_zero_baseline_is_huge_but_finite(spark):
    df = spark.createDataFrame([("A", False, 0.0), ("A", True, 2.0)], "cell_name string, is_anomaly boolean, thp_dl double")
    base = stage(features.entity_baselines(df, ["thp_dl"]))
    out = features.add_deviation_pct(df, base, ["thp_dl"]).filter("is_anomaly").first()["thp_dl__delta_pct"]
    assert out == pytest.approx(2.0 / 1e-9 * 100)


def test_slot_floor(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:29:59.5' AS ts")
    assert features.add_slot(df).first()["slot"] == dt.datetime(2024, 1, 1, 0, 15)


def test_time_range_is_inclusive(spark):
    df = spark.sql("SELECT 'A' AS cell_name, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id * 5) AS ts, id FROM range(4)")
    start, end = F.expr("timestamp_ntz'2024-01-01 00:05:00'"), F.expr("timestamp_ntz'2024-01-01 00:10:00'")
    assert table(features.entity_between(df, "A", start, end), "id") == [(1,), (2,)]


def test_pick_existing_ignores_absent(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, cqi_dl double")
    assert features.pick_existing(df, fv.SAMPLE_METRICS, ["id"]).columns == ["id", "cqi_dl"]


def test_rank_filter_is_cut_before_the_shuffle(spark):
    """A hot group sends n rows per task, not all of them."""
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = features.first_per_group(df, ["k"], ["id"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_severity_direction_family_and_text(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.29,), (0.3,), (None,)], "x double")
    assert [r[0] for r in df.select(E.severity("x")).collect()] == ["low", "medium", "medium", "high", "high"]
    df = spark.createDataFrame([(0.0,), (-1.0,)], "x double")
    assert [tuple(r) for r in df.select(E.direction("x"), E.attribution_direction("x")).collect()] == [
        ("up", "negative"), ("down", "negative")]
    ids = ["us.Anthropic.x", "CLAUDE-nova", "nova-titan", "Titan", "other"]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "m string").select(E.model_family("m")).collect()]
    assert got == ["claude", "claude", "nova", "titan", "unknown"]
    values = [0.25, 0.35, -30.05, 1234567.25, -0.04]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(E.one_decimal("v")).collect()]
    assert got == [f"{v:.1f}" for v in values]


def test_prompt_text(spark):
    ctx = F.create_map(F.lit("k"), F.lit("v"))
    one = spark.range(1)
    assert one.select(E.context_prompt(F.lit("T"), ctx)).first()[0] == "Task: T\n\nContext:\n- k: v\n"
    assert one.select(E.context_prompt(F.lit("T"), ctx, E.lit_array([]))).first()[0] == "Task: T\n\nContext:\n- k: v\n"
    full = one.select(E.context_prompt(F.lit("T"), ctx, E.lit_array(["x", "y"]))).first()[0]
    assert full == "Task: T\n\nContext:\n- k: v\n\nExamples:\n1. x\n2. y\n"


def test_csv_renames_parses_and_normalizes(spark, tmp_path):
    path = tmp_path / "kpi.csv"
    path.write_text("cell_name,timestamp,is_anomaly,DRB.UEThpDl\nA,2024-01-01 00:00:00,true,1.5\nA,2024-01-01 00:05:00,false,NaN\n")
    df = kpi.read_kpi_csv(spark, str(path))
    assert df.columns == ["cell_name", "ts", "is_anomaly", "thp_dl"]
    assert dict(df.dtypes)["ts"] == "timestamp_ntz"
    assert table(df, "is_anomaly", "thp_dl") == [(False, None), (True, 1.5)]
    bad = spark.createDataFrame([("yesterday",)], "ts string")
    with pytest.raises(Exception) as caught:
        kpi.parse_ts(bad).collect()
    assert isinstance(caught.value, SparkRuntimeException) or "CAST_INVALID_INPUT" in str(caught.value)


def test_global_row_number_and_append(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=7).select(((F.col("id") * 7919) % 1000).alias("v"))
    numbered = sinks.global_row_number(df, ["v"])
    assert all(r["row_no"] == r["v"] + 1 for r in numbered.collect())
    path = str(tmp_path / "history")
    sinks.record_cases(df.filter("v < 300"), path, ["v"])
    sinks.record_cases(df.filter("v >= 300"), path, ["v"])
    assert all(r["record_id"] == r["v"] + 1 for r in spark.read.parquet(path).collect())


def test_baseline_csv_round_trip_is_exact(spark, tmp_path):
    df = spark.createDataFrame([("A", 0.1 + 0.2, None), ("B", 2503040.2030537142, 1.0)], "cell_name string, x double, y double")
    path = str(tmp_path / "b")
    sinks.write_baselines(df.select("x", "y", "cell_name"), path)
    assert table(sinks.read_baselines(spark, path, ["x", "y"]), "cell_name", "x", "y") == table(df, "cell_name", "x", "y")
