"""Stored tables: no exchange in joins and groupings by entity, day filters at the scan."""

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import features
from kpiloom.sources import layout
from tests.conftest import table


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    rows = spark.range(4000).select(
        F.col("id").alias("event_id"), F.concat(F.lit("C"), (F.col("id") % 13).cast("string")).alias("cell_name"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 9 as int), 0, cast(id % 1440 as int))").alias("ts"),
        (F.col("id") % 7).cast("double").alias("x"))
    base = rows.where("cell_name <> 'C3'").groupBy("cell_name").agg(F.avg("x").alias("x"))
    layout.write_samples(rows, "test_samples", f"{path}/samples", buckets=4)
    layout.write_entities(base, "test_baselines", f"{path}/baselines", buckets=4)
    yield rows, base
    spark.sql("DROP TABLE test_samples")
    spark.sql("DROP TABLE test_baselines")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_without_exchange(spark, stored):
    rows, base = stored
    joined = layout.with_stored_baseline(spark, "test_samples", "test_baselines", ["x"])
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    want = features.with_baseline(rows, base, ["x"])
    assert table(joined, "event_id", "x", "base_x") == table(want, "event_id", "x", "base_x")


def test_grouping_by_entity_without_exchange(spark, stored):
    rows, _ = stored
    grouped = spark.table("test_samples").groupBy("cell_name").agg(F.sum("x").alias("x"))
    assert "Exchange" not in plan_of(grouped)
    assert table(grouped, "cell_name", "x") == table(rows.groupBy("cell_name").agg(F.sum("x").alias("x")), "cell_name", "x")


def test_range_reads_its_days_and_bucket(spark, stored):
    rows, _ = stored
    found = layout.stored_between(spark, "test_samples", "C5", "2024-01-03 06:00:00", "2024-01-05 12:00:00")
    plan = found._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString() and "PartitionFilters: [isnotnull(day" in plan.toString()
    want = features.entity_between(rows, "C5", F.expr("timestamp_ntz'2024-01-03 06:00:00'"), F.expr("timestamp_ntz'2024-01-05 12:00:00'"))
    assert table(found, "event_id") == table(want, "event_id") and found.count() > 0


def test_a_day_is_one_file_per_bucket(spark, stored):
    files = spark.table("test_samples").select("day", F.input_file_name().alias("f")).distinct().groupBy("day").count()
    assert files.agg(F.max("count")).first()[0] <= 4
