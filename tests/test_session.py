"""Broadcasts only of what was measured."""

from pyspark.sql import functions as F

from kpiloom.session import broadcast_if_small, stage, table_bytes


def hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_long_texts_and_arrays_are_measured(spark):
    short = stage(spark.range(100).select("id", F.lit("abc").alias("t")))
    long = stage(spark.range(100).select("id", F.repeat(F.lit("x"), 50_000).alias("t")))
    nested = stage(spark.range(100).select("id", F.array_repeat(F.lit("yyyyyyyyyy"), 5_000).alias("t")))
    assert table_bytes(short, 10**6) < 10_000
    assert table_bytes(long, 10**8) >= 5_000_000 and table_bytes(nested, 10**8) >= 5_000_000
    assert hinted(broadcast_if_small(short, 10**6))
    assert not hinted(broadcast_if_small(long, 10**6)) and not hinted(broadcast_if_small(nested, 10**6))


def test_many_rows_are_enough(spark):
    rows = stage(spark.range(100_000).select("id", F.lit(None).cast("string").alias("t")))
    assert not hinted(broadcast_if_small(rows, 10**6)) and table_bytes(rows, 10**9) == 100_000 * 32


def test_nulls_and_nothing(spark):
    nothing = stage(spark.createDataFrame([], "a string, b array<int>"))
    assert table_bytes(nothing, 10) == 0 and hinted(broadcast_if_small(nothing, 10))
    nulls = stage(spark.createDataFrame([(None, None)], "a string, b array<int>"))
    assert 0 < table_bytes(nulls, 10**6) < 200
