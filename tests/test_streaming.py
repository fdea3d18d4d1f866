"""A stream of files, read in several batches, gives what the batch operator gives."""

from pyspark.sql import functions as F

from kpiloom.operators import cases, quality
from kpiloom.sources import views
from kpiloom.streaming import incidents
from tests.conftest import table

SMALL = "/root/testdata/sf0.001"


def _stream(spark, tmp_path):
    """KPI samples in time order, one file per third."""
    kpi = views.kpi_view(spark, SMALL)
    for i, (low, high) in enumerate(((0, 300), (300, 700), (700, 10**9))):
        kpi.filter(f"event_id >= {low} AND event_id < {high}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return kpi, spark.readStream.schema(kpi.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def _run(stream, tmp_path, name):
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / f"{name}-state"))
        .option("path", str(tmp_path / name)).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(str(tmp_path / name))


def test_incident_slots(spark, tmp_path):
    kpi, stream = _stream(spark, tmp_path)
    # Files may be picked up out of order: the delay spans the whole table but its last part.
    got = _run(incidents.incident_slots_stream(stream, delay="20 days"), tmp_path, "slots")
    border = kpi.filter("is_anomaly").agg((F.max("ts") - F.expr("INTERVAL 20 DAYS")).alias("b"))
    want = cases.incident_slots(kpi).join(border, F.col("slot") + F.expr("INTERVAL 15 MINUTES") <= F.col("b"))
    assert want.count() > 0
    assert table(got, "event_id", "cell_name") == table(want, "event_id", "cell_name")


def test_window_quality(spark, tmp_path):
    kpi, stream = _stream(spark, tmp_path)
    features = ["thp_dl", "prb_dl"]
    got = _run(incidents.window_quality_stream(stream, features, delay="20 days", width="1 day"), tmp_path, "quality")
    border = kpi.agg((F.max("ts") - F.expr("INTERVAL 20 DAYS")).alias("b"))
    daily = kpi.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    keyed = daily.withColumn("case_id", F.concat_ws("|", "cell_name", F.col("day").cast("string")))
    closed = keyed.join(border, F.col("day") + F.expr("INTERVAL 1 DAY") <= F.col("b"))
    want = quality.batch_quality(closed, features)
    ours = got.withColumn("case_id", F.concat_ws("|", "cell_name", F.col("window_start").cast("string")))
    assert want.count() > 0
    assert table(ours, "case_id", "n_rows", "missing_pct", "severity") == table(want, "case_id", "n_rows", "missing_pct", "severity")
