"""Incremental forms of two batch operators, on Structured Streaming.

Both keep one state row per entity and open window, which the watermark closes;
late samples beyond it are ignored.  Use append mode: each result is final.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import expr as E
from kpiloom.operators.quality import quality_aggregates


def incident_slots_stream(
    samples: DataFrame,
    delay: str = "30 minutes",
    width: str = "15 minutes",
    entity: str = "cell_name",
    ts: str = "ts",
    label: str = "is_anomaly",
    tiebreak: str = "event_id",
) -> DataFrame:
    """First anomalous sample of every (entity, slot), as in the batch operator."""
    timed = samples.filter(F.col(label)).withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    first = F.min(F.struct(F.col(ts).alias("ts"), F.col(tiebreak).alias("id")))
    return (
        timed.groupBy(entity, F.window(ts, width).alias("_slot"))
        .agg(first.alias("_first"))
        .select(
            F.col("_first.id").alias(tiebreak), entity, F.col("_first.ts").alias(ts), F.col("_slot.start").alias("slot")
        )
    )


def window_quality_stream(
    samples: DataFrame,
    features: list[str],
    delay: str = "30 minutes",
    width: str = "5 minutes",
    entity: str = "cell_name",
    ts: str = "ts",
) -> DataFrame:
    """Rows, missing percent and severity per entity and tumbling window."""
    timed = samples.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return (
        timed.groupBy(entity, F.window(ts, width).alias("_w"))
        .agg(*quality_aggregates(features))
        .select(
            entity,
            F.col("_w.start").alias("window_start"),
            "n_rows",
            (F.col("_share") * 100).alias("missing_pct"),
            E.severity("_share").alias("severity"),
        )
    )
