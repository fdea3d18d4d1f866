"""Incidents and the samples around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import expr as E
from kpiloom.operators.features import add_slot, anomalies, first_per_group
from kpiloom.operators.sliding import last_in_window


def incident_slots(
    df: DataFrame,
    width: str = "15 minutes",
    entity: str = "cell_name",
    ts: str = "ts",
    label: str = "is_anomaly",
    tiebreak: str = "event_id",
) -> DataFrame:
    """The first anomalous sample of every (entity, time slot)."""
    slotted = add_slot(anomalies(df, label), ts, width)
    return first_per_group(slotted, [entity, "slot"], [ts, tiebreak])


def take_cases(
    cases: DataFrame, n: int, entity: str = "cell_name", ts: str = "ts", tiebreak: str = "event_id"
) -> DataFrame:
    """The first n incidents in entity and time order."""
    return cases.orderBy(entity, ts, tiebreak).limit(n)


def as_cases(incidents: DataFrame, entity: str = "cell_name", ts: str = "ts", case_id: str = "event_id") -> DataFrame:
    """Key columns of an incident: case id, entity, start time."""
    return incidents.select(F.col(case_id).alias("case_id"), entity, F.col(ts).alias("t0"))


def interval_join(
    cases: DataFrame,
    samples: DataFrame,
    before_seconds: int,
    after_seconds: int,
    entity: str = "cell_name",
    ts: str = "ts",
) -> DataFrame:
    """Samples of the case's entity with t0 - before <= time <= t0 + after.

    Time is cut into buckets as wide as the interval.  A case goes to the one or
    two buckets its interval touches, a sample to exactly one, so the join has an
    equality key of entity and bucket: a busy entity spreads over its buckets, no
    pair comes up twice, and what still is skewed is split by adaptive execution.
    """
    width = (before_seconds + after_seconds) * 1_000_000

    def bucket(column):
        return F.floor(E.epoch_micros(column) / width)

    start, end = E.shift_seconds("t0", -before_seconds), E.shift_seconds("t0", after_seconds)
    placed_cases = cases.select(
        *cases.columns,
        start.alias("_start"),
        end.alias("_end"),
        F.explode(F.sequence(bucket(start), bucket(end))).alias("_bucket"),
    )
    placed_samples = samples.withColumn("_bucket", bucket(ts))
    joined = placed_cases.join(placed_samples, [entity, "_bucket"])
    return joined.filter(F.col(ts).between(F.col("_start"), F.col("_end"))).drop("_start", "_end", "_bucket")


def lookback_batch(
    cases: DataFrame, samples: DataFrame, seconds: int = 300, entity: str = "cell_name", ts: str = "ts"
) -> DataFrame:
    """All samples of the lookback interval, both ends included."""
    return interval_join(cases, samples, seconds, 0, entity, ts)


def before_row(batches: DataFrame, ts: str = "ts", tiebreak: str = "event_id") -> DataFrame:
    """The latest sample of each batch."""
    return first_per_group(batches, ["case_id"], [F.desc(ts), F.desc(tiebreak)])


def row_at_start(
    cases: DataFrame, samples: DataFrame, entity: str = "cell_name", ts: str = "ts", tiebreak: str = "event_id"
) -> DataFrame:
    """The latest sample of the lookback batch of cases that start at one of the samples.

    The batch ends at t0 and holds the sample at t0, so its last row is the last
    one at exactly t0: an equality join finds it without building the batch.
    """
    at_start = cases.join(samples.withColumn("t0", F.col(ts)), [entity, "t0"])
    return first_per_group(at_start, ["case_id"], [F.desc(tiebreak)])


def after_row(
    cases: DataFrame,
    samples: DataFrame,
    seconds: int = 900,
    entity: str = "cell_name",
    ts: str = "ts",
    tiebreak: str = "event_id",
    columns: list[str] | None = None,
) -> DataFrame:
    """The last sample within the look-ahead interval of each case.

    The interval holds the sample at t0 itself, so every case that starts at one
    of its samples has a row.
    """
    return last_in_window(cases, samples, 0, seconds, columns, entity, ts, tiebreak)
