"""Derived columns, per-entity baselines and deviation features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.operators.percentiles import LARGE_GROUP, group_percentiles
from kpiloom.session import broadcast_if_small


def add_ratio(df: DataFrame, num: str = "rrc_succ", den: str = "rrc_att", out: str = fv.RATE_KPI) -> DataFrame:
    """num / den; all NULL when either column is absent."""
    if num in df.columns and den in df.columns:
        return df.withColumn(out, E.ratio(num, den))
    return df.withColumn(out, F.lit(None).cast("double"))


def numeric_features(df: DataFrame, exclude: tuple[str, ...] = ("is_anomaly",)) -> list[str]:
    """Numeric columns in schema order, without the label and other excluded ones."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def anomalies(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    return df.filter(F.col(label))


def normals(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    return df.filter(~F.col(label))


def fill_features(df: DataFrame, features: list[str], value: float = 0.0) -> DataFrame:
    return df.fillna(value, subset=features)


def add_slot(df: DataFrame, ts: str = "ts", width: str = "15 minutes", out: str = "slot") -> DataFrame:
    """Start of the time slot a sample falls into, counted from the epoch."""
    return df.withColumn(out, F.window(ts, width)["start"])


def entity_between(df: DataFrame, entity_value, start, end, entity: str = "cell_name", ts: str = "ts") -> DataFrame:
    """Rows of one entity with both time limits included (both filters reach the scan)."""
    return df.filter((F.col(entity) == entity_value) & F.col(ts).between(start, end))


def pick_existing(df: DataFrame, metrics: list[str], keep: list[str]) -> DataFrame:
    """``keep`` plus those listed metrics the table has, in list order."""
    return df.select(*keep, *[m for m in metrics if m in df.columns])


def entity_baselines(
    df: DataFrame,
    features: list[str],
    entity: str = "cell_name",
    label: str | None = "is_anomaly",
    approximate: bool = False,
    large: int = LARGE_GROUP,
) -> DataFrame:
    """Median of every feature over the normal rows of each entity.

    ``approximate`` swaps the exact median for one bounded sketch per entity.
    """
    rows = (normals(df, label) if label else df).filter(F.col(entity).isNotNull())
    if approximate:
        return rows.groupBy(entity).agg(*[F.percentile_approx(c, 0.5, 10_000).alias(c) for c in features])
    medians = group_percentiles(rows, [entity], features, [0.5], large)
    return medians.select(entity, *[F.get(c, F.lit(0)).alias(c) for c in features])


def with_baseline(
    df: DataFrame, baselines: DataFrame, metrics: list[str], entity: str = "cell_name", prefix: str = "base_"
) -> DataFrame:
    """Left lookup of baseline columns; an entity without baseline gives NULLs.

    ``baselines`` should be staged (see :func:`kpiloom.session.stage`): the table
    is broadcast only after its size was checked.
    """
    looked_up = baselines.select(entity, *[F.col(m).alias(prefix + m) for m in metrics])
    return df.join(broadcast_if_small(looked_up), entity, "left")


def add_deviation_pct(
    df: DataFrame, baselines: DataFrame, kpis: list[str] = fv.DELTA_KPIS, entity: str = "cell_name"
) -> DataFrame:
    """Percent deviation of each KPI from its entity baseline.

    A zero baseline gives a huge finite number here (the fingerprint skips it).
    """
    kpis = [k for k in kpis if k in df.columns]
    joined = with_baseline(df, baselines, kpis, entity)
    return joined.withColumns(
        {k + fv.DELTA_SUFFIX: E.deviation_pct(k, f"base_{k}") for k in kpis}
    ).drop(*[f"base_{k}" for k in kpis])


def model_features(df: DataFrame, exclude: tuple[str, ...] = ("event_id",)) -> list[str]:
    """Everything numeric the detector may look at; ids are never features."""
    return numeric_features(df, exclude=("is_anomaly", *exclude))


def profile(df: DataFrame, features: list[str], entity: str = "cell_name", approximate: bool = False) -> DataFrame:
    """Rows, distinct entities and number of features in one row."""
    distinct = F.approx_count_distinct(entity) if approximate else F.count_distinct(entity)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        distinct.alias("n_entities"),
    ).withColumn("n_features", F.lit(len(features)))


def first_per_group(df: DataFrame, keys: list[str], order: list, n: int = 1, out: str | None = None) -> DataFrame:
    """The first n rows of each group.

    A rank filter of this form is cut to n rows per group before the shuffle, so
    a hot group costs no more than any other.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = df.withColumn(out or "_position", position).filter(F.col(out or "_position") <= n)
    return ranked if out else ranked.drop("_position")
