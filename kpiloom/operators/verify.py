"""KPIs before and after an incident, next to the entity baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.operators.features import with_baseline


def verification_wide(
    before: DataFrame, after: DataFrame, baselines: DataFrame,
    metrics: list[str] = fv.VERIFY_METRICS, entity: str = "cell_name", case: str = "case_id",
) -> DataFrame:
    """One row per case: before, after and baseline value of every metric.

    A case without an after row falls back to its before row.
    """
    metrics = [m for m in metrics if m in before.columns]
    left = before.select(case, entity, *[F.col(m).alias(f"before_{m}") for m in metrics])
    right = after.select(case, F.lit(True).alias("_has_after"), *[F.col(m).alias(f"after_{m}") for m in metrics])
    joined = left.join(right, case, "left").withColumns(
        {
            f"after_{m}": F.when(F.col("_has_after"), F.col(f"after_{m}")).otherwise(F.col(f"before_{m}"))
            for m in metrics
        }
    )
    return with_baseline(joined, baselines, metrics, entity).drop("_has_after")


def verification_context(
    before: DataFrame, after: DataFrame, baselines: DataFrame,
    metrics: list[str] = fv.VERIFY_METRICS, entity: str = "cell_name", case: str = "case_id",
) -> DataFrame:
    """Long form: one row per case and metric with its three values."""
    metrics = [m for m in metrics if m in before.columns]
    wide = verification_wide(before, after, baselines, metrics, entity, case)
    return _long(wide, metrics, entity, case)


def window_context(
    windows: DataFrame, baselines: DataFrame, metrics: list[str] = fv.VERIFY_METRICS, entity: str = "cell_name",
    case: str = "case_id",
) -> DataFrame:
    """:func:`verification_context` of structs ``before`` and ``after`` that are in one row already: no join but the baseline's."""
    wide = windows.where(F.col("before").isNotNull()).select(
        case, entity,
        *[F.col("before")[m].alias(f"before_{m}") for m in metrics],
        *[F.coalesce("after", "before")[m].alias(f"after_{m}") for m in metrics],
    )
    return _long(with_baseline(wide, baselines, metrics, entity), metrics, entity, case)


def _long(wide: DataFrame, metrics: list[str], entity: str, case: str) -> DataFrame:
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"before_{m}").cast("double").alias("before"),
            F.col(f"after_{m}").cast("double").alias("after"),
            F.col(f"base_{m}").cast("double").alias("baseline"),
        )
        for m in metrics
    ]
    return wide.select(case, entity, F.inline(F.array(*rows)))


def kpi_improvements(context: DataFrame) -> DataFrame:
    """Percent change and whether it is an improvement, by the metric's polarity.

    No change is no improvement; a metric without polarity gives NULL.
    """
    polarity = F.create_map(*[x for m, p in fv.POLARITY.items() for x in (F.lit(m), F.lit(p))])
    return (
        context.withColumn("change_pct", F.try_divide((F.col("after") - F.col("before")) * 100, F.col("before")))
        .withColumn("improved", (F.col("after") - F.col("before")) * F.try_element_at(polarity, F.col("metric")) > 0)
    )
