"""Deviation fingerprints: which KPIs moved, and by how much.

A row has a fixed handful of metrics, so all of this is array work inside one
row: no shuffle between reading a case row and its finished fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.operators.features import with_baseline

#: Element type of a fingerprint; attribution entries use the attr_* fields.
SIGNAL_TYPE = (
    "struct<metric:string,value:double,baseline:double,delta_pct:double,dir:string,"
    "attr_value:double,attr_dir:string,type:string>"
)
_NO_SIGNALS = f"array<{SIGNAL_TYPE}>"


def _signal(metric: str, position: int) -> Column:
    value, base = F.col(metric), F.col(f"base_{metric}")
    delta = E.deviation_pct(value, base)
    usable = value.isNotNull() & base.isNotNull() & (base != 0)
    return F.when(
        usable,
        F.struct(
            F.lit(metric).alias("metric"),
            value.cast("double").alias("value"),
            base.cast("double").alias("baseline"),
            delta.alias("delta_pct"),
            E.direction(delta).alias("dir"),
            F.lit(position).alias("ord"),
        ),
    )


def deviation_array(rows: DataFrame, baselines: DataFrame, metrics: list[str] = fv.FINGERPRINT_METRICS,
                    entity: str = "cell_name") -> DataFrame:
    """Adds ``deviations``: one struct per metric with a value and a usable baseline.

    Unlike the deviation features, a metric with a zero baseline is skipped.
    """
    present = [m for m in metrics if m in rows.columns and m in baselines.columns]
    joined = with_baseline(rows, baselines, present, entity)
    signals = F.array_compact(F.array(*[_signal(m, i) for i, m in enumerate(present)]))
    return joined.withColumn("deviations", signals).drop(*[f"base_{m}" for m in present])


def deviations(rows: DataFrame, baselines: DataFrame, keys: list[str],
               metrics: list[str] = fv.FINGERPRINT_METRICS, entity: str = "cell_name") -> DataFrame:
    """Long form: one row per case row and deviating metric."""
    return deviation_array(rows, baselines, metrics, entity).select(*keys, F.inline("deviations"))


def top_deviations(signals: Column | str = "deviations", k: int = fv.TOP_SIGNALS) -> Column:
    """The k largest deviations by absolute value; ties keep metric order."""
    ranked = F.sort_array(
        F.transform(
            E.col(signals),
            lambda s: F.struct((-F.abs(s["delta_pct"])).alias("rank"), s["ord"].alias("ord"), s.alias("s")),
        )
    )
    top = F.slice(ranked, 1, k)
    return F.transform(
        top,
        lambda r: F.struct(
            r["s"]["metric"].alias("metric"),
            r["s"]["value"].alias("value"),
            r["s"]["baseline"].alias("baseline"),
            r["s"]["delta_pct"].alias("delta_pct"),
            r["s"]["dir"].alias("dir"),
            F.lit(None).cast("double").alias("attr_value"),
            F.lit(None).cast("string").alias("attr_dir"),
            F.lit(None).cast("string").alias("type"),
        ),
    ).cast(_NO_SIGNALS)


def top_attributions(contributions: dict[str, Column], k: int = fv.TOP_ATTRIBUTIONS) -> Column:
    """The k strongest attributions of a row; ``contributions`` in feature order."""
    entries = F.array_compact(
        F.array(
            *[
                F.when(
                    c.isNotNull(),
                    F.struct(
                        (-F.abs(c)).alias("rank"), F.lit(i).alias("ord"), F.lit(name).alias("metric"), c.alias("v")
                    ),
                )
                for i, (name, c) in enumerate(contributions.items())
            ]
        )
    )
    return F.transform(
        F.slice(F.sort_array(entries), 1, k),
        lambda r: F.struct(
            r["metric"].alias("metric"),
            F.lit(None).cast("double").alias("value"),
            F.lit(None).cast("double").alias("baseline"),
            F.lit(None).cast("double").alias("delta_pct"),
            F.lit(None).cast("string").alias("dir"),
            r["v"].alias("attr_value"),
            E.attribution_direction(r["v"]).alias("attr_dir"),
            F.lit("shap").alias("type"),
        ),
    ).cast(_NO_SIGNALS)


def fingerprint(rows: DataFrame, baselines: DataFrame, contributions: dict[str, Column] | None = None,
                metrics: list[str] = fv.FINGERPRINT_METRICS, entity: str = "cell_name") -> DataFrame:
    """Adds ``fingerprint``: top deviations, then top attributions when given."""
    profiled = deviation_array(rows, baselines, metrics, entity)
    signals = top_deviations("deviations")
    if contributions:
        signals = F.concat(signals, top_attributions(contributions))
    return profiled.withColumn("fingerprint", signals).drop("deviations")
