"""Request payloads of a batch-inference job: one JSON text per case.

Every function adds a ``payload`` column to a table that already has one row
per case.  ``payload`` keeps keys whose value is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E

_KEEP_NULLS = {"ignoreNullFields": "false"}


def _json(value: Column) -> Column:
    return F.to_json(value, _KEEP_NULLS)


def quality_payload(stats: DataFrame, features: list[str], n_stats: int = 5) -> DataFrame:
    """From :func:`kpiloom.operators.quality.batch_stats`."""
    per_feature = F.struct(
        *[
            F.struct(
                F.col(f"{c}_mean").alias("mean"),
                F.col(f"{c}_missing").alias("missing_count"),
                F.col(f"{c}_missing_pct").alias("missing_pct"),
            ).alias(c)
            for c in features[:n_stats]
        ]
    )
    return stats.withColumn(
        "payload", _json(F.struct("total_rows", "columns", per_feature.alias("sample_stats")))
    )


def insight_payload(samples: DataFrame, counts: DataFrame, case: str = "case_id") -> DataFrame:
    """From at most three samples per case and the number of anomalies of the batch."""
    metrics = [m for m in fv.SAMPLE_METRICS if m in samples.columns]
    item = F.struct(
        "pos",
        F.struct(
            "probability",
            F.struct(*[F.coalesce(F.col(m), F.lit(None)).alias(m) for m in metrics]).alias("metrics"),
        ).alias("sample"),
    )
    listed = samples.groupBy(case).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    joined = counts.filter(F.col("anomaly_count") > 0).select(case, "anomaly_count").join(listed, case)
    return joined.select(
        case,
        _json(
            F.struct(
                F.col("anomaly_count").alias("total_anomalies"),
                F.transform("_items", lambda x: x["sample"]).alias("samples"),
            )
        ).alias("payload"),
    )


def signal_payload(df: DataFrame, deviations: str = "deviations") -> DataFrame:
    items = F.transform(
        deviations,
        lambda s: F.struct(
            s["metric"].alias("metric"),
            s["value"].alias("current"),
            s["baseline"].alias("baseline"),
            s["delta_pct"].alias("delta_pct"),
            s["dir"].alias("direction"),
        ),
    )
    return df.withColumn("payload", _json(items))


def diagnosis_payload(df: DataFrame, signals: str = "fingerprint") -> DataFrame:
    """Deviations and attributions apart; attributions are null when there are none."""
    moved = F.filter(signals, lambda s: ~s["type"].eqNullSafe("shap"))
    driven = F.filter(signals, lambda s: s["type"].eqNullSafe("shap"))
    deltas = F.transform(
        moved,
        lambda s: F.struct(
            s["metric"].alias("metric"),
            s["delta_pct"].alias("delta_pct"),
            s["dir"].alias("direction"),
            s["value"].alias("current_value"),
            s["baseline"].alias("baseline"),
        ),
    )
    drivers = F.transform(
        driven,
        lambda s: F.struct(
            s["metric"].alias("feature"), s["attr_value"].alias("shap_value"), s["attr_dir"].alias("direction")
        ),
    )
    return df.withColumn(
        "payload",
        _json(
            F.struct(
                deltas.alias("delta_based_signals"),
                F.when(F.size(driven) > 0, drivers).alias("shap_attribution"),
            )
        ),
    )


def plan_payload(df: DataFrame, rca: str = "rca", entity: str = "cell_name") -> DataFrame:
    """Diagnosis summary and the allowed actions."""
    r = F.col(rca)
    allowed = F.struct(
        *[
            F.struct(
                F.lit(text).alias("description"),
                E.lit_array(names).alias("params"),
                F.lit(reversible).alias("reversible"),
                F.lit(risk).alias("risk"),
            ).alias(action)
            for action, names, reversible, risk, text in fv.ACTIONS
        ]
    )
    summary = F.struct(
        F.coalesce(r["primary_cause"], F.lit(fv.UNKNOWN)).alias("primary_cause"),
        F.coalesce(r["confidence"], F.lit(0.0)).alias("confidence"),
        F.slice(r["evidence"], 1, 5).alias("evidence"),
        F.slice(r["secondary"], 1, 2).alias("secondary_hypotheses"),
    )
    return df.withColumn(
        "payload",
        _json(F.struct(F.col(entity).alias("cell"), summary.alias("diagnosis"), allowed.alias("available_actions"))),
    )


def execution_payload(df: DataFrame, plan: str = "plan") -> DataFrame:
    """Plan, guardrails and blast radius; needs ``n_cells`` and ``blast_radius_ok``."""
    p = F.col(plan)
    guardrails = F.struct(
        F.lit(fv.MAX_BLAST_RADIUS).alias("max_blast_radius"),
        F.lit(fv.REQUIRE_CHANGE_WINDOW).alias("require_change_window"),
        F.lit(fv.AUTO_ROLLBACK).alias("auto_rollback_on_failure"),
        F.lit(fv.MANUAL_INTERVENTION).alias("manual_intervention_threshold"),
    )
    return df.withColumn(
        "payload",
        _json(
            F.struct(
                p["actions"].alias("actions"),
                p["prechecks"].alias("prechecks"),
                p["postchecks"].alias("postchecks"),
                p["sla"].alias("sla"),
                guardrails.alias("guardrails"),
                F.col("n_cells").alias("affected_cells"),
                F.col("blast_radius_ok").alias("blast_radius_ok"),
            )
        ),
    )


def verification_payload(wide: DataFrame, metrics: list[str] = fv.VERIFY_METRICS, plan: str | None = None,
                         entity: str = "cell_name") -> DataFrame:
    """From :func:`kpiloom.operators.verify.verification_wide`."""
    def values(prefix: str) -> Column:
        return F.struct(*[F.col(f"{prefix}_{m}").alias(m) for m in metrics if f"{prefix}_{m}" in wide.columns])

    parts = [
        F.col(entity).alias("cell"),
        values("before").alias("before"),
        values("after").alias("after"),
        values("base").alias("baseline"),
    ]
    if plan:
        p = F.col(plan)
        taken = F.transform(p["actions"], lambda a: F.struct(a["id"].alias("id"), a["params"].alias("params")))
        parts += [p["postchecks"].alias("postchecks"), taken.alias("actions_taken")]
    return wide.withColumn("payload", _json(F.struct(*parts)))


def learning_payload(summaries: DataFrame) -> DataFrame:
    """From :func:`kpiloom.operators.knowledge.case_summary`."""
    return summaries.withColumn("payload", _json(F.struct(*summaries.columns)))
