"""Rule-based root cause from a fingerprint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.operators.features import with_baseline

RCA_TYPE = (
    "struct<primary_cause:string,confidence:double,evidence:array<string>,"
    "secondary:array<struct<cause:string,confidence:double,evidence:array<string>>>>"
)


def delta_of(signals: Column | str, metric: str) -> Column:
    """Deviation of one metric in a fingerprint; 0 when it is not there."""
    hit = F.filter(E.col(signals), lambda s: (s["metric"] == metric) & ~s["type"].eqNullSafe("shap"))
    return F.coalesce(F.get(hit, F.lit(0))["delta_pct"], F.lit(0.0))


def cause_of(delta: dict[str, Column]) -> Column:
    """First matching rule wins."""
    bler_up = delta["bler_dl"] > fv.BLER_UP
    cqi_down = delta["cqi_dl"] < fv.CQI_DOWN
    prb_up = delta["prb_dl"] > fv.PRB_UP
    thp_down = delta["thp_dl"] < fv.THP_DOWN
    rrc_down = delta["rrc_rate"] < fv.RRC_DOWN
    power_odd = (delta["energy_eff"] < fv.EFF_DOWN) | (delta["avg_power"] > fv.POWER_UP)
    return (
        F.when(bler_up & cqi_down & ~prb_up, "interference")
        .when(prb_up & thp_down, "high_load")
        .when(rrc_down, "connection_failure")
        .when(power_odd, "power_anomaly")
        .when(thp_down & ~prb_up, "low_throughput")
        .otherwise("inconclusive")
    )


def confidence_of(cause: Column | str) -> Column:
    table = F.create_map(*[F.lit(x) for pair in fv.CAUSE_CONFIDENCE.items() for x in pair])
    return E.clamp01(F.try_element_at(table, E.col(cause)))


def evidence(cause: Column | str, delta: dict[str, Column], signals: Column | str | None = None) -> Column:
    """Evidence lines of a cause, plus the leading attributions when there are any."""
    c = E.col(cause)

    def line(label: str, metric: str | None) -> Column:
        if metric is None:
            return F.lit(label)
        return F.concat(F.lit(label + " "), E.one_decimal(delta[metric]), F.lit("%"))

    lines = E.lit_array([])
    for name, parts in fv.EVIDENCE.items():
        lines = F.when(c == name, F.array(*[line(*p) for p in parts])).otherwise(lines)
    if signals is None:
        return lines
    drivers = F.filter(E.col(signals), lambda s: s["type"].eqNullSafe("shap"))
    names = F.array_join(F.transform(F.slice(drivers, 1, 3), lambda s: s["metric"]), ", ")
    leading = F.when(F.size(drivers) > 0, F.array(F.concat(F.lit(fv.EVIDENCE_DRIVERS), names)))
    return F.concat(lines, F.coalesce(leading, E.lit_array([])))


def diagnose(df: DataFrame, signals: str = "fingerprint", out: str = "rca") -> DataFrame:
    """Adds a struct of primary cause, confidence, evidence and (empty) secondary causes."""
    names = {m: f"_d_{m}" for m in fv.FINGERPRINT_METRICS}
    wide = df.withColumns({name: delta_of(signals, m) for m, name in names.items()})
    delta = {m: F.col(name) for m, name in names.items()}
    return (
        wide.withColumn("_cause", cause_of(delta))
        .withColumn(
            out,
            F.struct(
                F.col("_cause").alias("primary_cause"),
                confidence_of("_cause").alias("confidence"),
                evidence("_cause", delta, signals).alias("evidence"),
                F.array().alias("secondary"),
            ).cast(RCA_TYPE),
        )
        .drop("_cause", *names.values())
    )


def diagnose_wide(rows: DataFrame, baselines: DataFrame, entity: str = "cell_name") -> DataFrame:
    """Adds ``primary_cause`` and ``confidence`` straight from the KPI columns.

    Same verdict as :func:`diagnose` on a rule-made fingerprint; no arrays are
    built, so the whole step is generated code.  For counting causes.
    """
    present = [m for m in fv.FINGERPRINT_METRICS if m in rows.columns and m in baselines.columns]
    joined = with_baseline(rows, baselines, present, entity)

    def delta(m: str) -> Column:
        base = F.col(f"base_{m}")
        usable = F.when(base != 0, E.deviation_pct(m, base)) if m in present else F.lit(None)
        return F.coalesce(usable, F.lit(0.0))

    wide = joined.withColumns({f"_d_{m}": delta(m) for m in fv.FINGERPRINT_METRICS})
    cause = cause_of({m: F.col(f"_d_{m}") for m in fv.FINGERPRINT_METRICS})
    return (
        wide.withColumn("primary_cause", cause)
        .withColumn("confidence", confidence_of("primary_cause"))
        .drop(*[f"base_{m}" for m in present], *[f"_d_{m}" for m in fv.FINGERPRINT_METRICS])
    )
