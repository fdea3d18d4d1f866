"""The whole incident run, over every case at once.

load -> ratio -> baselines -> deviation features -> split, train, score ->
incidents -> batches -> quality and detection -> fingerprint -> diagnosis ->
plan -> blast radius -> execution record -> before/after -> verdict -> case table.

Model answers come in as tables; a step without answers uses its rule result, or
stays empty where there is no rule (plan and verdict).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.operators import (
    cases,
    detect,
    diagnose,
    features,
    fingerprint,
    planning,
    quality,
    report,
    responses,
    sliding,
    verify,
)
from kpiloom.session import stage
from kpiloom.sources import sinks


@dataclass
class IncidentRun:
    """Tables of one run; ``cases`` has one row per case."""

    baselines: DataFrame
    model: PipelineModel
    features: list[str]
    metrics: DataFrame
    cases: DataFrame
    verification: DataFrame


def prepare(kpi: DataFrame, entity: str = "cell_name") -> tuple[DataFrame, DataFrame, list[str]]:
    """Samples with ratio and deviation features, staged baselines, feature names."""
    rows = features.add_ratio(kpi)
    present = [c for c in fv.KPIS if c in rows.columns]
    baselines = stage(features.entity_baselines(rows, present, entity), "baselines")
    prepared = features.add_deviation_pct(rows, baselines, entity=entity)
    return prepared, baselines, features.model_features(prepared)


def build_cases(
    scored: DataFrame,
    baselines: DataFrame,
    used: list[str],
    answers: dict[str, DataFrame] | None = None,
    num_cases: int | None = None,
    lookback_seconds: int = 300,
    ahead_seconds: int = 900,
    entity: str = "cell_name",
    model: PipelineModel | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Case table and verification context from scored samples.

    ``answers`` maps quality, profiler, rca, planner, executor and verifier to
    tables ``(case_id, text)``.  A case in whose batch no sample is predicted
    anomalous is dropped.  With a ``model``, each fingerprint ends with the case's
    strongest feature attributions.
    """
    answers = answers or {}
    found = cases.incident_slots(scored, entity=entity)
    if num_cases is not None:
        found = cases.take_cases(found, num_cases, entity)
    found = stage(cases.as_cases(found, entity), "incidents")
    # Two passes over the samples, however many cases: sums of each lookback, and the rows at its end and ahead.
    values = quality.window_values(used) | detect.detection_values()
    rolled = (
        sliding.window_aggregates(found, scored, lookback_seconds, 0, values, entity)
        .filter("_any > 0")
        .withColumn("_share", quality.window_share(used))
        .select(
            "case_id",
            F.struct(
                "n_rows",
                (F.col("_share") * 100).alias("missing_pct"),
                F.array(F.lit(fv.ISSUE_BASIC_CHECK)).alias("issues"),
                E.severity("_share").alias("severity"),
            ).alias("quality"),
            F.struct(F.lit(True).alias("is_anomaly_any"), "anomaly_count", "max_probability").alias("detection"),
        )
    )
    windows = {"before": (lookback_seconds, 0), "after": (0, ahead_seconds)}
    rows = stage(sliding.last_in_windows(found, scored, windows, entity=entity), "case-windows")
    if "quality" in answers:
        rolled = stage(rolled, "rolled")
        sized = answers["quality"].join(rolled.select("case_id", "quality.n_rows"), "case_id")
        rolled = responses.coalesce_response(rolled, responses.quality_response(sized), "quality").drop("source")

    last = rows.select("case_id", entity, "t0", "before.*").join(rolled, "case_id")
    profiled = fingerprint.fingerprint(last, baselines, entity=entity)
    if "profiler" in answers:
        listed = responses.signal_response(answers["profiler"])
        full = F.transform(
            "signals",
            lambda s: F.struct(
                *[s[k].alias(k) for k in fv.REQUIRED_SIGNAL_KEYS],
                F.lit(None).cast("double").alias("attr_value"),
                F.lit(None).cast("string").alias("attr_dir"),
                F.lit(None).cast("string").alias("type"),
            ),
        )
        picked = listed.select("case_id", "valid", full.alias("fingerprint"))
        profiled = responses.coalesce_response(profiled, picked, "fingerprint").drop("source")
    if model is not None:
        last = stage(last.select("case_id", entity, *used), "case-rows")
        moved = detect.shapley_contributions(model, last, used, baselines, entity)
        profiled = profiled.join(detect.attribution_columns(moved, used), "case_id", "left")
        strongest = fingerprint.top_attributions({f: F.col(f"attr_{f}") for f in used})
        profiled = profiled.withColumn("fingerprint", F.concat("fingerprint", strongest)).drop(*[f"attr_{f}" for f in used])
    diagnosed = diagnose.diagnose(profiled)
    if "rca" in answers:
        diagnosed = responses.coalesce_response(
            diagnosed, responses.diagnosis_response(answers["rca"]), "rca"
        ).drop("source")
    before = stage(diagnosed, "diagnosed")

    table = before.select("case_id", entity, "t0", "quality", "detection", "fingerprint", "rca")
    if "planner" in answers:
        # Parsed once: the table is read three times below.
        plans = stage(planning.assemble_plans(answers["planner"]), "plans")
        touched = planning.blast_radius(
            plans.filter("error IS NULL").select("case_id", F.explode("plan.actions").alias("a")).select("case_id", "a.params")
        )
        plans = plans.withColumn("plan", F.when(F.col("error").isNull(), F.col("plan")))
        table = table.join(plans.withColumnRenamed("error", "plan_error"), "case_id", "left").join(touched, "case_id", "left")
        if "executor" in answers:
            planned = plans.filter("error IS NULL").select("case_id", "plan")
            run = responses.execution_response(
                planned.join(answers["executor"], "case_id", "left").withColumn("_actions", F.col("plan.actions")),
                "_actions",
            )
            table = table.join(run.select("case_id", "execution"), "case_id", "left")
    if "verifier" in answers:
        verdicts = responses.verdict_response(answers["verifier"])
        table = table.join(verdicts.select("case_id", "closed", "residual_risk"), "case_id", "left")
    metrics = [m for m in fv.VERIFY_METRICS if m in scored.columns]
    reported = rows.join(before.select("case_id"), "case_id", "left_semi")
    context = verify.kpi_improvements(verify.window_context(reported, baselines, metrics, entity))
    return table, context


def run_incidents(
    kpi: DataFrame,
    answers: dict[str, DataFrame] | None = None,
    num_cases: int | None = None,
    out: str | None = None,
    trees: int = 200,
    max_depth: int = 30,
    lookback_seconds: int = 300,
    ahead_seconds: int = 900,
    entity: str = "cell_name",
    attribute: bool = False,
) -> IncidentRun:
    """Full run; ``attribute`` adds feature attributions to the fingerprints; with ``out`` the model, the baselines and the case history are written there."""
    prepared, baselines, used = prepare(kpi, entity)
    split = stage(detect.stratified_split(prepared), "prepared")
    model = detect.train_detector(split.filter("NOT is_test"), used, trees=trees, max_depth=max_depth)
    scored = stage(detect.score(model, split, used), "scored")
    metrics = detect.evaluate(scored.filter("is_test"))
    table, context = build_cases(
        scored.drop("is_test"), baselines, used, answers, num_cases, lookback_seconds, ahead_seconds, entity,
        model if attribute else None,
    )
    table = stage(table, "cases")
    if out:
        sinks.save_model(model, f"{out}/detector")
        sinks.write_baselines(baselines, f"{out}/baselines", entity)
        sinks.write_cases(table, f"{out}/cases")
    return IncidentRun(baselines, model, used, metrics, table, context)


def summarize(run_cases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Closure summary and cause breakdown of a case table."""
    flat = run_cases.select("case_id", "rca.primary_cause", *(["closed"] if "closed" in run_cases.columns else []))
    if "closed" not in flat.columns:
        flat = flat.withColumn("closed", F.lit(False))
    return report.closure_summary(flat), report.cause_breakdown(flat)

