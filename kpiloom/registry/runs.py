"""Composed jobs: the whole incident run, case memory and the quality audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.operators import diagnose
from kpiloom.plans import case_memory, incident_run, quality_audit
from kpiloom.registry import tables  # noqa: F401  its check SQL is read below
from kpiloom.registry.base import CHECKS, answers_sql, check_sql, query, r, rounded
from kpiloom.registry.incidents import _SB, _scored
from kpiloom.registry.inputs import SIX_HOURS, anomalies_profiled, baselines
from kpiloom.registry.plans_and_answers import (
    _CASE_SIGNALS,
    _DIAG,
    _OBJ,
    _PLANS,
    _SUMMARY_CTES,
    _VERDICT,
    _get,
    _type,
)
from kpiloom.session import stage_path
from kpiloom.sources import views


def _answers(spark, d):
    names = {
        "rca": "diagnosis_answers", "planner": "plan_answers", "executor": "execution_answers", "verifier": "verdicts",
    }
    return {agent: views.view(spark, d, name).select("case_id", "text") for agent, name in names.items()}


_RUN = (
    "SELECT b.case_id, b.cell_name, "
    "CASE WHEN g.valid THEN g.primary_cause ELSE c.primary_cause END AS primary_cause, "
    "CASE WHEN p.actions IS NULL THEN 'none' ELSE p.actions END AS actions, "
    "CASE WHEN p.actions IS NULL THEN 'none' WHEN x.j IS NULL THEN 'ok' "
    "ELSE coalesce(json_extract_string(x.j, '$.status'), 'none') END AS status, coalesce(v.closed AND v.valid, false) AS closed, "
    "n.hits AS anomaly_count FROM before_r b JOIN (SELECT case_id, sum(prediction)::bigint AS hits FROM sb GROUP BY case_id "
    "HAVING max(prediction) > 0) n ON n.case_id = b.case_id JOIN cause c ON c.event_id = b.event_id "
    "LEFT JOIN g ON g.case_id = b.case_id LEFT JOIN p ON p.case_id = b.case_id LEFT JOIN ex x ON x.case_id = b.case_id "
    "LEFT JOIN v ON v.case_id = b.case_id"
)
_RUN_CTES = {**_SUMMARY_CTES, "ans_g": answers_sql("diagnosis_answers"), "g": _DIAG.replace("FROM ans", "FROM ans_g"), "sb": _SB}


def _run(spark, d):
    return incident_run.build_cases(
        _scored(spark, d), baselines(spark, d), fv.KPIS, _answers(spark, d),
        lookback_seconds=SIX_HOURS, ahead_seconds=SIX_HOURS,
    )


@query("incident_run", check_sql(
    _RUN, "before_r", "cause", "scored", "diagnosis_answers", "plan_answers", "execution_answers", "verdicts", **_RUN_CTES))
def incident_run_cases(spark, d):
    table, _ = _run(spark, d)
    listed = F.transform("plan.actions", lambda a: F.concat(a["id"], F.lit(":"), a["reversible"].cast("string")))
    return table.select(
        "case_id", "cell_name", "rca.primary_cause",
        F.coalesce(F.array_join(listed, ","), F.lit("none")).alias("actions"),
        F.when(F.col("plan").isNull(), "none").otherwise(F.coalesce("execution.status", F.lit("none"))).alias("status"),
        F.coalesce("closed", F.lit(False)).alias("closed"),
        F.col("detection.anomaly_count").alias("anomaly_count"),
    )


@query("run_closure", check_sql(
    f"SELECT count(*) AS total_cases, count_if(closed)::bigint AS closed_cases, "
    f"{r('count_if(closed) * 1e2 / count(*)', 'closed_pct')} FROM ({_RUN}) z",
    "before_r", "cause", "scored", "diagnosis_answers", "plan_answers", "execution_answers", "verdicts", **_RUN_CTES))
def run_closure(spark, d):
    table, _ = _run(spark, d)
    return rounded(incident_run.summarize(table)[0])


@query("trained_run")
def trained_run(spark, d):
    """The run with a forest trained at its defaults, so the detections are its own."""
    run = incident_run.run_incidents(
        views.kpi_view(spark, d), _answers(spark, d), lookback_seconds=SIX_HOURS,
        ahead_seconds=SIX_HOURS,
    )
    return run.cases.select("case_id", "cell_name", "rca.primary_cause", "detection.max_probability", "closed")


@query("memory_recall", check_sql(
    "SELECT c.event_id AS case_id, count(*) AS n_similar FROM (SELECT event_id, ts, cell_name FROM kpi WHERE is_anomaly) c "
    "JOIN ok ON true GROUP BY c.event_id", "kpi", "learning_answers",
    ok="SELECT 1 AS one FROM learning_answers WHERE case_id % 4 = 0 ORDER BY case_id LIMIT 3"))
def memory_recall(spark, d):
    """Every case recalls the three oldest matching learnings (all share the case's signals)."""
    learned = case_memory.learnings_from(views.view(spark, d, "learning_answers"))
    rows = views.kpi_view(spark, d).filter("is_anomaly").select(
        F.col("event_id").alias("case_id"),
        F.array(*[F.struct(F.lit(m).alias("metric")) for m in ("bler_dl", "cqi_dl")]).alias("fingerprint"),
        F.struct(F.lit("interference").alias("primary_cause")).alias("rca"),
    )
    similar, _ = case_memory.recall(rows, learned)
    return similar.groupBy("case_id").agg(F.count(F.lit(1)).alias("n_similar"))


_MEMORY = (
    "SELECT case_id, learning_id, citation, confidence, score, row_number() OVER (PARTITION BY case_id ORDER BY score DESC, "
    "learning_id) AS rank FROM (SELECT c.case_id, l.learning_id, l.citation, l.confidence, "
    "(len(list_intersect(c.signals, l.signature)) / greatest(len(list_distinct(c.signals)), 1)) * 6e-1 "
    "+ (CASE WHEN l.cause_pattern = c.cause THEN 1e0 ELSE 3e-1 END) * 4e-1 AS score FROM cs c CROSS JOIN kept l) x "
    "WHERE score > 3e-1 QUALIFY rank <= 3"
)
_KEPT = (
    "SELECT case_id AS learning_id, coalesce(from_json(json_extract(j, '$.pattern.fingerprint_signature'), '[\"VARCHAR\"]'), []) "
    f"AS signature, coalesce({_get('$.pattern.cause_pattern')}, '') AS cause_pattern, {_get('$.citation')} AS citation, "
    f"try_cast({_get('$.learning.confidence')} AS double) AS confidence FROM ans WHERE {_OBJ} AND "
    + " AND ".join(f"{_type(f'$.{k}')} <> 'absent'" for k in fv.REQUIRED_LEARNING_KEYS)
)


@query("case_memory_flow", check_sql(
    f"SELECT case_id, rank, learning_id, {r('score')}, coalesce(CASE WHEN coalesce(citation, '') <> '' AND confidence > 0.5 THEN "
    "citation || ' (confidence: ' || printf('%.1f', confidence * 100) || '%)' END, 'none') AS recommendation FROM mem",
    "cause", "long_dev", "learning_answers", ans=answers_sql("learning_answers"), kept=_KEPT, cs=_CASE_SIGNALS, mem=_MEMORY))
def case_memory_flow(spark, d):
    """Diagnosed cases are remembered, learnings kept from the answers, and every case recalls what helped before."""
    learned = case_memory.learnings_from(views.view(spark, d, "learning_answers"))
    found = diagnose.diagnose(anomalies_profiled(spark, d)).select(F.col("event_id").alias("case_id"), "cell_name", "ts", "fingerprint", "rca")
    history = stage_path(spark, "memory")
    for _ in range(2):  # tried again, it adds nothing
        case_memory.remember(found, history, ["cell_name", "ts", "case_id"], run="all cases")
    moved = F.filter("fingerprint", lambda s: F.abs(s["delta_pct"]) > 10)
    similar, recommended = case_memory.recall(spark.read.parquet(history).withColumn("fingerprint", moved), learned)
    out = similar.join(recommended, ["case_id", "rank"], "left")
    return rounded(out.select("case_id", "rank", "learning_id", "score", F.coalesce("recommendation", F.lit("none")).alias("recommendation")))


def _audit_sql() -> str:
    """All reports of the audit in one long table, from the check SQL of each."""
    parts = [
        ("score", "quality_score", "'all'", ["total_rows", "n_duplicates", "quality_score"]),
        ("missing", "missing_overview", "'all'", ["total_missing", "missing_pct", "rows_with_missing", "complete_rows"]),
        ("missing_columns", "missing_by_column", '"column"', ["missing_count", "missing_pct"]),
        ("types", "dtype_report", "\"column\" || ':' || data_type", ["total_rows", "total_columns"]),
        ("outliers", "outlier_report", '"column"', ["iqr_outliers", "z_score_outliers", "total_outliers"]),
        ("summary", "clean_summary", "'all'", ["clean_rows", "rows_removed"]),
    ]
    rows = [
        f"SELECT '{report}' AS report, {item} AS item, '{c}' AS figure, round({c}::double, 6) AS value FROM ({CHECKS[name]}) q"
        for report, name, item, figures in parts for c in figures
    ]
    rows.append(f"SELECT 'cleaned' AS report, 'all' AS item, 'rows' AS figure, count(*)::double AS value FROM ({CHECKS['clean']}) q")
    return " UNION ALL ".join(rows)


@query("audit_whole", _audit_sql())
def audit_whole(spark, d):
    """Every figure of every report of the audit."""
    found = quality_audit.audit(views.view(spark, d, "kpi_dirty"), columns=fv.RAW_KPIS)
    typed = found.types.withColumn("column", F.concat("column", F.lit(":"), "data_type"))

    def long(report: str, df, figures: list[str], item: str | None = None):
        cells = [F.struct(F.lit(c).alias("figure"), F.round(F.col(c).cast("double"), 6).alias("value")) for c in figures]
        name = F.col(item) if item else F.lit("all")
        return df.select(F.lit(report).alias("report"), name.alias("item"), F.inline(F.array(*cells)))

    parts = [
        long("score", found.score, ["total_rows", "n_duplicates", "quality_score"]),
        long("missing", found.missing, ["total_missing", "missing_pct", "rows_with_missing", "complete_rows"]),
        long("missing_columns", found.missing_columns, ["missing_count", "missing_pct"], "column"),
        long("types", typed, ["total_rows", "total_columns"], "column"),
        long("outliers", found.outliers, ["iqr_outliers", "z_score_outliers", "total_outliers"], "column"),
        long("summary", found.summary, ["clean_rows", "rows_removed"]),
        long("cleaned", found.cleaned.agg(F.count(F.lit(1)).alias("rows")), ["rows"]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("audit_summary", check_sql(
    "SELECT (SELECT count(*) FROM kpi_dirty) AS total_rows, count(*) AS clean_rows FROM "
    "(SELECT DISTINCT * FROM kpi_dirty WHERE event_id % 31 <> 0) x", "kpi_dirty"))
def audit_summary(spark, d):
    report = quality_audit.audit(views.view(spark, d, "kpi_dirty"), columns=fv.RAW_KPIS)
    return report.summary.select("total_rows", "clean_rows")
