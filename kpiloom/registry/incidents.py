"""Incidents, batches, fingerprints, diagnosis, detection and verification."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.operators import cases, detect, diagnose, features, fingerprint, quality, report, sliding, verify
from kpiloom.registry.base import check_sql, query, r, rounded, rs
from kpiloom.registry.inputs import SIX_HOURS, anomalies_profiled, baselines, batches, incidents, kpi_r
from kpiloom.session import stage, stage_path
from kpiloom.sources import sinks, views

# ---- incidents and their samples -----------------------------------------------------------


@query("incident_slots", check_sql("SELECT event_id, cell_name, ts, slot FROM incidents", "incidents"))
def incident_slots(spark, d):
    return incidents(spark, d).select("event_id", "cell_name", "ts", "slot")


@query("lookback_5min", check_sql(
    "SELECT c.event_id AS case_id, s.event_id, s.ts FROM incidents c JOIN kpi_r s ON s.cell_name = c.cell_name "
    "AND s.ts BETWEEN c.ts - INTERVAL 5 MINUTE AND c.ts", "incidents"))
def lookback_5min(spark, d):
    return batches(spark, d, 300).select("case_id", "event_id", "ts")


@query("lookback_6h", check_sql("SELECT case_id, event_id, ts FROM back", "back"))
def lookback_6h(spark, d):
    return batches(spark, d).select("case_id", "event_id", "ts")


@query("before_rows", check_sql(f"SELECT case_id, event_id, {rs(fv.KPIS)} FROM before_r", "before_r"))
def before_rows(spark, d):
    found = cases.as_cases(incidents(spark, d))
    return rounded(sliding.last_in_window(found, kpi_r(spark, d), SIX_HOURS, 0, ["event_id", *fv.KPIS]).drop("cell_name", "t0"))


def _after(spark, d):
    found = cases.as_cases(incidents(spark, d))
    return cases.after_row(found, kpi_r(spark, d), SIX_HOURS, columns=["event_id", *fv.KPIS])


@query("after_rows", check_sql(f"SELECT case_id, event_id, {rs(fv.KPIS)} FROM after_r", "after_r"))
def after_rows(spark, d):
    return rounded(_after(spark, d).select("case_id", "event_id", *fv.KPIS))


@query("after_rows_15min", check_sql(
    "SELECT case_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM "
    "(SELECT c.event_id AS case_id, s.event_id, s.ts FROM incidents c JOIN kpi_r s ON s.cell_name = c.cell_name "
    "AND s.ts BETWEEN c.ts AND c.ts + INTERVAL 15 MINUTE) x GROUP BY case_id", "incidents"))
def after_rows_15min(spark, d):
    found = cases.as_cases(incidents(spark, d))
    return cases.after_row(found, kpi_r(spark, d), columns=["event_id", "ts"]).select("case_id", "event_id", "ts")


_MISS = " + ".join(f"CAST({c} IS NULL AS int)" for c in fv.KPIS)


@query("batch_quality", check_sql(
    f"SELECT case_id, n_rows, {r('m * 1e2', 'missing_pct')}, '{fv.ISSUE_BASIC_CHECK}' AS issues, "
    "CASE WHEN m < 0.1 THEN 'low' WHEN m < 0.3 THEN 'medium' ELSE 'high' END AS severity FROM "
    f"(SELECT case_id, count(*) AS n_rows, avg(({_MISS}) / {float(len(fv.KPIS))!r}::double) AS m FROM back "
    "GROUP BY case_id) x", "back"))
def batch_quality(spark, d):
    return rounded(quality.window_quality(cases.as_cases(incidents(spark, d)), kpi_r(spark, d), fv.KPIS, SIX_HOURS))


_SHOWN = fv.KPIS[:5]


@query("batch_stats", check_sql(
    "SELECT case_id, count(*) AS total_rows, " + ", ".join(
        f"{r(f'avg({c})', f'{c}_mean')}, (count(*) - count({c})) AS {c}_missing, "
        f"{r(f'(count(*) - count({c})) * 1e2 / count(*)', f'{c}_missing_pct')}" for c in _SHOWN)
    + f", '{','.join(fv.KPIS[:10])}' AS columns FROM back GROUP BY case_id", "back"))
def batch_stats(spark, d):
    stats = quality.window_stats(cases.as_cases(incidents(spark, d)), kpi_r(spark, d), fv.KPIS, SIX_HOURS)
    return rounded(stats.withColumn("columns", F.array_join("columns", ",")))


# ---- fingerprint and diagnosis -------------------------------------------------------------

@query("deviations", check_sql(
    f"SELECT event_id, metric, {r('value')}, {r('baseline')}, {r('delta_pct')}, "
    "CASE WHEN delta_pct >= 0 THEN 'up' ELSE 'down' END AS dir FROM long_dev WHERE is_anomaly", "long_dev"))
def deviations(spark, d):
    rows = features.anomalies(kpi_r(spark, d))
    return rounded(fingerprint.deviations(rows, baselines(spark, d), ["event_id"]).drop("ord"))


def _ranked_signals(df, signals="fingerprint"):
    return df.select("event_id", F.posexplode(signals).alias("pos", "s")).select(
        "event_id", (F.col("pos") + 1).alias("pos"), "s.metric", "s.value", "s.baseline", "s.delta_pct", "s.dir",
        "s.attr_value", "s.attr_dir", "s.type",
    )


_TOP = (
    "SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY abs(delta_pct) DESC, ord) AS pos, "
    "metric, value, baseline, delta_pct FROM long_dev WHERE is_anomaly"
)


@query("top_deviations", check_sql(
    f"SELECT event_id, pos, metric, {r('value')}, {r('baseline')}, {r('delta_pct')}, "
    "CASE WHEN delta_pct >= 0 THEN 'up' ELSE 'down' END AS dir FROM top WHERE pos <= 3", "long_dev", top=_TOP))
def top_deviations(spark, d):
    rows = features.anomalies(kpi_r(spark, d))
    profiled = fingerprint.deviation_array(rows, baselines(spark, d))
    top = profiled.withColumn("fingerprint", fingerprint.top_deviations(k=3))
    return rounded(_ranked_signals(top).drop("attr_value", "attr_dir", "type"))


# Stand-in attributions: any per-feature number of a row will do here.
_ATTR = {m: f"{m} * (event_id % {i + 2} - {i % 3}) * 1e-3" for i, m in enumerate(fv.RAW_KPIS)}


@query("top_attributions", check_sql(
    f"SELECT event_id, pos, metric, {r('v', 'attr_value')}, "
    "CASE WHEN v > 0 THEN 'positive' ELSE 'negative' END AS attr_dir, 'shap' AS type FROM "
    "(SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY abs(v) DESC, ord) AS pos FROM attr) x WHERE pos <= 5",
    "kpi", attr=" UNION ALL ".join(
        f"SELECT event_id, {i} AS ord, '{m}' AS metric, {e} AS v FROM kpi WHERE is_anomaly AND {m} IS NOT NULL"
        for i, (m, e) in enumerate(_ATTR.items()))))
def top_attributions(spark, d):
    rows = features.anomalies(kpi_r(spark, d))
    chosen = rows.withColumn("top", fingerprint.top_attributions({m: F.expr(e) for m, e in _ATTR.items()}))
    return rounded(_ranked_signals(chosen, "top").select("event_id", "pos", "metric", "attr_value", "attr_dir", "type"))


@query("fingerprint", check_sql(
    "SELECT event_id, string_agg(metric, ',' ORDER BY pos) AS signals FROM top GROUP BY event_id", "long_dev", top=_TOP))
def fingerprint_signals(spark, d):
    names = F.array_join(F.transform("fingerprint", lambda s: s["metric"]), ",")
    return anomalies_profiled(spark, d).select("event_id", names.alias("signals")).filter("signals <> ''")


@query("diagnose", check_sql(
    f"SELECT event_id, cell_name, primary_cause, {r('confidence')} FROM conf", "conf"))
def diagnose_rows(spark, d):
    found = diagnose.diagnose(anomalies_profiled(spark, d))
    return rounded(found.select("event_id", "cell_name", "rca.primary_cause", "rca.confidence"))


def _line(label: str, value: str) -> str:
    return f"'{label} ' || printf('%.1f', {value}) || '%'"


@query("evidence", check_sql(
    "SELECT event_id, CASE primary_cause "
    f"WHEN 'interference' THEN {_line('BLER up', 'bler')} || '|' || {_line('CQI down', 'cqi')} || '|PRB not high' "
    f"WHEN 'high_load' THEN {_line('DL PRB up', 'prb')} || '|' || {_line('Throughput down', 'thp')} "
    f"WHEN 'connection_failure' THEN {_line('RRC success rate down', 'rrc')} "
    f"WHEN 'power_anomaly' THEN {_line('Energy efficiency down', 'eff')} "
    f"WHEN 'low_throughput' THEN {_line('Throughput down', 'thp')} || '|Load not high' ELSE '' END AS evidence "
    "FROM cause", "cause"))
def evidence(spark, d):
    found = diagnose.diagnose(anomalies_profiled(spark, d))
    return found.select("event_id", F.array_join("rca.evidence", "|").alias("evidence"))


@query("cause_breakdown", check_sql(
    "SELECT primary_cause, count(*) AS n_cases FROM cause GROUP BY primary_cause", "cause"))
def cause_breakdown(spark, d):
    found = diagnose.diagnose_wide(features.anomalies(kpi_r(spark, d)), baselines(spark, d))
    return report.cause_breakdown(found, first_by=["event_id"])


@query("cause_by_cell", check_sql(
    "SELECT cell_name, primary_cause, count(*) AS n_cases FROM cause GROUP BY ALL", "cause"))
def cause_by_cell(spark, d):
    found = diagnose.diagnose_wide(features.anomalies(kpi_r(spark, d)), baselines(spark, d))
    return found.groupBy("cell_name", "primary_cause").agg(F.count(F.lit(1)).alias("n_cases"))


@query("case_history_sink", check_sql(
    "SELECT event_id, cell_name, ts::varchar AS time, primary_cause FROM conf", "conf"))
def case_history_sink(spark, d):
    path = stage_path(spark, "cases-json")
    found = diagnose.diagnose(anomalies_profiled(spark, d))
    case = found.select("event_id", "cell_name", F.col("ts").cast("string").alias("time"), "fingerprint", "rca")
    sinks.write_cases(case, path)
    stored = spark.read.schema(case.schema).json(path)
    return stored.select("event_id", "cell_name", "time", "rca.primary_cause")


# ---- detection -----------------------------------------------------------------------------

def _scored(spark, d):
    return features.add_ratio(views.view(spark, d, "scored"))


def _detections(spark, d):
    return detect.detect_windows(cases.as_cases(incidents(spark, d)), _scored(spark, d), SIX_HOURS)


def _first_hits(spark, d):
    """The part of each case's scored batch that its first three predicted anomalies can be in."""
    hits = _scored(spark, d).filter("prediction = 1")
    columns = ["ts", "event_id", "prediction", "probability", *fv.SAMPLE_METRICS]
    return sliding.first_in_window(cases.as_cases(incidents(spark, d)), hits, SIX_HOURS, 0, 3, columns)


_SB = (
    "SELECT c.event_id AS case_id, s.*, s.rrc_succ / nullif(s.rrc_att, 0) AS rrc_rate FROM incidents c JOIN scored s "
    "ON s.cell_name = c.cell_name AND s.ts BETWEEN c.ts - INTERVAL 6 HOUR AND c.ts"
)


@query("detect_batches", check_sql(
    "SELECT case_id, true AS is_anomaly_any, sum(prediction)::bigint AS anomaly_count, "
    f"{r('max(probability)', 'max_probability')}, count(*) AS n_samples FROM sb GROUP BY case_id "
    "HAVING max(prediction) > 0", "incidents", "scored", sb=_SB))
def detect_batches(spark, d):
    return rounded(_detections(spark, d))


@query("anomaly_samples", check_sql(
    f"SELECT case_id, pos, {r('probability')}, {rs(fv.SAMPLE_METRICS)} FROM (SELECT *, row_number() OVER "
    "(PARTITION BY case_id ORDER BY ts, event_id) AS pos FROM sb WHERE prediction = 1) x WHERE pos <= 3",
    "incidents", "scored", sb=_SB))
def anomaly_samples(spark, d):
    return rounded(detect.anomaly_samples(_first_hits(spark, d)))


_CLASS = (
    "SELECT count_if(y AND p)::double AS tp, count_if(NOT y AND p)::double AS fp, count_if(y AND NOT p)::double AS fn, "
    "count_if(NOT y AND NOT p)::double AS tn FROM (SELECT is_anomaly AS y, prediction = 1 AS p FROM scored) z"
)
_PRF = (
    "SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, "
    "tn + fp AS s0, tp + fn AS s1, 2 * tn / (2 * tn + fn + fp) AS f0, 2 * tp / (2 * tp + fp + fn) AS f1 FROM m"
)


def _report_sql(f: str) -> str:
    return (
        f"SELECT '0' AS class, {r('p0', 'precision')}, {r('r0', 'recall')}, {r('f0', f)}, s0::bigint AS support FROM q "
        f"UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1::bigint FROM q "
        "UNION ALL SELECT 'accuracy', NULL, NULL, round((tp + tn) / (s0 + s1), 6), (s0 + s1)::bigint FROM q "
        "UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), "
        "(s0 + s1)::bigint FROM q UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), "
        "round((r0 * s0 + r1 * s1) / (s0 + s1), 6), round((f0 * s0 + f1 * s1) / (s0 + s1), 6), (s0 + s1)::bigint FROM q"
    )


@query("classification_report", check_sql(_report_sql("f1"), "scored", m=_CLASS, q=_PRF))
def classification_report(spark, d):
    return rounded(detect.classification_report(_scored(spark, d)))


_AUC = (
    "SELECT (sum(rk) FILTER (WHERE is_anomaly) - p * (p + 1) / 2) / (p * n) AS auc, p, n FROM (SELECT is_anomaly, "
    "rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2 AS rk, "
    "(count_if(is_anomaly) OVER ())::double AS p, (count_if(NOT is_anomaly) OVER ())::double AS n FROM scored) x "
    "GROUP BY p, n"
)


@query("roc_auc", check_sql(f"SELECT {r('auc', 'roc_auc')}, (p + n)::bigint AS n_rows FROM ({_AUC}) y", "scored"))
def roc_auc(spark, d):
    return rounded(detect.roc_auc(_scored(spark, d)))


@query("evaluate", check_sql(
    _report_sql("score") + f" UNION ALL SELECT 'roc_auc', NULL, NULL, round(auc, 6), (p + n)::bigint FROM ({_AUC}) y",
    "scored", m=_CLASS, q=_PRF))
def evaluate(spark, d):
    return rounded(detect.evaluate(_scored(spark, d)))


@query("stratified_split", check_sql(
    "SELECT event_id, is_anomaly, row_number() OVER (PARTITION BY is_anomaly "
    "ORDER BY md5(event_id::varchar || '-42'), event_id) <= floor(count(*) OVER (PARTITION BY is_anomaly) * 0.25e0 "
    "+ 0.5e0) AS is_test FROM kpi", "kpi"))
def stratified_split(spark, d):
    return detect.stratified_split(kpi_r(spark, d)).select("event_id", "is_anomaly", "is_test")


_MODELS: dict = {}


def _trained(spark, d):
    """The detector with its defaults (200 trees of depth 30), trained once per application and directory."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _MODELS:
        rows = features.add_deviation_pct(kpi_r(spark, d), baselines(spark, d))
        used = features.model_features(rows)
        split = stage(detect.stratified_split(rows), "split")
        _MODELS.clear()
        _MODELS[at] = detect.train_detector(split.filter("NOT is_test"), used), used, split
    return _MODELS[at]


@query("detector_scores")
def detector_scores(spark, d):
    model, used, split = _trained(spark, d)
    return detect.score(model, split.filter("is_test"), used).select("event_id", "is_anomaly", "probability", "prediction")


@query("detector_metrics")
def detector_metrics(spark, d):
    model, used, split = _trained(spark, d)
    scored = detect.score(model, split.filter("is_test"), used).select("is_anomaly", "probability", "prediction")
    return detect.evaluate(stage(scored, "scored"))  # read twice, and filtered by its scores


@query("model_round_trip", check_sql(
    "SELECT sum(n)::bigint AS n_rows, 0::bigint AS n_changed FROM (SELECT floor(count(*) * 0.25e0 + 0.5e0) AS n FROM kpi "
    "GROUP BY is_anomaly) x", "kpi"))
def model_round_trip(spark, d):
    """Rows whose score changes when the model is saved and loaded; one count, always 0."""
    model, used, split = _trained(spark, d)
    path = stage_path(spark, "detector")
    sinks.save_model(model, path)
    kept = detect.score(model, split.filter("is_test"), used).select("event_id", F.col("probability").alias("p"))
    again = detect.score(sinks.load_model(path), split.filter("is_test"), used).select("event_id", "probability")
    return kept.join(again, "event_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("p") != F.col("probability")).alias("n_changed")
    )


@query("occlusion_contributions")
def occlusion_contributions(spark, d):
    model, used, split = _trained(spark, d)
    rows = features.anomalies(split).withColumn("case_id", F.col("event_id"))
    return detect.occlusion_contributions(model, rows, used, baselines(spark, d))


@query("shapley_contributions")
def shapley_contributions(spark, d):
    model, used, split = _trained(spark, d)
    rows = features.anomalies(split).withColumn("case_id", F.col("event_id"))
    return detect.shapley_contributions(model, rows, used, baselines(spark, d))


@query("shapley_sums", check_sql(
    "SELECT count(*) AS n_cases, count(*) * 24 AS n_values, 0::bigint AS n_off FROM kpi WHERE is_anomaly", "kpi"))
def shapley_sums(spark, d):
    """Cases whose contributions do not add up to P(row) - P(normal); one count, always 0."""
    model, used, split = _trained(spark, d)
    rows = features.anomalies(split).withColumn("case_id", F.col("event_id"))
    base = baselines(spark, d)
    sums = detect.shapley_contributions(model, rows, used, base).groupBy("case_id").agg(
        F.sum("contribution").alias("total"), F.count(F.lit(1)).alias("n"))
    looked_up = features.with_baseline(rows.select("case_id", "cell_name"), base, [f for f in used if f in base.columns])
    normal = looked_up.select("case_id", *[
        (F.coalesce(f"base_{f}", F.lit(0.0)) if f in base.columns else F.lit(0.0)).alias(f) for f in used])
    # by key, as the contributions are: rows may share one
    own = detect.score(model, rows, used).groupBy("case_id").agg(F.sum("probability").alias("p"), F.count(F.lit(1)).alias("rows"))
    none = detect.score(model, normal, used).groupBy("case_id").agg(F.sum("probability").alias("p0"))
    off = F.abs(F.col("total") - (F.col("p") - F.col("p0"))) > 1e-6
    return sums.join(own, "case_id").join(none, "case_id").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_cases"), F.sum("n").alias("n_values"), F.count_if(off).alias("n_off"))


# ---- verification --------------------------------------------------------------------------

_CTX = " UNION ALL ".join(
    f"SELECT p.case_id, p.cell_name, '{m}' AS metric, p.{m} AS \"before\", a.{m} AS \"after\", b.{m} AS baseline FROM before_r p "
    "JOIN after_r a ON a.case_id = p.case_id LEFT JOIN base b ON b.cell_name = p.cell_name"
    for m in fv.VERIFY_METRICS
)


def context(spark, d):
    found = cases.as_cases(incidents(spark, d))
    windows = {"before": (SIX_HOURS, 0), "after": (0, SIX_HOURS)}
    metrics = [m for m in fv.VERIFY_METRICS if m in fv.KPIS]
    both = sliding.last_in_windows(found, kpi_r(spark, d), windows, metrics)
    return verify.window_context(both, baselines(spark, d), metrics)


@query("verification_context", check_sql(
    f"SELECT case_id, cell_name, metric, {r('\"before\"')}, {r('\"after\"')}, {r('baseline')} FROM ctx",
    "before_r", "after_r", "base", ctx=_CTX))
def verification_context(spark, d):
    return rounded(context(spark, d))


@query("kpi_improvements", check_sql(
    f"SELECT case_id, metric, {r('(\"after\" - \"before\") * 100 / nullif(\"before\", 0)', 'change_pct')}, "
    "CASE WHEN metric = 'prb_dl' OR \"after\" IS NULL OR \"before\" IS NULL THEN 'open' "
    "WHEN CASE WHEN metric = 'bler_dl' THEN \"after\" < \"before\" ELSE \"after\" > \"before\" END THEN 'yes' "
    "ELSE 'no' END AS improved FROM ctx", "before_r", "after_r", "base", ctx=_CTX))
def kpi_improvements(spark, d):
    out = verify.kpi_improvements(context(spark, d))
    shown = F.when(F.col("improved").isNull(), "open").when(F.col("improved"), "yes").otherwise("no")
    return rounded(out.select("case_id", "metric", "change_pct", shown.alias("improved")))


# ---- display text --------------------------------------------------------------------------

@query("display_text", check_sql(
    "SELECT event_id, printf('%.1f', d_thp_dl) AS one_decimal, printf('%.1f', d_thp_dl * 100) || '%' AS percent, "
    "ts::varchar AS time FROM dev WHERE d_thp_dl IS NOT NULL AND is_anomaly", "dev"))
def display_text(spark, d):
    signals = fingerprint.deviations(features.anomalies(kpi_r(spark, d)), baselines(spark, d), ["event_id", "ts"])
    return signals.filter("metric = 'thp_dl'").select(
        "event_id",
        E.one_decimal("delta_pct").alias("one_decimal"),
        E.percent_text("delta_pct").alias("percent"),
        F.col("ts").cast("string").alias("time"),
    )


@query("context_prompt", check_sql(
    "SELECT event_id, 'Task: explain' || chr(10) || chr(10) || 'Context:' || chr(10) || '- cell: ' || cell_name "
    "|| chr(10) || '- event: ' || event_id::varchar || chr(10) || chr(10) || 'Examples:' || chr(10) || '1. ' || cell_name "
    "|| chr(10) || '2. other' || chr(10) AS prompt FROM kpi WHERE is_anomaly", "kpi"))
def context_prompt(spark, d):
    about = F.create_map(F.lit("cell"), F.col("cell_name"), F.lit("event"), F.col("event_id").cast("string"))
    prompt = E.context_prompt(F.lit("explain"), about, F.array(F.col("cell_name"), F.lit("other")))
    return features.anomalies(views.kpi_view(spark, d)).select("event_id", prompt.alias("prompt"))
