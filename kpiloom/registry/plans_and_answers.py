"""Plans, checked answers, request payloads, case memory and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.functions import json_text as J
from kpiloom.operators import cases, detect, diagnose, features, fingerprint, knowledge, payloads, planning
from kpiloom.operators import quality, report, responses, sliding, verify
from kpiloom.registry.base import answers_sql, body_sql, check_sql, query, r, rounded
from kpiloom.registry.incidents import _SB, _TOP, _after, _detections, _first_hits
from kpiloom.registry.inputs import SIX_HOURS, anomalies_profiled, baselines, batches, incidents, kpi_r
from kpiloom.session import stage
from kpiloom.sources import views

# ---- plans ---------------------------------------------------------------------------------


def _proposals(spark, d):
    made = views.view(spark, d, "proposals")
    params = F.create_map(F.lit("cell"), F.col("p_cell"), F.lit("neighbor"), F.col("p_neighbor"))
    return made.withColumn("params", params)


def _allowed(spark):
    return planning.action_whitelist(spark)


@query("valid_actions", check_sql(
    "SELECT case_id, pos, action_id, reversible, risk FROM proposals JOIN whitelist USING (action_id)",
    "proposals", "whitelist"))
def valid_actions(spark, d):
    kept = planning.validate_actions(_proposals(spark, d), _allowed(spark))
    return kept.select("case_id", "pos", "action_id", "reversible", "risk")


@query("rejected_actions", check_sql(
    "SELECT case_id, pos, action_id FROM proposals ANTI JOIN whitelist USING (action_id)", "proposals", "whitelist"))
def rejected_actions(spark, d):
    return planning.rejected_actions(_proposals(spark, d), _allowed(spark)).select("case_id", "pos", "action_id")


@query("invalid_plans", check_sql(
    "SELECT event_id AS case_id, 'no valid actions proposed' AS error FROM kpi WHERE is_anomaly AND event_id NOT IN "
    "(SELECT case_id FROM proposals JOIN whitelist USING (action_id))", "proposals", "whitelist"))
def invalid_plans(spark, d):
    plans = features.anomalies(views.kpi_view(spark, d)).select(F.col("event_id").alias("case_id"))
    return planning.invalid_plans(plans, _proposals(spark, d), _allowed(spark))


@query("plan_risk_order", check_sql(
    "SELECT case_id, count(*) AS n_actions, bool_or(coalesce(rk < prev, false)) AS risk_order_broken, "
    "count(*) > 3 AS too_many_actions FROM (SELECT case_id, rk, lag(rk) OVER (PARTITION BY case_id ORDER BY pos) AS prev "
    "FROM (SELECT case_id, pos, CASE risk WHEN 'low' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END AS rk FROM proposals "
    "JOIN whitelist USING (action_id)) x) y GROUP BY case_id", "proposals", "whitelist"))
def plan_risk_order(spark, d):
    return planning.plan_risk_order(_proposals(spark, d), _allowed(spark))


@query("blast_radius", check_sql(
    "SELECT case_id, count(DISTINCT c) AS n_cells, count(DISTINCT c) <= 3 AS blast_radius_ok FROM "
    "(SELECT case_id, p_cell AS c FROM proposals UNION ALL SELECT case_id, nullif(p_neighbor, 'AUTO') FROM proposals) x "
    "GROUP BY case_id", "proposals"))
def blast_radius(spark, d):
    return planning.blast_radius(_proposals(spark, d))


def _get(path: str) -> str:
    return f"json_extract_string(j, '{path}')"


def _type(path: str) -> str:
    return f"coalesce(json_type(j, '{path}'), 'absent')"


# json_type without a path reads a whole document.
_OBJ = "(j IS NOT NULL AND json_type(j) = 'OBJECT')"
_WL = ", ".join(f"'{a[0]}'" for a in fv.ACTIONS)
_PLANS = (
    "SELECT case_id, j, (SELECT string_agg(id || ':' || CASE WHEN id = 'check_backhaul' THEN 'false' ELSE 'true' END, ',' "
    "ORDER BY i) FROM (SELECT i, json_extract_string(j, '$.actions[' || i || '].id') AS id FROM "
    f"(SELECT unnest(range(coalesce(json_array_length(j, '$.actions'), 0)::bigint)) AS i) n) a WHERE id IN ({_WL})) AS actions "
    "FROM ans"
)


@query("assemble_plans", check_sql(
    f"SELECT case_id, CASE WHEN NOT {_OBJ} THEN 'not a JSON object' WHEN actions IS NULL THEN 'no valid actions proposed' "
    "ELSE 'ok' END AS state, coalesce(actions, '') AS actions, "
    f"CASE WHEN {_type('$.prechecks')} = 'absent' THEN 'no critical alarms|within change window' "
    "ELSE array_to_string(from_json(json_extract(j, '$.prechecks'), '[\"VARCHAR\"]'), '|') END AS prechecks, "
    f"CASE WHEN {_type('$.postchecks')} = 'absent' THEN '' "
    "ELSE array_to_string(from_json(json_extract(j, '$.postchecks'), '[\"VARCHAR\"]'), '|') END AS postchecks, "
    f"CASE WHEN {_type('$.sla')} = 'absent' THEN 15e0 ELSE {_get('$.sla.verify_minutes')}::double END AS verify_minutes "
    "FROM p", "plan_answers", ans=answers_sql("plan_answers"), p=_PLANS))
def assemble_plans(spark, d):
    plans = planning.assemble_plans(views.view(spark, d, "plan_answers"))
    listed = F.transform(
        "plan.actions", lambda a: F.concat(a["id"], F.lit(":"), a["reversible"].cast("string"))
    )
    return plans.select(
        "case_id",
        F.coalesce("error", F.lit("ok")).alias("state"),
        F.array_join(listed, ",").alias("actions"),
        F.array_join("plan.prechecks", "|").alias("prechecks"),
        F.array_join("plan.postchecks", "|").alias("postchecks"),
        F.col("plan.sla.verify_minutes").alias("verify_minutes"),
    )


@query("plan_actions", check_sql(
    "SELECT case_id, i + 1 AS pos, json_extract_string(j, '$.actions[' || i || '].id') AS action_id, "
    "json_extract_string(j, '$.actions[' || i || '].params.cell') AS p_cell FROM "
    "(SELECT case_id, j, unnest(range(json_array_length(j, '$.actions')::bigint)) AS i FROM ans WHERE j IS NOT NULL) x",
    "plan_answers", ans=answers_sql("plan_answers")))
def plan_actions(spark, d):
    found = planning.explode_actions(views.view(spark, d, "plan_answers"))
    return found.select("case_id", "pos", "action_id", F.try_element_at("params", F.lit("cell")).alias("p_cell"))


# ---- answers -------------------------------------------------------------------------------

@query("extract_json", check_sql(
    " UNION ALL ".join(
        f"SELECT case_id, '{v}' AS source, '{m}' AS mode, {body_sql('text', m)} AS body FROM {v}"
        for v, m in (("verdicts", "object"), ("quality_answers", "any_fence"), ("signal_answers", "array"),
                     ("verdicts", "split"))), "verdicts", "quality_answers", "signal_answers"))
def extract_json(spark, d):
    parts = [("verdicts", "object"), ("quality_answers", "any_fence"), ("signal_answers", "array"), ("verdicts", "split")]
    out = None
    for source, mode in parts:
        part = views.view(spark, d, source).select(
            "case_id", F.lit(source).alias("source"), F.lit(mode).alias("mode"),
            J.extract_json("text", mode).alias("body"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query("quality_answers", check_sql(
    f"SELECT case_id, {_OBJ} AS valid, CASE WHEN NOT {_OBJ} THEN -1 WHEN {_type('$.quality')} = 'absent' THEN n_rows "
    f"ELSE {_get('$.quality.rows')}::bigint END AS n_rows, CASE WHEN NOT {_OBJ} THEN -1e0 "
    f"WHEN {_type('$.quality')} = 'absent' THEN 0e0 ELSE {_get('$.quality.missing_pct')}::double END AS missing_pct, "
    f"CASE WHEN NOT {_OBJ} THEN 'rule' WHEN {_type('$.quality')} = 'absent' THEN 'unknown' "
    f"ELSE {_get('$.quality.severity')} END AS severity, CASE WHEN NOT {_OBJ} THEN '' "
    f"WHEN {_type('$.quality')} = 'absent' THEN '{fv.ISSUE_BAD_RESPONSE}' "
    "ELSE array_to_string(from_json(json_extract(j, '$.quality.issues'), '[\"VARCHAR\"]'), '|') END AS issues FROM ans",
    "quality_answers", ans=answers_sql("quality_answers", "any_fence")))
def quality_answers(spark, d):
    out = responses.quality_response(views.view(spark, d, "quality_answers"))
    return out.select(
        "case_id", "valid",
        F.coalesce("quality.n_rows", F.lit(-1)).alias("n_rows"),
        F.coalesce("quality.missing_pct", F.lit(-1.0)).alias("missing_pct"),
        F.coalesce("quality.severity", F.lit("rule")).alias("severity"),
        F.coalesce(F.array_join("quality.issues", "|"), F.lit("")).alias("issues"),
    )


@query("insight_answers", check_sql(
    f"SELECT case_id, CASE WHEN {_OBJ} THEN 'success' ELSE 'error' END AS status, CASE WHEN {_OBJ} THEN "
    f"{_get('$.severity')} END AS severity, CASE WHEN {_OBJ} THEN {_get('$.recommendation')} END AS recommendation "
    "FROM ans", "insight_answers", ans=answers_sql("insight_answers")))
def insight_answers(spark, d):
    out = responses.insight_response(views.view(spark, d, "insight_answers"))
    return out.select("case_id", "status", "severity", "recommendation")


_SIGNALS = (
    "SELECT case_id, (SELECT string_agg(m || '=' || v, ',' ORDER BY i) FROM (SELECT i, "
    "json_extract_string(j, '$[' || i || '].metric') AS m, printf('%.1f', "
    "try_cast(json_extract_string(j, '$[' || i || '].value') AS double)) AS v, "
    + " AND ".join(f"json_type(j, '$[' || i || '].{k}') IS NOT NULL" for k in fv.REQUIRED_SIGNAL_KEYS)
    + " AS full_item FROM (SELECT unnest(range(least(8, coalesce(json_array_length(j), 0))::bigint)) AS i) n) a "
    "WHERE full_item) AS signals, "
    "CASE WHEN j IS NULL THEN true ELSE (SELECT coalesce(bool_or(try_cast(json_extract_string(j, '$[' || i || '].value') "
    "AS double) IS NULL), false) FROM (SELECT unnest(range(coalesce(json_array_length(j), 0)::bigint)) AS i) n "
    "WHERE json_type(j, '$[' || i || '].value') IS NOT NULL) END AS spoiled FROM ans"
)


@query("signal_answers", check_sql(
    "SELECT case_id, signals IS NOT NULL AND NOT spoiled AS valid, "
    "CASE WHEN spoiled THEN '' ELSE coalesce(signals, '') END AS signals FROM sig",
    "signal_answers", ans=answers_sql("signal_answers", "array"), sig=_SIGNALS))
def signal_answers(spark, d):
    out = responses.signal_response(views.view(spark, d, "signal_answers"))
    listed = F.transform("signals", lambda s: F.concat(s["metric"], F.lit("="), E.one_decimal(s["value"])))
    return out.select("case_id", "valid", F.coalesce(F.array_join(listed, ","), F.lit("")).alias("signals"))


_CAUSES = ", ".join(f"'{c}'" for c in fv.CAUSE_CONFIDENCE)
_DIAG = (
    f"SELECT case_id, {_OBJ} AND ({_type('$.confidence')} = 'absent' OR try_cast({_get('$.confidence')} AS double) "
    f"IS NOT NULL) AS valid, CASE WHEN {_get('$.primary_cause')} IN ({_CAUSES}) THEN {_get('$.primary_cause')} "
    f"ELSE 'inconclusive' END AS primary_cause, CASE WHEN {_type('$.confidence')} = 'absent' THEN 5e-1 "
    f"ELSE try_cast({_get('$.confidence')} AS double) END AS confidence, "
    f"CASE {_type('$.evidence')} WHEN 'absent' THEN '' WHEN 'NULL' THEN NULL "
    "ELSE array_to_string(from_json(json_extract(j, '$.evidence'), '[\"VARCHAR\"]'), '|') END AS evidence, "
    f"CASE {_type('$.secondary')} WHEN 'NULL' THEN -1 ELSE coalesce(json_array_length(j, '$.secondary'), 0) END::int "
    "AS n_secondary FROM ans"
)


@query("diagnosis_answers", check_sql(
    "SELECT case_id, valid, CASE WHEN valid THEN primary_cause END AS primary_cause, CASE WHEN valid THEN confidence END "
    "AS confidence, CASE WHEN valid THEN evidence END AS evidence, CASE WHEN valid THEN n_secondary ELSE -1 END "
    "AS n_secondary FROM g", "diagnosis_answers", ans=answers_sql("diagnosis_answers"), g=_DIAG))
def diagnosis_answers(spark, d):
    out = responses.diagnosis_response(views.view(spark, d, "diagnosis_answers"))
    return out.select(
        "case_id", "valid", "rca.primary_cause", "rca.confidence",
        F.array_join("rca.evidence", "|").alias("evidence"),
        F.coalesce(F.size("rca.secondary"), F.lit(-1)).alias("n_secondary"),
    )


@query("diagnosis_or_rule", check_sql(
    f"SELECT c.event_id AS case_id, CASE WHEN g.valid THEN 'answer' ELSE 'rule' END AS source, "
    "CASE WHEN g.valid THEN g.primary_cause ELSE c.primary_cause END AS primary_cause, "
    f"{r('CASE WHEN g.valid THEN g.confidence ELSE c.confidence END', 'confidence')} "
    "FROM conf c LEFT JOIN g ON g.case_id = c.event_id", "conf", "diagnosis_answers",
    ans=answers_sql("diagnosis_answers"), g=_DIAG))
def diagnosis_or_rule(spark, d):
    rule = diagnose.diagnose(anomalies_profiled(spark, d)).select(F.col("event_id").alias("case_id"), "rca")
    answers = responses.diagnosis_response(views.view(spark, d, "diagnosis_answers"))
    out = responses.coalesce_response(rule, answers, "rca")
    return rounded(out.select("case_id", "source", "rca.primary_cause", "rca.confidence"))


@query("signals_or_rule", check_sql(
    "SELECT t.event_id AS case_id, CASE WHEN s.signals IS NOT NULL AND NOT s.spoiled THEN 'answer' ELSE 'rule' END "
    "AS source, CASE WHEN s.signals IS NOT NULL AND NOT s.spoiled THEN s.signals ELSE t.signals END AS signals FROM "
    "(SELECT k.event_id, coalesce(string_agg(metric || '=' || printf('%.1f', value), ',' ORDER BY pos), '') AS signals "
    "FROM (SELECT event_id FROM kpi WHERE is_anomaly) k LEFT JOIN top ON top.event_id = k.event_id GROUP BY k.event_id) t "
    "LEFT JOIN sig s ON s.case_id = t.event_id",
    "long_dev", "signal_answers", top=_TOP, ans=answers_sql("signal_answers", "array"), sig=_SIGNALS))
def signals_or_rule(spark, d):
    rows = features.anomalies(kpi_r(spark, d))
    profiled = fingerprint.deviation_array(rows, baselines(spark, d))
    top = F.transform(
        fingerprint.top_deviations("deviations"),
        lambda s: F.struct(*[s[k].alias(k) for k in fv.REQUIRED_SIGNAL_KEYS]),
    )
    rule = profiled.select(F.col("event_id").alias("case_id"), top.alias("signals"))
    answers = responses.signal_response(views.view(spark, d, "signal_answers"))
    out = responses.coalesce_response(rule, answers, "signals")
    listed = F.transform("signals", lambda s: F.concat(s["metric"], F.lit("="), E.one_decimal(s["value"])))
    return out.select("case_id", "source", F.array_join(listed, ",").alias("signals"))


@query("execution_answers", check_sql(
    "SELECT e.case_id, e.j IS NOT NULL AS valid, CASE WHEN e.j IS NULL THEN 'ok' ELSE "
    "coalesce(json_extract_string(e.j, '$.status'), 'none') END AS status, CASE WHEN e.j IS NULL THEN 'simulated' ELSE "
    "coalesce(json_extract_string(e.j, '$.mode'), 'none') END AS mode, CASE WHEN e.j IS NULL THEN "
    "len(string_split(p.actions, ',')) ELSE coalesce(json_array_length(e.j, '$.executed'), 0) END::int AS n_executed "
    "FROM e JOIN p USING (case_id) WHERE p.actions IS NOT NULL",
    "execution_answers", "plan_answers", ans=answers_sql("plan_answers"), p=_PLANS, e=answers_sql("execution_answers")))
def execution_answers(spark, d):
    plans = stage(planning.assemble_plans(views.view(spark, d, "plan_answers")), "plans").filter("error IS NULL")
    planned = plans.select("case_id", F.col("plan.actions").alias("actions"))
    answers = views.view(spark, d, "execution_answers").join(planned, "case_id")
    out = responses.execution_response(answers, "actions")
    return out.select(
        "case_id", "valid",
        F.coalesce("execution.status", F.lit("none")).alias("status"),
        F.coalesce("execution.mode", F.lit("none")).alias("mode"),
        F.size("execution.executed").alias("n_executed"),
    )


_VERDICT = (
    f"SELECT case_id, j, {_OBJ} AND {_type('$.closed')} <> 'absent' AND {_type('$.checks')} <> 'absent' AS valid, "
    f"CASE {_type('$.closed')} WHEN 'NULL' THEN false WHEN 'BOOLEAN' THEN {_get('$.closed')} = 'true' "
    f"ELSE {_get('$.closed')} <> '' END AS closed FROM ans"
)


@query("verdict_answers", check_sql(
    "SELECT case_id, valid, CASE WHEN NOT valid THEN 'error' WHEN closed THEN 'closed' ELSE 'open' END AS state, "
    f"CASE WHEN valid THEN coalesce({_get('$.residual_risk')}, 'unknown') ELSE 'none' END AS residual_risk, "
    "CASE WHEN j IS NULL THEN 'not JSON' WHEN NOT valid THEN 'missing required fields' ELSE 'none' END AS error FROM v",
    "verdicts", ans=answers_sql("verdicts"), v=_VERDICT))
def verdict_answers(spark, d):
    out = responses.verdict_response(views.view(spark, d, "verdicts"))
    state = F.when(~F.col("valid"), "error").when(F.col("closed"), "closed").otherwise("open")
    return out.select(
        "case_id", "valid", state.alias("state"),
        F.when(F.col("valid"), F.coalesce("residual_risk", F.lit("unknown"))).otherwise("none").alias("residual_risk"),
        F.coalesce("error", F.lit("none")).alias("error"),
    )


@query("closure_summary", check_sql(
    "SELECT count(*) AS total_cases, count_if(closed)::bigint AS closed_cases, "
    f"{r('count_if(closed) * 1e2 / count(*)', 'closed_pct')} FROM v WHERE valid",
    "verdicts", ans=answers_sql("verdicts"), v=_VERDICT))
def closure_summary(spark, d):
    verdicts = responses.verdict_response(views.view(spark, d, "verdicts")).filter("valid")
    return rounded(report.closure_summary(verdicts))


@query("learning_answers", check_sql(
    f"SELECT case_id, {_OBJ} AND " + " AND ".join(f"{_type(f'$.{k}')} <> 'absent'" for k in fv.REQUIRED_LEARNING_KEYS)
    + f" AS valid, CASE WHEN {_type('$.citation')} <> 'absent' THEN coalesce({_get('$.pattern.cause_pattern')}, 'none') "
    f"ELSE 'none' END AS cause_pattern, CASE WHEN {_type('$.citation')} <> 'absent' THEN "
    f"coalesce(try_cast({_get('$.learning.confidence')} AS double), 0) ELSE 0 END::double AS confidence FROM ans",
    "learning_answers", ans=answers_sql("learning_answers")))
def learning_answers(spark, d):
    out = responses.learning_response(views.view(spark, d, "learning_answers"))
    return out.select(
        "case_id", "valid",
        F.coalesce("cause_pattern", F.lit("none")).alias("cause_pattern"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
    )


# ---- request payloads ----------------------------------------------------------------------

def _from(column: str, path: str, as_type: str | None = None):
    value = F.get_json_object(column, path)
    return value.cast(as_type) if as_type else value


@query("quality_payload", check_sql(
    "SELECT case_id, count(*) AS total_rows, " + r("avg(thp_dl)", "thp_dl_mean")
    + ", (count(*) - count(thp_dl))::bigint AS thp_dl_missing, 'thp_ul' AS second_column FROM back GROUP BY case_id", "back"))
def quality_payload(spark, d):
    out = payloads.quality_payload(quality.batch_stats(batches(spark, d), fv.KPIS), fv.KPIS)
    return rounded(out.select(
        "case_id",
        _from("payload", "$.total_rows", "bigint").alias("total_rows"),
        _from("payload", "$.sample_stats.thp_dl.mean", "double").alias("thp_dl_mean"),
        _from("payload", "$.sample_stats.thp_dl.missing_count", "bigint").alias("thp_dl_missing"),
        _from("payload", "$.columns[1]").alias("second_column"),
    ))


@query("insight_payload", check_sql(
    "SELECT case_id, count(*) AS total_anomalies, " + r("arg_min(probability, (ts, event_id))", "first_probability")
    + ", " + r("arg_min(bler_dl, (ts, event_id))", "first_bler")
    + " FROM sb WHERE prediction = 1 GROUP BY case_id", "incidents", "scored", sb=_SB))
def insight_payload(spark, d):
    out = payloads.insight_payload(detect.anomaly_samples(_first_hits(spark, d)), _detections(spark, d))
    return rounded(out.select(
        "case_id",
        _from("payload", "$.total_anomalies", "bigint").alias("total_anomalies"),
        _from("payload", "$.samples[0].probability", "double").alias("first_probability"),
        _from("payload", "$.samples[0].metrics.bler_dl", "double").alias("first_bler"),
    ))


@query("signal_payload", check_sql(
    "SELECT event_id, arg_min(metric, ord) AS first_metric, " + r("arg_min(delta_pct, ord)", "first_delta")
    + " FROM long_dev WHERE is_anomaly GROUP BY event_id", "long_dev"))
def signal_payload(spark, d):
    rows = features.anomalies(kpi_r(spark, d))
    out = payloads.signal_payload(fingerprint.deviation_array(rows, baselines(spark, d)))
    return rounded(out.filter(F.size("deviations") > 0).select(
        "event_id",
        _from("payload", "$[0].metric").alias("first_metric"),
        _from("payload", "$[0].delta_pct", "double").alias("first_delta"),
    ))


@query("diagnosis_payload", check_sql(
    "SELECT event_id, metric AS first_metric, " + r("baseline", "first_baseline")
    + ", 'null' AS attribution FROM top WHERE pos = 1", "long_dev", top=_TOP))
def diagnosis_payload(spark, d):
    out = payloads.diagnosis_payload(anomalies_profiled(spark, d))
    return rounded(out.filter(F.size("fingerprint") > 0).select(
        "event_id",
        _from("payload", "$.delta_based_signals[0].metric").alias("first_metric"),
        _from("payload", "$.delta_based_signals[0].baseline", "double").alias("first_baseline"),
        F.coalesce(_from("payload", "$.shap_attribution"), F.lit("null")).alias("attribution"),
    ))


@query("plan_payload", check_sql(
    "SELECT event_id, cell_name AS cell, primary_cause, " + r("confidence")
    + ", 'medium' AS restart_risk FROM conf", "conf"))
def plan_payload(spark, d):
    out = payloads.plan_payload(diagnose.diagnose(anomalies_profiled(spark, d)))
    return rounded(out.select(
        "event_id",
        _from("payload", "$.cell").alias("cell"),
        _from("payload", "$.diagnosis.primary_cause").alias("primary_cause"),
        _from("payload", "$.diagnosis.confidence", "double").alias("confidence"),
        _from("payload", "$.available_actions.restart_signaling_stack.risk").alias("restart_risk"),
    ))


_TOUCHED = (
    "SELECT case_id, count(DISTINCT c) AS n_cells FROM (SELECT case_id, unnest([json_extract_string(j, '$.actions[' || i || "
    "'].params.cell'), nullif(json_extract_string(j, '$.actions[' || i || '].params.neighbor'), 'AUTO')]) AS c FROM "
    "(SELECT case_id, j, unnest(range(json_array_length(j, '$.actions')::bigint)) AS i FROM ans WHERE j IS NOT NULL) x "
    f"WHERE json_extract_string(j, '$.actions[' || i || '].id') IN ({_WL})) y GROUP BY case_id"
)


@query("execution_payload", check_sql(
    "SELECT case_id, split_part(actions, ':', 1) AS first_action, n_cells, n_cells <= 3 AS blast_radius_ok, "
    "3::bigint AS max_blast_radius FROM p JOIN t USING (case_id) WHERE actions IS NOT NULL",
    "plan_answers", ans=answers_sql("plan_answers"), p=_PLANS, t=_TOUCHED))
def execution_payload(spark, d):
    plans = stage(planning.assemble_plans(views.view(spark, d, "plan_answers")), "plans").filter("error IS NULL")
    actions = plans.select("case_id", F.explode("plan.actions").alias("a")).select("case_id", "a.params")
    out = payloads.execution_payload(plans.join(planning.blast_radius(actions), "case_id"))
    return out.select(
        "case_id",
        _from("payload", "$.actions[0].id").alias("first_action"),
        _from("payload", "$.affected_cells", "bigint").alias("n_cells"),
        _from("payload", "$.blast_radius_ok", "boolean").alias("blast_radius_ok"),
        _from("payload", "$.guardrails.max_blast_radius", "bigint").alias("max_blast_radius"),
    )


@query("verification_payload", check_sql(
    f"SELECT p.case_id, p.cell_name AS cell, {r('p.bler_dl', 'before_bler')}, {r('a.cqi_dl', 'after_cqi')}, "
    f"{r('b.prb_dl', 'base_prb')} FROM before_r p JOIN after_r a ON a.case_id = p.case_id "
    "LEFT JOIN base b ON b.cell_name = p.cell_name", "before_r", "after_r", "base"))
def verification_payload(spark, d):
    found = cases.as_cases(incidents(spark, d))
    last = sliding.last_in_window(found, kpi_r(spark, d), SIX_HOURS, 0, ["ts", "event_id", *fv.VERIFY_METRICS])
    wide = verify.verification_wide(cases.before_row(last), _after(spark, d), baselines(spark, d))
    return rounded(payloads.verification_payload(wide).select(
        "case_id",
        _from("payload", "$.cell").alias("cell"),
        _from("payload", "$.before.bler_dl", "double").alias("before_bler"),
        _from("payload", "$.after.cqi_dl", "double").alias("after_cqi"),
        _from("payload", "$.baseline.prb_dl", "double").alias("base_prb"),
    ))


# ---- case memory ---------------------------------------------------------------------------

def _cases(spark, d):
    """Whole cases: fingerprint, rule diagnosis, assembled plan, execution and verdict."""
    found = diagnose.diagnose(anomalies_profiled(spark, d)).select(
        F.col("event_id").alias("case_id"), "cell_name", F.col("ts").alias("t0"), "fingerprint", "rca"
    )
    plans = planning.assemble_plans(views.view(spark, d, "plan_answers")).filter("error IS NULL").drop("error")
    runs = responses.execution_response(views.view(spark, d, "execution_answers")).select("case_id", "execution")
    verdicts = responses.verdict_response(views.view(spark, d, "verdicts")).select("case_id", "closed", "residual_risk")
    return found.join(plans, "case_id", "left").join(runs, "case_id", "left").join(verdicts, "case_id", "left")


_SUMMARY = (
    "SELECT c.event_id AS case_id, c.cell_name AS cell, c.primary_cause, c.confidence, "
    "coalesce(split_part(p.actions, ':', 1), 'none') AS first_action, "
    f"CASE WHEN x.j IS NULL THEN 'ok' ELSE coalesce(json_extract_string(x.j, '$.status'), 'unknown') END AS status, "
    "coalesce(v.closed AND v.valid, false) AS closed FROM conf c LEFT JOIN p ON p.case_id = c.event_id "
    "LEFT JOIN ex x ON x.case_id = c.event_id LEFT JOIN v ON v.case_id = c.event_id"
)
_SUMMARY_CTES = {
    "ans_p": answers_sql("plan_answers"), "ex": answers_sql("execution_answers"), "ans": answers_sql("verdicts"),
    "p": _PLANS.replace("FROM ans", "FROM ans_p"), "v": _VERDICT,
}


@query("case_summary", check_sql(
    f"SELECT case_id, cell, primary_cause, {r('confidence')}, first_action, status, closed FROM ({_SUMMARY}) s",
    "conf", "plan_answers", "execution_answers", "verdicts", **_SUMMARY_CTES))
def case_summary(spark, d):
    out = knowledge.case_summary(_cases(spark, d))
    return rounded(out.select(
        "case_id", "cell", "rca.primary_cause", "rca.confidence",
        F.coalesce(F.get("plan.actions", F.lit(0))["id"], F.lit("none")).alias("first_action"),
        "execution.status", "outcome.closed",
    ))


@query("learning_payload", check_sql(
    f"SELECT case_id, cell, primary_cause, first_action, closed FROM ({_SUMMARY}) s",
    "conf", "plan_answers", "execution_answers", "verdicts", **_SUMMARY_CTES))
def learning_payload(spark, d):
    out = payloads.learning_payload(knowledge.case_summary(_cases(spark, d)))
    return out.select(
        "case_id",
        _from("payload", "$.cell").alias("cell"),
        _from("payload", "$.rca.primary_cause").alias("primary_cause"),
        F.coalesce(_from("payload", "$.plan.actions[0].id"), F.lit("none")).alias("first_action"),
        _from("payload", "$.outcome.closed", "boolean").alias("closed"),
    )


def _learnings(spark, d):
    made = views.view(spark, d, "learnings")
    parts = F.filter(F.split("signature_csv", ","), lambda x: x != "")
    return made.withColumn("signature", parts)


def _case_signals(spark, d):
    """Signals of a case: metrics that moved by more than a tenth."""
    found = diagnose.diagnose(anomalies_profiled(spark, d))
    moved = F.filter("fingerprint", lambda s: F.abs(s["delta_pct"]) > 10)
    signals = found.select(
        F.col("event_id").alias("case_id"),
        F.transform(moved, lambda s: s["metric"]).alias("signals"),
        F.col("rca.primary_cause").alias("cause"),
    )
    return stage(signals, "case-signals")


_CASE_SIGNALS = (
    "SELECT c.event_id AS case_id, c.primary_cause AS cause, coalesce(list(metric) FILTER (WHERE abs(delta_pct) > 10), []) "
    "AS signals FROM cause c LEFT JOIN long_dev l ON l.event_id = c.event_id GROUP BY ALL"
)
# Equal (signals, cause) pairs score alike, so pairs of distinct shapes carry every score.
_SCORES = (
    "SELECT case_id, learning_id, citation, confidence, score, row_number() OVER (PARTITION BY case_id ORDER BY score DESC, "
    "learning_id) AS rank FROM (SELECT c.case_id, l.learning_id, l.citation, l.confidence, "
    "(len(list_intersect(c.signals, string_split(l.signature_csv, ','))) / greatest(len(list_distinct(c.signals)), 1)) * 6e-1 "
    "+ (CASE WHEN l.cause_pattern = c.cause THEN 1e0 ELSE 3e-1 END) * 4e-1 AS score FROM cs c CROSS JOIN learnings l) x "
    "WHERE score > 3e-1 QUALIFY rank <= 3"
)


@query("similar_cases", check_sql(
    f"SELECT case_id, rank, learning_id, {r('score')} FROM sc", "cause", "long_dev", "learnings",
    cs=_CASE_SIGNALS, sc=_SCORES))
def similar_cases(spark, d):
    return rounded(knowledge.similar_cases(_case_signals(spark, d), _learnings(spark, d)))


@query("recommendations", check_sql(
    "SELECT case_id, rank, citation || ' (confidence: ' || printf('%.1f', confidence * 100) || '%)' AS recommendation "
    "FROM sc WHERE citation <> '' AND confidence > 5e-1", "cause", "long_dev", "learnings",
    cs=_CASE_SIGNALS, sc=_SCORES))
def recommendations(spark, d):
    learned = _learnings(spark, d)
    return knowledge.recommendations(knowledge.similar_cases(_case_signals(spark, d), learned), learned)


@query("signal_overlap", check_sql(
    "SELECT c.case_id, round(len(list_intersect(c.signals, ['bler_dl', 'cqi_dl', 'unseen'])) / "
    "greatest(len(list_distinct(c.signals)), 1), 6) AS overlap FROM cs c", "cause", "long_dev", cs=_CASE_SIGNALS))
def signal_overlap(spark, d):
    pattern = E.lit_array(["bler_dl", "cqi_dl", "unseen"])
    share = E.overlap_share(F.col("signals"), pattern)
    return rounded(_case_signals(spark, d).select("case_id", share.alias("overlap")))


# ---- call log ------------------------------------------------------------------------------

def _log(spark, d):
    """The conversation table as a call log: agent = role, time = (conversation, turn)."""
    return views.table(spark, d, "conversations").select(
        F.col("role").alias("agent"), "conv_id", "turn", F.col("text").alias("prompt"),
        F.concat(F.lit("re: "), "text").alias("response"),
    )


@query("call_metrics", "SELECT role AS agent, count(*) AS total_invocations FROM conversations GROUP BY role")
def call_metrics(spark, d):
    return report.call_metrics(_log(spark, d))


_RECENT = (
    "SELECT role AS agent, text, row_number() OVER (PARTITION BY role ORDER BY conv_id DESC, turn DESC) AS back, "
    "count(*) OVER (PARTITION BY role) AS n FROM conversations"
)


@query("recent_exchanges", f"""
SELECT agent, (least(n, 5) + 1 - back)::int AS item, substring(text, 1, 100) || '...' AS prompt,
  substring('re: ' || text, 1, 100) || '...' AS response FROM ({_RECENT}) x WHERE back <= 5""")
def recent_exchanges(spark, d):
    return report.recent_exchanges(_log(spark, d), ["conv_id", "turn"])


@query("history_summary", f"""
SELECT agent, 'Conversation History (' || any_value(n)::varchar || ' exchanges):' || chr(10) || string_agg(
  chr(10) || (least(n, 5) + 1 - back)::varchar || '. Prompt: ' || substring(text, 1, 100) || '...' || chr(10)
  || '   Response: ' || substring('re: ' || text, 1, 100) || '...' || chr(10), '' ORDER BY back DESC) AS summary
FROM ({_RECENT}) x WHERE back <= 5 GROUP BY agent
UNION ALL SELECT 'nobody', 'No conversation history'""")
def history_summary(spark, d):
    log = _log(spark, d)
    agents = log.select("agent").distinct().unionByName(log.sparkSession.range(1).select(F.lit("nobody").alias("agent")))
    return report.history_summary(log, agents, ["conv_id", "turn"])
