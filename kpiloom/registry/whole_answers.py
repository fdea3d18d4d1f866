"""Answers and request payloads field by field: nothing of them is left out of the comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.operators import cases, detect, diagnose, features, fingerprint, knowledge, payloads, planning
from kpiloom.operators import quality, responses, sliding, verify
from kpiloom.registry.base import answers_sql, check_sql, query, r, rounded
from kpiloom.registry.incidents import _CTX, _SB, _TOP, _detections, _first_hits, _line
from kpiloom.registry.inputs import SIX_HOURS, anomalies_profiled, baselines, incidents, kpi_r
from kpiloom.registry.plans_and_answers import _OBJ, _PLANS, _SUMMARY_CTES, _TOUCHED, _cases, _get, _type
from kpiloom.session import stage
from kpiloom.sources import views

_NONE = "none"


def _or_none(column) -> Column:
    return F.coalesce(column if isinstance(column, Column) else F.col(column), F.lit(_NONE))


def _listed(column) -> Column:
    return _or_none(F.array_join(column, "|"))


def _items(column, *names: str) -> Column:
    """Structs of an array as ``a:b|c:d``."""
    return _or_none(F.array_join(
        F.transform(column, lambda x: F.concat_ws(":", *[F.coalesce(x[n].cast("string"), F.lit("-")) for n in names])), "|"))


def _sql_list(path: str, j: str = "j") -> str:
    return f"coalesce(array_to_string(from_json(json_extract({j}, '{path}'), '[\"VARCHAR\"]'), '|'), '{_NONE}')"


def _sql_items(path: str, *names: str, j: str = "j") -> str:
    kinds = ", ".join(f'"{n}": "VARCHAR"' for n in names)
    text = " || ':' || ".join(f"coalesce(x.{n}, '-')" for n in names)
    return (f"coalesce(array_to_string(list_transform(from_json(json_extract({j}, '{path}'), '[{{{kinds}}}]'), "
            f"lambda x: {text}), '|'), '{_NONE}')")


def _sql_text(path: str, j: str = "j") -> str:
    return f"coalesce(json_extract_string({j}, '{path}'), '{_NONE}')"


# ---- answers -------------------------------------------------------------------------------

@query("diagnosis_answers_whole", check_sql(
    "SELECT case_id, " + f"CASE {_type('$.evidence')} WHEN 'absent' THEN '' ELSE {_sql_list('$.evidence')} END AS evidence, "
    f"CASE {_type('$.secondary')} WHEN 'absent' THEN '' ELSE {_sql_items('$.secondary', 'cause', 'confidence')} END AS secondary, "
    f"{_type('$.evidence')} = 'NULL' AS evidence_is_null FROM ans WHERE {_OBJ}",
    "diagnosis_answers", ans=answers_sql("diagnosis_answers")))
def diagnosis_answers_whole(spark, d):
    out = responses.diagnosis_response(views.view(spark, d, "diagnosis_answers"))
    # an answer whose confidence is a JSON null is not valid; its lists are read all the same
    raw = responses.parsed(views.view(spark, d, "diagnosis_answers")).filter(F.col("json").isNotNull())
    lists = raw.select("case_id", F.expr("try_variant_get(json, '$.evidence', 'array<string>')").alias("given"))
    found = out.join(lists, "case_id")
    return found.select(
        "case_id",
        F.when(F.col("valid"), _listed("rca.evidence")).otherwise(F.coalesce(F.array_join("given", "|"), F.lit(""))).alias("evidence"),
        F.when(F.col("valid"), _items("rca.secondary", "cause", "confidence")).otherwise("").alias("secondary"),
        (F.col("valid") & F.col("rca.evidence").isNull()).alias("evidence_is_null"),
    )


@query("execution_answers_whole", check_sql(
    "SELECT e.case_id, CASE WHEN e.j IS NULL THEN (SELECT string_agg(split_part(a, ':', 1) || ':applied:simulated:-', '|') FROM "
    "(SELECT unnest(string_split(p.actions, ',')) AS a) x) "
    f"ELSE replace({_sql_items('$.executed', 'id', 'status', 'method', 'reason', j='e.j')}, '{_NONE}', '') END AS executed, "
    "CASE WHEN e.j IS NULL THEN 'ok' ELSE " + _sql_text("$.status", "e.j") + " END AS status, "
    "CASE WHEN e.j IS NULL THEN 'simulated' ELSE " + _sql_text("$.mode", "e.j") + " END AS mode, "
    + ", ".join(f"{_sql_text(f'$.safety_checks.{k}', 'e.j')} AS {k}" for k in ("blast_radius_ok", "prechecks_passed", "change_window_ok"))
    + " FROM e JOIN p USING (case_id) WHERE p.actions IS NOT NULL",
    "execution_answers", "plan_answers", ans=answers_sql("plan_answers"), p=_PLANS, e=answers_sql("execution_answers")))
def execution_answers_whole(spark, d):
    plans = stage(planning.assemble_plans(views.view(spark, d, "plan_answers")), "plans").filter("error IS NULL")
    planned = plans.select("case_id", F.col("plan.actions").alias("actions"))
    out = responses.execution_response(views.view(spark, d, "execution_answers").join(planned, "case_id"), "actions")
    safety = F.col("execution.safety_checks")
    return out.select(
        "case_id", _items("execution.executed", "id", "status", "method", "reason").alias("executed"),
        _or_none("execution.status").alias("status"), _or_none("execution.mode").alias("mode"),
        *[_or_none(safety[k].cast("string")).alias(k) for k in ("blast_radius_ok", "prechecks_passed", "change_window_ok")],
    )


_COMPLETE = f"{_OBJ} AND {_type('$.closed')} <> 'absent' AND {_type('$.checks')} <> 'absent'"


@query("verdict_answers_whole", check_sql(
    f"SELECT case_id, {_sql_items('$.checks', 'postcheck', 'ok', 'evidence')} AS checks, {_sql_text('$.residual_risk')} "
    f"AS residual_risk, {_sql_text('$.overall_assessment')} AS overall_assessment, "
    + ", ".join(f"try_cast({_get(f'$.kpi_improvements.{m}.{k}')} AS double) AS {m}_{k}"
                for m in ("bler_dl", "cqi_dl") for k in ("before", "after", "change_pct"))
    + ", " + ", ".join(f"{_sql_text(f'$.kpi_improvements.{m}.improved')} AS {m}_improved" for m in ("bler_dl", "cqi_dl"))
    + f" FROM ans WHERE {_COMPLETE}", "verdicts", ans=answers_sql("verdicts")))
def verdict_answers_whole(spark, d):
    out = responses.verdict_response(views.view(spark, d, "verdicts")).filter("valid")
    at = {m: F.try_element_at("kpi_improvements", F.lit(m)) for m in ("bler_dl", "cqi_dl")}
    return out.select(
        "case_id", _items("checks", "postcheck", "ok", "evidence").alias("checks"),
        _or_none("residual_risk").alias("residual_risk"), _or_none("overall_assessment").alias("overall_assessment"),
        *[v[k].alias(f"{m}_{k}") for m, v in at.items() for k in ("before", "after", "change_pct")],
        *[_or_none(v["improved"].cast("string")).alias(f"{m}_improved") for m, v in at.items()],
    )


_LEARNING_TEXTS = {
    "cause_pattern": "$.pattern.cause_pattern", "context": "$.pattern.context", "outcome": "$.solution.outcome",
    "what_worked": "$.learning.what_worked", "what_failed": "$.learning.what_failed",
    "applicability": "$.learning.applicability", "citation": "$.citation",
}
_LEARNING_LISTS = {
    "signature": "$.pattern.fingerprint_signature", "success_factors": "$.solution.success_factors",
    "similarity_keys": "$.similarity_keys",
}


@query("learning_answers_whole", check_sql(
    "SELECT case_id, " + ", ".join(f"{_sql_text(p)} AS {n}" for n, p in _LEARNING_TEXTS.items()) + ", "
    + ", ".join(f"{_sql_list(p)} AS {n}" for n, p in _LEARNING_LISTS.items())
    + f", {_sql_items('$.solution.actions_taken', 'action', 'risk')} AS actions_taken, "
    f"{_sql_text('$.solution.actions_taken[0].params.neighbor')} AS first_neighbor, "
    f"try_cast({_get('$.learning.confidence')} AS double) AS confidence FROM ans WHERE {_OBJ} AND "
    + " AND ".join(f"{_type(f'$.{k}')} <> 'absent'" for k in fv.REQUIRED_LEARNING_KEYS),
    "learning_answers", ans=answers_sql("learning_answers")))
def learning_answers_whole(spark, d):
    out = responses.learning_response(views.view(spark, d, "learning_answers")).filter("valid")
    first = F.get("actions_taken", F.lit(0))["params"]
    return out.select(
        "case_id", *[_or_none(n).alias(n) for n in _LEARNING_TEXTS], *[_listed(n).alias(n) for n in _LEARNING_LISTS],
        _items("actions_taken", "action", "risk").alias("actions_taken"),
        _or_none(F.try_element_at(first, F.lit("neighbor"))).alias("first_neighbor"), "confidence",
    )


# ---- request payloads ----------------------------------------------------------------------

def _read(df, schema: str, *keys: str):
    """The payload read back from its JSON text, as struct ``p``."""
    return df.select(*keys, F.from_json("payload", schema).alias("p"))


_SHOWN = fv.KPIS[:5]


@query("quality_payload_whole", check_sql(
    "SELECT case_id, count(*) AS total_rows, '" + "|".join(fv.KPIS[:10]) + "' AS columns, " + ", ".join(
        f"{r(f'avg({c})', f'{c}_mean')}, (count(*) - count({c}))::bigint AS {c}_missing_count, "
        f"{r(f'(count(*) - count({c})) * 1e2 / count(*)', f'{c}_missing_pct')}" for c in _SHOWN)
    + " FROM back GROUP BY case_id", "back"))
def quality_payload_whole(spark, d):
    stats = quality.window_stats(cases.as_cases(incidents(spark, d)), kpi_r(spark, d), fv.KPIS, SIX_HOURS)
    one = "struct<mean:double,missing_count:bigint,missing_pct:double>"
    schema = f"total_rows bigint, columns array<string>, sample_stats struct<{','.join(f'{c}:{one}' for c in _SHOWN)}>"
    out = _read(payloads.quality_payload(stats, fv.KPIS), schema, "case_id")
    return rounded(out.select(
        "case_id", "p.total_rows", F.array_join("p.columns", "|").alias("columns"),
        *[F.col(f"p.sample_stats.{c}.{k}").alias(f"{c}_{k}") for c in _SHOWN for k in ("mean", "missing_count", "missing_pct")],
    ))


@query("insight_payload_whole", check_sql(
    f"SELECT case_id, total_anomalies, pos, {r('probability')}, {', '.join(r(m) for m in fv.SAMPLE_METRICS)} FROM (SELECT *, "
    "count(*) OVER (PARTITION BY case_id) AS total_anomalies, row_number() OVER (PARTITION BY case_id ORDER BY ts, event_id) "
    "AS pos FROM sb WHERE prediction = 1) x WHERE pos <= 3", "incidents", "scored", sb=_SB))
def insight_payload_whole(spark, d):
    metrics = ",".join(f"{m}:double" for m in fv.SAMPLE_METRICS)
    schema = f"total_anomalies bigint, samples array<struct<probability:double,metrics:struct<{metrics}>>>"
    out = _read(payloads.insight_payload(detect.anomaly_samples(_first_hits(spark, d)), _detections(spark, d)), schema, "case_id")
    return rounded(out.select("case_id", "p.total_anomalies", F.posexplode("p.samples").alias("pos", "s")).select(
        "case_id", "total_anomalies", (F.col("pos") + 1).alias("pos"), "s.probability", "s.metrics.*"))


@query("signal_payload_whole", check_sql(
    "SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY ord) AS pos, metric, "
    f"{r('value', 'current')}, {r('baseline')}, {r('delta_pct')}, CASE WHEN delta_pct >= 0 THEN 'up' ELSE 'down' END "
    "AS direction FROM long_dev WHERE is_anomaly", "long_dev"))
def signal_payload_whole(spark, d):
    out = payloads.signal_payload(fingerprint.deviation_array(features.anomalies(kpi_r(spark, d)), baselines(spark, d)))
    schema = "array<struct<metric:string,current:double,baseline:double,delta_pct:double,direction:string>>"
    return rounded(_read(out, schema, "event_id").select("event_id", F.posexplode("p").alias("pos", "s")).select(
        "event_id", (F.col("pos") + 1).alias("pos"), "s.*"))


@query("diagnosis_payload_whole", check_sql(
    f"SELECT event_id, pos, metric, {r('delta_pct')}, CASE WHEN delta_pct >= 0 THEN 'up' ELSE 'down' END AS direction, "
    f"{r('value', 'current_value')}, {r('baseline')}, '{_NONE}' AS attribution FROM top WHERE pos <= {fv.TOP_SIGNALS}",
    "long_dev", top=_TOP))
def diagnosis_payload_whole(spark, d):
    item = "struct<metric:string,delta_pct:double,direction:string,current_value:double,baseline:double>"
    schema = f"delta_based_signals array<{item}>, shap_attribution array<struct<feature:string,shap_value:double,direction:string>>"
    out = _read(payloads.diagnosis_payload(anomalies_profiled(spark, d)), schema, "event_id")
    return rounded(out.select(
        "event_id", F.posexplode("p.delta_based_signals").alias("pos", "s"),
        _items("p.shap_attribution", "feature", "shap_value", "direction").alias("attribution"),
    ).select("event_id", (F.col("pos") + 1).alias("pos"), "s.*", "attribution"))


_ACTIONS = "|".join(f"{a}:{text}:{','.join(names)}:{str(rev).lower()}:{risk}" for a, names, rev, risk, text in fv.ACTIONS)
_EVIDENCE = (
    "CASE c.primary_cause "
    f"WHEN 'interference' THEN {_line('BLER up', 'bler')} || '|' || {_line('CQI down', 'cqi')} || '|PRB not high' "
    f"WHEN 'high_load' THEN {_line('DL PRB up', 'prb')} || '|' || {_line('Throughput down', 'thp')} "
    f"WHEN 'connection_failure' THEN {_line('RRC success rate down', 'rrc')} "
    f"WHEN 'power_anomaly' THEN {_line('Energy efficiency down', 'eff')} "
    f"WHEN 'low_throughput' THEN {_line('Throughput down', 'thp')} || '|Load not high' ELSE '' END"
)


@query("plan_payload_whole", check_sql(
    f"SELECT event_id, cell_name AS cell, primary_cause, {r('confidence')}, {_EVIDENCE} AS evidence, 0 AS n_secondary, "
    "'" + _ACTIONS.replace("'", "''") + "' AS available_actions FROM conf c", "conf"))
def plan_payload_whole(spark, d):
    item = "struct<description:string,params:array<string>,reversible:boolean,risk:string>"
    schema = (
        "cell string, diagnosis struct<primary_cause:string,confidence:double,evidence:array<string>,"
        f"secondary_hypotheses:array<struct<cause:string>>>, available_actions struct<{','.join(f'{a[0]}:{item}' for a in fv.ACTIONS)}>"
    )
    out = _read(payloads.plan_payload(diagnose.diagnose(anomalies_profiled(spark, d))), schema, "event_id")
    allowed = [
        F.concat_ws(":", F.lit(a[0]), F.col(f"p.available_actions.{a[0]}.description"),
                    F.array_join(f"p.available_actions.{a[0]}.params", ","),
                    F.col(f"p.available_actions.{a[0]}.reversible").cast("string"), F.col(f"p.available_actions.{a[0]}.risk"))
        for a in fv.ACTIONS
    ]
    return rounded(out.select(
        "event_id", "p.cell", "p.diagnosis.primary_cause", "p.diagnosis.confidence",
        F.array_join("p.diagnosis.evidence", "|").alias("evidence"),
        F.size("p.diagnosis.secondary_hypotheses").alias("n_secondary"), F.concat_ws("|", *allowed).alias("available_actions"),
    ))


def _plan_lists(j: str) -> str:
    default = "|".join(fv.DEFAULT_PRECHECKS)
    return (
        f"CASE WHEN json_type({j}, '$.prechecks') IS NULL THEN '{default}' ELSE {_sql_list('$.prechecks', j)} END AS prechecks, "
        f"CASE WHEN json_type({j}, '$.postchecks') IS NULL THEN '' ELSE {_sql_list('$.postchecks', j)} END AS postchecks"
    )


@query("execution_payload_whole", check_sql(
    f"SELECT case_id, replace(actions, ',', '|') AS actions, {_plan_lists('p.j')}, "
    f"CASE WHEN json_type(p.j, '$.sla') IS NULL THEN {fv.DEFAULT_SLA_MINUTES}e0 "
    "ELSE try_cast(json_extract_string(p.j, '$.sla.verify_minutes') AS double) END AS verify_minutes, "
    f"CASE WHEN json_type(p.j, '$.sla') IS NULL THEN '{fv.DEFAULT_SLA_CRITERIA}' ELSE {_sql_text('$.sla.success_criteria', 'p.j')} END "
    "AS success_criteria, n_cells AS affected_cells, n_cells <= 3 AS blast_radius_ok, "
    f"{fv.MAX_BLAST_RADIUS}::bigint AS max_blast_radius, true AS require_change_window, true AS auto_rollback_on_failure, "
    f"'{fv.MANUAL_INTERVENTION}' AS manual_intervention_threshold FROM p JOIN t USING (case_id) WHERE actions IS NOT NULL",
    "plan_answers", ans=answers_sql("plan_answers"), p=_PLANS, t=_TOUCHED))
def execution_payload_whole(spark, d):
    plans = stage(planning.assemble_plans(views.view(spark, d, "plan_answers")), "plans").filter("error IS NULL")
    touched = planning.blast_radius(
        plans.select("case_id", F.explode("plan.actions").alias("a")).select("case_id", "a.params"))
    schema = (
        "actions array<struct<id:string,reversible:boolean>>, prechecks array<string>, postchecks array<string>, "
        "sla struct<verify_minutes:double,success_criteria:string>, guardrails struct<max_blast_radius:bigint,"
        "require_change_window:boolean,auto_rollback_on_failure:boolean,manual_intervention_threshold:string>, "
        "affected_cells bigint, blast_radius_ok boolean"
    )
    out = _read(payloads.execution_payload(plans.join(touched, "case_id")), schema, "case_id")
    return out.select(
        "case_id", _items("p.actions", "id", "reversible").alias("actions"), _listed("p.prechecks").alias("prechecks"),
        _listed("p.postchecks").alias("postchecks"), "p.sla.verify_minutes", _or_none("p.sla.success_criteria").alias("success_criteria"),
        "p.affected_cells", "p.blast_radius_ok", "p.guardrails.*",
    )


@query("verification_payload_whole", check_sql(
    "SELECT w.*, replace(regexp_replace(p.actions, ':(true|false)', '', 'g'), ',', '|') AS actions_taken, "
    "CASE WHEN json_type(p.j, '$.postchecks') IS NULL THEN '' "
    f"ELSE {_sql_list('$.postchecks', 'p.j')} END AS postchecks FROM (SELECT case_id, cell_name AS cell, " + ", ".join(
        f"round(max({side}) FILTER (WHERE metric = '{m}'), 6) AS {name}_{m}"
        for side, name in (('"before"', "before"), ('"after"', "after"), ("baseline", "baseline")) for m in fv.VERIFY_METRICS)
    + " FROM ctx GROUP BY case_id, cell_name) w JOIN p USING (case_id) WHERE p.actions IS NOT NULL",
    "before_r", "after_r", "base", "plan_answers", ctx=_CTX, ans=answers_sql("plan_answers"), p=_PLANS))
def verification_payload_whole(spark, d):
    """The verify request with its plan: post-checks and actions taken."""
    found = cases.as_cases(incidents(spark, d))
    metrics = fv.VERIFY_METRICS
    both = sliding.last_in_windows(found, kpi_r(spark, d), {"before": (SIX_HOURS, 0), "after": (0, SIX_HOURS)}, metrics)
    before = both.select("case_id", "cell_name", "before.*")
    after = both.filter("after IS NOT NULL").select("case_id", "after.*")
    plans = planning.assemble_plans(views.view(spark, d, "plan_answers")).filter("error IS NULL").select("case_id", "plan")
    wide = verify.verification_wide(before, after, baselines(spark, d)).join(plans, "case_id")
    one = ",".join(f"{m}:double" for m in metrics)
    schema = (
        f"cell string, before struct<{one}>, after struct<{one}>, baseline struct<{one}>, postchecks array<string>, "
        "actions_taken array<struct<id:string,params:map<string,string>>>"
    )
    out = _read(payloads.verification_payload(wide, plan="plan"), schema, "case_id")
    return rounded(out.select(
        "case_id", "p.cell",
        *[F.col(f"p.{side}.{m}").alias(f"{side}_{m}") for side in ("before", "after", "baseline") for m in metrics],
        _items("p.actions_taken", "id").alias("actions_taken"), _listed("p.postchecks").alias("postchecks"),
    ))


@query("learning_payload_whole", check_sql(
    "SELECT c.event_id AS case_id, c.cell_name AS cell, c.ts::varchar AS time, coalesce(f.signals, '') AS fingerprint, "
    f"c.primary_cause, {r('c.confidence', 'confidence')}, "
    "coalesce(replace(regexp_replace(array_to_string(string_split(p.actions, ',')[1:3], ','), ':(true|false)', '', 'g'), ',', '|'), "
    f"'{_NONE}') AS actions, CASE WHEN x.j IS NULL THEN 'ok' ELSE coalesce(json_extract_string(x.j, '$.status'), 'unknown') END AS status, "
    "CASE WHEN x.j IS NULL THEN 0 ELSE coalesce(json_array_length(x.j, '$.executed'), 0) END::bigint AS executed_count, "
    "coalesce(v.closed AND v.valid, false) AS closed, CASE WHEN v.valid THEN coalesce(json_extract_string(v.j, "
    "'$.residual_risk'), 'unknown') ELSE 'unknown' END AS residual_risk FROM conf c LEFT JOIN (SELECT event_id, "
    "string_agg(metric, '|' ORDER BY pos) AS signals FROM top WHERE pos <= 5 GROUP BY event_id) f ON f.event_id = c.event_id "
    "LEFT JOIN p ON p.case_id = c.event_id LEFT JOIN ex x ON x.case_id = c.event_id LEFT JOIN v ON v.case_id = c.event_id",
    "conf", "long_dev", "plan_answers", "execution_answers", "verdicts", top=_TOP, **_SUMMARY_CTES))
def learning_payload_whole(spark, d):
    schema = (
        "case_id bigint, cell string, time string, fingerprint array<struct<metric:string>>, "
        "rca struct<primary_cause:string,confidence:double>, plan struct<actions:array<struct<id:string>>>, "
        "execution struct<status:string,executed_count:bigint>, outcome struct<closed:boolean,residual_risk:string>"
    )
    out = payloads.learning_payload(knowledge.case_summary(_cases(spark, d))).select(F.from_json("payload", schema).alias("p"))
    return rounded(out.select(
        "p.case_id", "p.cell", "p.time", F.array_join(F.transform("p.fingerprint", lambda s: s["metric"]), "|").alias("fingerprint"),
        "p.rca.*", _items("p.plan.actions", "id").alias("actions"), "p.execution.*", "p.outcome.*",
    ))
