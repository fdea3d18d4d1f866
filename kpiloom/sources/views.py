"""KPI-shaped views over the event table, written to run in any SQL engine.

``events`` holds no KPI readings, so cells, readings, faults, proposals, model
answers and past learnings are derived from it by arithmetic on its columns:
every view grows with the table.  The same text runs on Spark and on the engine
that checks the results, which is why doubles are written like ``1e0``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiloom.session import spread

KPI = """
SELECT event_id, cell_name, ts, is_anomaly,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE (3e1 + k * 2e-2) * CASE WHEN f IN (1, 4) THEN 5e-1 ELSE 1e0 END END AS thp_dl,
  (1.2e1 + k * 1e-2) AS thp_ul,
  (4e1 + (event_id % 7) * 5e-1) * CASE WHEN f = 1 THEN 1.5e0 ELSE 1e0 END AS prb_dl,
  (2.7e1 + (event_id % 3) * 5e-1) AS prb_ul,
  (6.7e1 + (k % 5) * 1e0) * CASE WHEN f = 2 THEN 8e-1 ELSE 1e0 END AS rrc_succ,
  CASE WHEN event_id % 23 = 0 THEN 0e0 ELSE 7e1 + (k % 5) * 1e0 END AS rrc_att,
  (1.2e1 - (event_id % 4) * 1e-1) * CASE WHEN f = 0 THEN 6e-1 ELSE 1e0 END AS cqi_dl,
  (1.3e-2 + (k % 10) * 1e-4) * CASE WHEN f = 0 THEN 2e0 ELSE 1e0 END AS bler_dl,
  (6.5e1 + (k % 4) * 1e0) AS pdu_succ,
  (1.38e2 + (k % 6) * 1e0) AS qf_succ,
  (9.4e2 + (k % 9) * 1e0) * CASE WHEN f = 3 AND k % 2 = 0 THEN 1.15e0 ELSE 1e0 END AS avg_power,
  (2.5e6 + k * 1e2) * CASE WHEN f = 3 AND k % 2 = 1 THEN 7e-1 ELSE 1e0 END AS energy_eff,
  2e1 AS min_prb,
  8e1 AS max_prb
FROM (
  SELECT event_id, concat('CELL_', CAST(user_id % 15 AS string)) AS cell_name, ts,
         event_type = 'error' AS is_anomaly,
         CASE WHEN event_type = 'error' THEN event_id % 5 ELSE -1 END AS f,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS int) AS k
  FROM {events}) g
"""

_WIDE_GAPS = ["thp_dl", "prb_dl", "prb_ul", "rrc_succ", "rrc_att", "cqi_dl", "bler_dl", "pdu_succ", "qf_succ"]

KPI_DIRTY = (
    "SELECT event_id, cell_name, ts, is_anomaly, thp_ul,\n"
    + "".join(
        f"  CASE WHEN event_id % 31 = 0 OR event_id % 37 = 0 THEN NULL ELSE {c} END AS {c},\n" for c in _WIDE_GAPS
    )
    + """  CASE WHEN event_id % 31 = 0 THEN NULL ELSE avg_power END AS avg_power,
  energy_eff, min_prb, max_prb
FROM (
  SELECT * FROM {kpi}
  UNION ALL
  SELECT * FROM {kpi} WHERE event_id % 50 = 0) d
"""
)

PROPOSALS = """
SELECT event_id AS case_id, p.pos,
  CASE (event_id + p.pos) % 6
    WHEN 0 THEN 'scheduler_protection' WHEN 1 THEN 'tilt_neighbor'
    WHEN 2 THEN 'restart_signaling_stack' WHEN 3 THEN 'check_backhaul'
    WHEN 4 THEN 'limit_tx_power' ELSE 'reboot_everything' END AS action_id,
  cell_name AS p_cell,
  CASE WHEN event_id % 3 = 0 THEN 'AUTO'
       ELSE concat('CELL_', CAST((event_id * p.pos) % 15 AS string)) END AS p_neighbor
FROM {kpi} CROSS JOIN (SELECT 1 AS pos UNION ALL SELECT 2 UNION ALL SELECT 3) p
WHERE is_anomaly AND (event_id % 6 <> 4 OR p.pos = 1)
"""

LEARNINGS = """
SELECT event_id AS learning_id,
  CASE event_id % 4 WHEN 0 THEN 'interference' WHEN 1 THEN 'high_load'
    WHEN 2 THEN 'power_anomaly' ELSE 'connection_failure' END AS cause_pattern,
  CASE event_id % 3 WHEN 0 THEN 'bler_dl,cqi_dl' WHEN 1 THEN 'prb_dl,thp_dl,rrc_rate'
    ELSE 'energy_eff' END AS signature_csv,
  CASE WHEN event_id % 10 = 0 THEN '' ELSE concat('note ', CAST(event_id AS string)) END AS citation,
  (event_id % 11) * 1e-1 AS confidence
FROM {kpi} WHERE NOT is_anomaly
"""


def _fenced(json: str, tag: str = "json", before: str = "", after: str = "") -> str:
    parts = [f"'{before}'", "chr(10)", f"'```{tag}'", "chr(10)", json, "chr(10)", "'```'", f"'{after}'"]
    return "concat(" + ", ".join(p for p in parts if p != "''") + ")"


def _text(json: str) -> str:
    """SQL literal of a JSON text; braces doubled for the view formatter."""
    return "'" + json.replace("{", "{{").replace("}", "}}") + "'"


def _answers(agent: str, cases: list[str], extra: str = "") -> str:
    branches = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(cases[:-1]))
    return (
        f"SELECT event_id AS case_id, '{agent}' AS agent{extra},\n"
        f"  CASE event_id % {len(cases)} {branches} ELSE {cases[-1]} END AS text\n"
        "FROM {kpi} WHERE is_anomaly\n"
    )


VERDICTS = _answers("verifier", [
    _fenced(_text('{"closed": true, "checks": []}'), before="Sure:", after=" done"),
    _text('{"closed": "false", "checks": []}'),
    _fenced(_text('{"closed": true, "checks": []}'), tag=""),
    _text("I cannot tell"),
    _text('{"closed": true}'),
    _text('{"closed": null, "checks": [{"postcheck": "bler", "ok": false}, '
          '{"postcheck": "cqi", "ok": true, "evidence": "9 to 11"}], "residual_risk": "low", '
          '"kpi_improvements": {"bler_dl": {"before": 0.25, "after": 0.5, "change_pct": 100, "improved": false}, '
          '"cqi_dl": {"before": "9", "after": null, "improved": true}}, "overall_assessment": "not better"}'),
])

QUALITY_ANSWERS = _answers("quality", [
    _fenced(_text('{"quality": {"rows": 3, "missing_pct": 12.5, "issues": ["gap", "drift"], "severity": "medium"}}')),
    _fenced(_text('{"quality": {"rows": 2, "missing_pct": "7.5", "issues": [], "severity": "low"}}'), tag=""),
    _text('{"summary": 1}'),
    _text("no idea"),
    _text("[1, 2]"),
], extra=", event_id % 4 + 1 AS n_rows")

INSIGHT_ANSWERS = _answers("insight", [
    _fenced(_text('{"severity": "high", "likely_issues": ["a", "b"], "recommendation": "look"}')),
    _text('{"severity": "low"}'),
    _text("nothing to say"),
    _text("[]"),
])

SIGNAL_ANSWERS = _answers("profiler", [
    _fenced(_text(
        '[{"metric": "bler_dl", "value": 1.5, "baseline": 1.0, "delta_pct": 50.0, "dir": "up"}, '
        '{"metric": "cqi_dl", "value": "9", "baseline": 12, "delta_pct": -25, "dir": "down"}]')),
    _text('[{"metric": "bler_dl", "value": 1.5}, '
          '{"metric": "prb_dl", "value": 60, "baseline": 40, "delta_pct": 50, "dir": "up"}]'),
    _text('[{"metric": "bler_dl", "value": "abc", "baseline": 1.0, "delta_pct": 50.0, "dir": "up"}]'),
    _text("[]"),
    _text('{"metric": "bler_dl"}'),
    _text("none"),
])

DIAGNOSIS_ANSWERS = _answers("rca", [
    _fenced(_text('{"primary_cause": "interference", "confidence": 0.9, "evidence": ["a", "b"], '
                  '"secondary": [{"cause": "high_load", "confidence": 0.2, "evidence": []}]}')),
    _text('{"primary_cause": "aliens", "confidence": 1.7}'),
    _text('{"confidence": "0.65", "evidence": ["x"]}'),
    _text('{"primary_cause": "high_load", "confidence": null}'),
    _text('{"primary_cause": "high_load", "evidence": null, "secondary": null}'),
    _text("unsure"),
])

PLAN_ANSWERS = _answers("planner", [
    _fenced("concat(" + _text('{"actions": [{"id": "scheduler_protection", "params": {"cell": "')
            + ", cell_name, "
            + _text('", "on": "true"}, "reversible": false, "rationale": "r1"}, '
                    '{"id": "reboot_everything", "params": {}}, {"id": "check_backhaul", "params": {"cell": "')
            + ", cell_name, "
            + _text('"}}], "prechecks": ["p1"], "postchecks": ["q1", "q2"], '
                    '"sla": {"verify_minutes": 30, "success_criteria": "ok"}}') + ")"),
    _text('{"actions": [{"id": "limit_tx_power", "params": {"cell": "CELL_1", "preset": "low"}}, '
          '{"id": "tilt_neighbor", "params": {"neighbor": "AUTO", "delta_db": "2"}}]}'),
    _text('{"actions": [{"id": "reboot_everything", "params": {}}]}'),
    _text("cannot plan"),
    _text('{"actions": [{"id": "tilt_neighbor", "params": {"neighbor": "CELL_2"}}, '
          '{"id": "raise_prb_cap", "params": {"cell": "CELL_3", "delta": "5"}}], "sla": null}'),
])

EXECUTION_ANSWERS = _answers("executor", [
    _fenced(_text('{"executed": [{"id": "check_backhaul", "status": "applied", "params": {"cell": "CELL_1"}, '
                  '"method": "ticket", "reason": "ok"}, {"id": "limit_tx_power", "status": "refused"}], "status": "partial", '
                  '"mode": "production", "safety_checks": {"blast_radius_ok": true, "prechecks_passed": false, '
                  '"change_window_ok": true}}')),
    _text('{"executed": [], "status": "failed", "safety_checks": {"blast_radius_ok": false}}'),
    _text("failed"),
    _text("[]"),
])

LEARNING_ANSWERS = _answers("curator", [
    _fenced(_text('{"case_id": 1, "pattern": {"fingerprint_signature": ["bler_dl", "cqi_dl"], '
                  '"cause_pattern": "interference", "context": "busy hour"}, "solution": {"actions_taken": [{"action": '
                  '"tilt_neighbor", "params": {"neighbor": "CELL_2"}, "risk": "low"}, {"action": "check_backhaul"}], '
                  '"outcome": "success", "success_factors": ["early", "small"]}, "learning": {"confidence": 0.8, '
                  '"what_worked": "tilt", "what_failed": "none", "applicability": "edge cells"}, '
                  '"citation": "c1", "similarity_keys": ["bler", "edge"]}')),
    _text('{"case_id": 1, "pattern": {}, "solution": {}, "learning": {}}'),
    _text("no"),
    _text('{"case_id": 2, "pattern": {"cause_pattern": "high_load"}, "solution": {}, "learning": {}, "citation": null}'),
])

ANSWERS = {
    "verdicts": VERDICTS,
    "quality_answers": QUALITY_ANSWERS,
    "insight_answers": INSIGHT_ANSWERS,
    "signal_answers": SIGNAL_ANSWERS,
    "diagnosis_answers": DIAGNOSIS_ANSWERS,
    "plan_answers": PLAN_ANSWERS,
    "execution_answers": EXECUTION_ANSWERS,
    "learning_answers": LEARNING_ANSWERS,
}
# A stand-in score for operators that work on any scored table.
SCORED = """
SELECT *, CASE WHEN probability > 5e-1 THEN 1 ELSE 0 END AS prediction
FROM (
  SELECT *, CASE WHEN is_anomaly THEN ((event_id * 37) % 60) * 1e-2 + 3e-1
                 ELSE ((event_id * 53) % 60) * 1e-2 END AS probability
  FROM {kpi}) s
"""
ON_KPI = {"scored": SCORED, "kpi_dirty": KPI_DIRTY, "proposals": PROPOSALS, "learnings": LEARNINGS, **ANSWERS}


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def kpi_view(spark: SparkSession, directory: str) -> DataFrame:
    """KPI samples derived from the event table."""
    return spark.sql(KPI, events=spread(table(spark, directory, "events")))


def view(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Any other derived view, see :data:`ON_KPI`."""
    return spark.sql(ON_KPI[name], kpi=kpi_view(spark, directory))


def as_sql(name: str) -> str:
    """The text of a view for another engine; reads ``events`` or a CTE ``kpi``."""
    return KPI.format(events="events") if name == "kpi" else ON_KPI[name].format(kpi="kpi")
