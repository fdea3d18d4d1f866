"""Registry of named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.sources import views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

_D = fv.FINGERPRINT_METRICS


def _delta(metric: str) -> str:
    return (
        f"CASE WHEN s.{metric} IS NOT NULL AND b.{metric} IS NOT NULL AND b.{metric} <> 0 "
        f"THEN (s.{metric} - b.{metric}) / (b.{metric} + 1e-9) * 1e2 END"
    )


# Common table expressions the check SQL may start with; each may read earlier ones.
CTES = {
    "kpi": views.as_sql("kpi"),
    "kpi_r": "SELECT *, rrc_succ / nullif(rrc_att, 0) AS rrc_rate FROM kpi",
    "base": "SELECT cell_name, "
    + ", ".join(f"median({c}) AS {c}" for c in fv.KPIS)
    + " FROM kpi_r WHERE NOT is_anomaly AND cell_name IS NOT NULL GROUP BY cell_name",
    "dev": "SELECT s.event_id, s.cell_name, s.ts, s.is_anomaly, "
    + ", ".join(f"s.{m}, b.{m} AS base_{m}, {_delta(m)} AS d_{m}" for m in _D)
    + " FROM kpi_r s LEFT JOIN base b ON s.cell_name = b.cell_name",
    "incidents": "SELECT * EXCLUDE (rn) FROM (SELECT *, "
    "row_number() OVER (PARTITION BY cell_name, slot ORDER BY ts, event_id) AS rn FROM (SELECT *, "
    "make_timestamp((epoch_us(ts) // 900000000) * 900000000) AS slot FROM kpi_r WHERE is_anomaly) x) y WHERE rn = 1",
    "back": "SELECT c.event_id AS case_id, c.ts AS t0, s.* FROM incidents c JOIN kpi_r s "
    "ON s.cell_name = c.cell_name AND s.ts BETWEEN c.ts - INTERVAL 6 HOUR AND c.ts",
    "ahead": "SELECT c.event_id AS case_id, s.* FROM incidents c JOIN kpi_r s "
    "ON s.cell_name = c.cell_name AND s.ts BETWEEN c.ts AND c.ts + INTERVAL 6 HOUR",
    "before_r": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY case_id "
    "ORDER BY ts DESC, event_id DESC) AS rn FROM back) x WHERE rn = 1",
    "after_r": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY case_id "
    "ORDER BY ts DESC, event_id DESC) AS rn FROM ahead) x WHERE rn = 1",
    "long_dev": " UNION ALL ".join(
        f"SELECT event_id, cell_name, is_anomaly, {i} AS ord, '{m}' AS metric, {m} AS value, base_{m} AS baseline, "
        f"d_{m} AS delta_pct FROM dev WHERE d_{m} IS NOT NULL"
        for i, m in enumerate(_D)
    ),
    "cause": "SELECT event_id, cell_name, ts, CASE "
    "WHEN bler > 30 AND cqi < -20 AND NOT prb > 25 THEN 'interference' "
    "WHEN prb > 25 AND thp < -20 THEN 'high_load' "
    "WHEN rrc < -10 THEN 'connection_failure' "
    "WHEN eff < -20 OR pow > 10 THEN 'power_anomaly' "
    "WHEN thp < -20 AND NOT prb > 25 THEN 'low_throughput' ELSE 'inconclusive' END AS primary_cause, "
    "bler, cqi, prb, thp, rrc, eff, pow FROM (SELECT event_id, cell_name, ts, coalesce(d_bler_dl, 0) AS bler, "
    "coalesce(d_cqi_dl, 0) AS cqi, coalesce(d_prb_dl, 0) AS prb, coalesce(d_thp_dl, 0) AS thp, "
    "coalesce(d_rrc_rate, 0) AS rrc, coalesce(d_energy_eff, 0) AS eff, coalesce(d_avg_power, 0) AS pow "
    "FROM dev WHERE is_anomaly) d",
    "conf": "SELECT *, CASE primary_cause WHEN 'interference' THEN 8e-1 WHEN 'high_load' THEN 7.5e-1 "
    "WHEN 'connection_failure' THEN 7e-1 WHEN 'power_anomaly' THEN 7e-1 WHEN 'low_throughput' THEN 6.5e-1 "
    "ELSE 5e-1 END AS confidence FROM cause",
    "whitelist": "SELECT * FROM (VALUES "
    + ", ".join(f"('{a[0]}', {str(a[2]).lower()}, '{a[3]}')" for a in fv.ACTIONS)
    + ") w(action_id, reversible, risk)",
    **{name: views.as_sql(name) for name in views.ON_KPI},
}

_NEEDS = {
    "kpi_r": ["kpi"], "base": ["kpi_r"], "dev": ["base"], "incidents": ["kpi_r"], "back": ["incidents"],
    "ahead": ["incidents"], "before_r": ["back"], "after_r": ["ahead"], "long_dev": ["dev"], "cause": ["dev"],
    "conf": ["cause"], **{name: ["kpi"] for name in views.ON_KPI},
}


def check_sql(body: str, *needs: str, **more: str) -> str:
    """``body`` behind the named common table expressions and those they read."""
    wanted: list[str] = []

    def want(name: str) -> None:
        for other in _NEEDS.get(name, []):
            want(other)
        if name not in wanted:
            wanted.append(name)

    for name in needs:
        want(name)
    ctes = [f"{n} AS ({CTES[n]})" for n in wanted] + [f"{n} AS ({t})" for n, t in more.items()]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def body_sql(text: str, mode: str = "object") -> str:
    """SQL counterpart of the JSON extraction from an answer text."""
    body = rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"
    opening, closing = (r"\[", r"\]") if mode == "array" else (r"\{", r"\}")
    tagged = rf"regexp_extract({body}, '(?s)```json\s*({opening}.*?{closing})\s*```', 1)"
    plain = rf"regexp_extract({body}, '(?s)```\s*({opening}.*?{closing})\s*```', 1)"
    if mode == "split":
        strip = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
        return (
            f"CASE WHEN contains({text}, '```json') THEN "
            + strip.format(f"split_part(split_part({text}, '```json', 2), '```', 1)")
            + f" WHEN contains({text}, '```') THEN " + strip.format(f"split_part({text}, '```', 2)")
            + f" ELSE {text} END"
        )
    untagged = f" WHEN NOT contains({body}, '```json') AND {plain} <> '' THEN {plain}" if mode == "any_fence" else ""
    return f"CASE WHEN {tagged} <> '' THEN {tagged}{untagged} ELSE {body} END"


def answers_sql(view: str, mode: str = "object") -> str:
    """Answers with ``j``: the JSON text, NULL when it does not parse."""
    return f"SELECT *, CASE WHEN json_valid(b) THEN b END AS j FROM (SELECT *, {body_sql('text', mode)} AS b FROM {view}) a"


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL it must agree with."""
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded so that summation order cannot show."""
    return df.select(
        *[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
          for f in df.schema.fields]
    )


def r(expression: str, alias: str | None = None, digits: int = 6) -> str:
    return f"round({expression}, {digits}) AS {alias or expression}"


def rs(columns: list[str]) -> str:
    return ", ".join(r(c) for c in columns)
