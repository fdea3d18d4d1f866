"""Remediation plans: allowed actions, plan assembly, risk order, blast radius."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.functions import json_text as J


def action_whitelist(spark: SparkSession) -> DataFrame:
    """The allowed remediation actions (a fixed table of eleven rows)."""
    return spark.createDataFrame(
        fv.ACTIONS,
        "action_id string, param_names array<string>, reversible boolean, risk string, description string",
    )


def validate_actions(proposals: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Proposals with an allowed id; ``reversible`` always comes from the whitelist."""
    allowed = whitelist.select("action_id", "reversible", "risk")
    kept = proposals.drop("reversible", "risk")
    return kept.join(F.broadcast(allowed), "action_id")


def rejected_actions(proposals: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Proposals whose id is missing or not allowed."""
    return proposals.join(F.broadcast(whitelist.select("action_id")), "action_id", "left_anti")


def invalid_plans(plans: DataFrame, proposals: DataFrame, whitelist: DataFrame, case: str = "case_id") -> DataFrame:
    """Plans left without any allowed action, with the reason."""
    valid = validate_actions(proposals, whitelist).select(case)
    return plans.join(valid, case, "left_anti").withColumn("error", F.lit("no valid actions proposed"))


def explode_actions(responses: DataFrame, case: str = "case_id") -> DataFrame:
    """Proposals of plan responses in order: case, position, id, parameter map, rationale."""
    parsed = responses.withColumn("_json", F.try_parse_json(J.extract_json("text", "object")))
    actions = J.field(F.col("_json"), "$.actions", "array<variant>")
    return parsed.select(case, F.posexplode(actions).alias("_pos", "_action")).select(
        case,
        (F.col("_pos") + 1).alias("pos"),
        J.field(F.col("_action"), "$.id", "string").alias("action_id"),
        J.field(F.col("_action"), "$.params", "map<string,string>").alias("params"),
        J.field(F.col("_action"), "$.rationale", "string").alias("rationale"),
    )


def _strings_or(json: Column, path: str, default: list[str]) -> Column:
    """Array of strings at a path; the default only for an absent key."""
    absent = J.field(json, path, "variant").isNull()
    return F.when(absent, E.lit_array(default)).otherwise(J.field(json, path, "array<string>"))


def assemble_plans(responses: DataFrame, case: str = "case_id") -> DataFrame:
    """One validated plan per usable response: kept actions in order, checks and SLA.

    Runs inside each row: the whitelist is a fixed constant, so ids are looked up
    in a literal map and no exploded action has to find its way back to its plan.
    """
    parsed = responses.withColumn("_json", F.try_parse_json(J.extract_json("text", "object")))
    json = F.col("_json")
    reversible = F.create_map(*[x for a in fv.ACTIONS for x in (F.lit(a[0]), F.lit(a[2]))])
    actions = F.coalesce(
        J.field(json, "$.actions", "array<variant>"), F.array().cast("array<variant>")
    )

    def action_id(a: Column) -> Column:
        return J.field(a, "$.id", "string")

    def built(a: Column) -> Column:
        return F.struct(
            action_id(a).alias("id"),
            J.field(a, "$.params", "map<string,string>").alias("params"),
            F.try_element_at(reversible, action_id(a)).alias("reversible"),
            J.field(a, "$.rationale", "string").alias("rationale"),
        )

    kept = F.transform(
        F.filter(actions, lambda a: F.coalesce(action_id(a).isin([a[0] for a in fv.ACTIONS]), F.lit(False))), built
    )
    sla_absent = J.field(json, "$.sla", "variant").isNull()
    plan = F.struct(
        kept.alias("actions"),
        _strings_or(json, "$.prechecks", fv.DEFAULT_PRECHECKS).alias("prechecks"),
        _strings_or(json, "$.postchecks", []).alias("postchecks"),
        F.struct(
            F.when(sla_absent, F.lit(fv.DEFAULT_SLA_MINUTES).cast("double"))
            .otherwise(J.number(json, "$.sla.verify_minutes")).alias("verify_minutes"),
            F.when(sla_absent, F.lit(fv.DEFAULT_SLA_CRITERIA))
            .otherwise(J.field(json, "$.sla.success_criteria", "string")).alias("success_criteria"),
        ).alias("sla"),
    )
    error = (
        F.when(json.isNull() | (J.kind(json) != "OBJECT"), "not a JSON object")
        .when(F.size("plan.actions") == 0, "no valid actions proposed")
    )
    return parsed.withColumn("plan", plan).select(case, "plan", error.alias("error"))


def plan_risk_order(actions: DataFrame, whitelist: DataFrame, case: str = "case_id", pos: str = "pos") -> DataFrame:
    """Per case: number of allowed actions, and whether risk ever falls along the plan.

    Reports only; nothing is dropped.
    """
    levels = sorted(fv.RISK_RANK, key=fv.RISK_RANK.get)
    first = {r: F.min(F.when(F.col("risk") == r, F.col(pos))) for r in levels}
    last = {r: F.max(F.when(F.col("risk") == r, F.col(pos))) for r in levels}
    # Risk falls somewhere exactly when a riskier action precedes a less risky one.
    falls = [first[high] < last[low] for i, low in enumerate(levels) for high in levels[i + 1 :]]
    return (
        validate_actions(actions, whitelist)
        .groupBy(case)
        .agg(
            F.count(F.lit(1)).alias("n_actions"),
            reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in falls]).alias("risk_order_broken"),
        )
        .withColumn("too_many_actions", F.col("n_actions") > fv.MAX_PLAN_ACTIONS)
    )


def blast_radius(actions: DataFrame, max_cells: int = fv.MAX_BLAST_RADIUS, case: str = "case_id",
                 params: str = "params") -> DataFrame:
    """Per case: distinct cells its actions touch, and whether that is within the limit.

    ``cell`` counts always, ``neighbor`` unless it is AUTO; other parameters do not.
    """
    p = F.col(params)
    neighbor = F.when(p["neighbor"] != "AUTO", p["neighbor"])
    touched = actions.select(case, F.explode(F.array(p["cell"], neighbor)).alias("_cell"))
    return (
        touched.groupBy(case)
        .agg(F.count_distinct("_cell").alias("n_cells"))
        .withColumn("blast_radius_ok", F.col("n_cells") <= max_cells)
    )
