"""Checking model answers that arrive as a table ``(case_id, agent, text)``.

Each check yields one typed row per answer and says whether it holds, or why
not.  Row-local JSON work only: no shuffle apart from the join that puts an
answer next to its rule-based counterpart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.functions import json_text as J


def parsed(responses: DataFrame, mode: str = "object", text: str = "text") -> DataFrame:
    """Adds ``json``: the answer's JSON as a variant, NULL when it does not parse."""
    return responses.withColumn("json", F.try_parse_json(J.extract_json(text, mode)))


def of_agent(responses: DataFrame, agent: str) -> DataFrame:
    return responses.filter(F.col("agent") == agent)


def quality_response(responses: DataFrame, n_rows: str = "n_rows", case: str = "case_id") -> DataFrame:
    """Quality struct of an answer.

    ``valid`` answers without a ``quality`` key get the default record; invalid
    ones are left to the rule result (see :func:`coalesce_response`).
    """
    df = parsed(responses, "any_fence")
    q = J.field(F.col("json"), "$.quality", "variant")
    is_object = F.coalesce(J.kind(F.col("json")) == "OBJECT", F.lit(False))
    default = F.struct(
        F.col(n_rows).cast("bigint").alias("n_rows"),
        F.lit(0.0).alias("missing_pct"),
        E.lit_array([fv.ISSUE_BAD_RESPONSE]).alias("issues"),
        F.lit(fv.UNKNOWN).alias("severity"),
    )
    given = F.struct(
        J.number(q, "$.rows").cast("bigint").alias("n_rows"),
        J.number(q, "$.missing_pct").alias("missing_pct"),
        J.field(q, "$.issues", "array<string>").alias("issues"),
        J.field(q, "$.severity", "string").alias("severity"),
    )
    return df.select(
        case,
        is_object.alias("valid"),
        F.when(is_object, F.when(q.isNull(), default).otherwise(given)).alias("quality"),
    )


def insight_response(responses: DataFrame, case: str = "case_id") -> DataFrame:
    """Status, severity, likely issues and recommendation of an insight answer."""
    json = F.col("json")
    ok = F.coalesce(J.kind(json) == "OBJECT", F.lit(False))
    return parsed(responses).select(
        case,
        F.when(ok, "success").otherwise("error").alias("status"),
        F.when(ok, J.field(json, "$.severity", "string")).alias("severity"),
        F.when(ok, J.field(json, "$.likely_issues", "array<string>")).alias("likely_issues"),
        F.when(ok, J.field(json, "$.recommendation", "string")).alias("recommendation"),
    )


def signal_response(responses: DataFrame, k: int = fv.TOP_SIGNALS, case: str = "case_id") -> DataFrame:
    """Signal list of an answer: items among the first k that hold all five keys.

    One number that does not convert spoils the whole list; so does an empty
    result.  Spoiled lists are NULL and fall back to the rule result.
    """
    items = F.slice(J.field(F.col("json"), "$", "array<variant>"), 1, k)
    complete = F.filter(items, lambda s: F.coalesce(J.has_keys(s, fv.REQUIRED_SIGNAL_KEYS), F.lit(False)))
    signals = F.transform(
        complete,
        lambda s: F.struct(
            J.field(s, "$.metric", "string").alias("metric"),
            J.number(s, "$.value").alias("value"),
            J.number(s, "$.baseline").alias("baseline"),
            J.number(s, "$.delta_pct").alias("delta_pct"),
            J.field(s, "$.dir", "string").alias("dir"),
        ),
    )
    spoiled = F.exists(
        "_signals", lambda s: s["value"].isNull() | s["baseline"].isNull() | s["delta_pct"].isNull()
    )
    usable = (F.size("_signals") > 0) & ~spoiled
    return parsed(responses, "array").withColumn("_signals", signals).select(
        case,
        F.coalesce(usable, F.lit(False)).alias("valid"),
        F.when(usable, F.col("_signals")).alias("signals"),
    )


def diagnosis_response(responses: DataFrame, case: str = "case_id") -> DataFrame:
    """Cause, confidence and evidence of an answer; unknown causes become inconclusive.

    The confidence is taken as given, without clamping.  Lists that are absent are empty; a
    JSON null stays NULL.
    """
    json = F.col("json")
    cause = J.field(json, "$.primary_cause", "string")
    given = J.field(json, "$.confidence", "variant")
    confidence = F.when(given.isNull(), F.lit(0.5)).otherwise(J.number(json, "$.confidence"))
    ok = F.coalesce((J.kind(json) == "OBJECT") & confidence.isNotNull(), F.lit(False))
    secondary = "array<struct<cause:string,confidence:double,evidence:array<string>>>"
    return parsed(responses).select(
        case,
        ok.alias("valid"),
        F.when(
            ok,
            F.struct(
                F.when(cause.isin(list(fv.CAUSE_CONFIDENCE)), cause)
                .otherwise("inconclusive").alias("primary_cause"),
                confidence.alias("confidence"),
                J.present_or(json, "$.evidence", "array<string>", E.lit_array([])).alias("evidence"),
                J.present_or(json, "$.secondary", secondary, F.array().cast(secondary)).alias("secondary"),
            ),
        ).alias("rca"),
    )


_SAFETY = "struct<blast_radius_ok:boolean,prechecks_passed:boolean,change_window_ok:boolean>"


def execution_response(responses: DataFrame, actions: Column | str | None = None, case: str = "case_id") -> DataFrame:
    """Execution record of an answer; any JSON counts.

    Without valid JSON the record is the plan's own action list, marked applied
    and simulated.  ``actions`` names an array column of ``struct<id, params>``.
    """
    json = F.col("json")
    item = "array<struct<id:string,status:string,params:map<string,string>,method:string,reason:string>>"
    given = F.struct(
        F.coalesce(J.field(json, "$.executed", item), F.array().cast(item)).alias("executed"),
        J.field(json, "$.status", "string").alias("status"),
        J.field(json, "$.mode", "string").alias("mode"),
        J.field(json, "$.safety_checks", _SAFETY).alias("safety_checks"),
    )
    planned = F.array().cast(item) if actions is None else F.transform(
        E.col(actions),
        lambda a: F.struct(
            a["id"].alias("id"),
            F.lit("applied").alias("status"),
            a["params"].alias("params"),
            F.lit("simulated").alias("method"),
            F.lit(None).cast("string").alias("reason"),
        ),
    )
    fallback = F.struct(planned.alias("executed"), F.lit("ok").alias("status"), F.lit("simulated").alias("mode"),
                        F.lit(None).cast(_SAFETY).alias("safety_checks"))
    return parsed(responses).select(
        case,
        json.isNotNull().alias("valid"),
        F.when(json.isNotNull(), given).otherwise(fallback).alias("execution"),
    )


def verdict_response(responses: DataFrame, case: str = "case_id") -> DataFrame:
    """Verdict of an answer; needs ``closed`` and ``checks``, there is no fallback."""
    json = F.col("json")
    complete = F.coalesce(J.has_keys(json, fv.REQUIRED_VERDICT_KEYS), F.lit(False))
    checks = "array<struct<postcheck:string,ok:boolean,evidence:string>>"
    improvements = F.transform_values(
        J.field(json, "$.kpi_improvements", "map<string,variant>"),
        lambda _, v: F.struct(
            J.number(v, "$.before").alias("before"), J.number(v, "$.after").alias("after"),
            J.number(v, "$.change_pct").alias("change_pct"), J.field(v, "$.improved", "boolean").alias("improved"),
        ),
    )
    return parsed(responses).select(
        case,
        complete.alias("valid"),
        F.when(complete, J.truthy(json, "$.closed")).alias("closed"),
        F.when(complete, J.field(json, "$.checks", checks)).alias("checks"),
        F.when(complete, J.field(json, "$.residual_risk", "string")).alias("residual_risk"),
        F.when(complete, improvements).alias("kpi_improvements"),
        F.when(complete, J.field(json, "$.overall_assessment", "string")).alias("overall_assessment"),
        F.when(complete, "llm").alias("mode"),
        F.when(json.isNull(), "not JSON").when(~complete, "missing required fields").alias("error"),
    )


def learning_response(responses: DataFrame, case: str = "case_id") -> DataFrame:
    """Learning of an answer holding all five required keys; others are marked invalid."""
    json = F.col("json")
    complete = F.coalesce(J.has_keys(json, fv.REQUIRED_LEARNING_KEYS), F.lit(False))
    taken = F.transform(
        J.field(json, "$.solution.actions_taken", "array<variant>"),
        lambda a: F.struct(
            J.field(a, "$.action", "string").alias("action"),
            J.field(a, "$.params", "map<string,string>").alias("params"),
            J.field(a, "$.risk", "string").alias("risk"),
        ),
    )
    fields = {
        "signature": J.field(json, "$.pattern.fingerprint_signature", "array<string>"),
        "cause_pattern": J.field(json, "$.pattern.cause_pattern", "string"),
        "citation": J.field(json, "$.citation", "string"),
        "confidence": J.number(json, "$.learning.confidence"),
        "context": J.field(json, "$.pattern.context", "string"),
        "actions_taken": taken,
        "outcome": J.field(json, "$.solution.outcome", "string"),
        "success_factors": J.field(json, "$.solution.success_factors", "array<string>"),
        "what_worked": J.field(json, "$.learning.what_worked", "string"),
        "what_failed": J.field(json, "$.learning.what_failed", "string"),
        "applicability": J.field(json, "$.learning.applicability", "string"),
        "similarity_keys": J.field(json, "$.similarity_keys", "array<string>"),
    }
    # the check is made once per answer, not once per field
    checked = parsed(responses).withColumn("_complete", complete)
    return checked.select(
        case, F.col("_complete").alias("valid"), *[F.when(F.col("_complete"), value).alias(name) for name, value in fields.items()]
    )


def coalesce_response(rule: DataFrame, answers: DataFrame, result: str, case: str = "case_id") -> DataFrame:
    """The checked answer where there is a valid one, the rule result elsewhere.

    Both tables hold ``result`` as a struct or array of the same type.
    """
    checked = answers.filter("valid").select(case, F.col(result).alias("_answer"))
    same_type = rule.schema[result].dataType.simpleString()
    return (
        rule.join(checked, case, "left")
        .withColumn("source", F.when(F.col("_answer").isNotNull(), "answer").otherwise("rule"))
        .withColumn(result, F.coalesce(F.col("_answer").cast(same_type), F.col(result)))
        .drop("_answer")
    )
