"""Case memory: summaries, similar past cases, recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.operators.features import first_per_group
from kpiloom.session import broadcast_if_small, stage


def case_summary(cases: DataFrame, entity: str = "cell_name", ts: str = "t0") -> DataFrame:
    """What is kept of a case: signals, cause, actions, execution and outcome, with defaults.

    Needs ``case_id``, the entity and time, and the nested columns
    ``fingerprint``, ``rca``, ``plan``, ``execution``, ``closed``, ``residual_risk``.
    """
    rca, plan, run = F.col("rca"), F.col("plan"), F.col("execution")
    actions = F.transform(
        F.slice(plan["actions"], 1, 3), lambda a: F.struct(a["id"].alias("id"), a["params"].alias("params"))
    )
    return cases.select(
        "case_id",
        F.coalesce(F.col(entity), F.lit(fv.UNKNOWN)).alias("cell"),
        F.coalesce(F.col(ts).cast("string"), F.lit(fv.UNKNOWN)).alias("time"),
        F.slice("fingerprint", 1, 5).alias("fingerprint"),
        F.struct(
            F.coalesce(rca["primary_cause"], F.lit(fv.UNKNOWN)).alias("primary_cause"),
            F.coalesce(rca["confidence"], F.lit(0.0)).alias("confidence"),
        ).alias("rca"),
        F.struct(actions.alias("actions")).alias("plan"),
        F.struct(
            F.coalesce(run["status"], F.lit(fv.UNKNOWN)).alias("status"),
            F.coalesce(F.size(run["executed"]), F.lit(0)).alias("executed_count"),
        ).alias("execution"),
        F.struct(
            F.coalesce(F.col("closed"), F.lit(False)).alias("closed"),
            F.coalesce(F.col("residual_risk"), F.lit(fv.UNKNOWN)).alias("residual_risk"),
        ).alias("outcome"),
    )


#: A signal is common from so many learning shapes on.
HOT_POSTINGS = 1000


def similar_candidates(case_shapes: DataFrame, oldest: DataFrame, k: int, hot_postings: int | None = None) -> DataFrame:
    """Pairs of case shapes (``signals``, ``cause``) and learnings that share a signal, enough for the k best.

    ``oldest``: the k oldest learnings of each shape.  Both are written tables.
    """
    shapes = oldest.select("signature", "cause_pattern").distinct()
    postings = stage(
        shapes.select(F.explode("signature").alias("_signal"), "signature", "cause_pattern"), "postings"
    )
    counts = stage(postings.groupBy("_signal").agg(F.count(F.lit(1)).alias("_n")), "signal-counts")
    hot_postings = hot_postings or HOT_POSTINGS
    hot = stage(counts.filter(F.col("_n") > hot_postings).select("_signal"), "common-signals")

    # positions of a case's signals, rarest first; signals of no learning come first of all
    asked = (
        case_shapes.select("signals", "cause", F.explode("signals").alias("_signal"))
        .join(broadcast_if_small(counts), "_signal", "left")
        .withColumn("_n", F.coalesce("_n", F.lit(0)))
    )
    ranked = asked.groupBy("signals", "cause").agg(
        F.sort_array(F.collect_list(F.struct("_n", "_signal"))).alias("_ranked")
    )
    least_share = (fv.SIMILARITY_MIN_SCORE - fv.SIMILARITY_CAUSE_WEIGHT * fv.SIMILARITY_OTHER_CAUSE) / fv.SIMILARITY_OVERLAP_WEIGHT
    # more than this share must be met, so one of the others is (a hair less, for rounding)
    prefix = F.size("signals") - F.floor(F.size("signals") * F.lit(least_share - 1e-9)).cast("int")
    asked = ranked.select("signals", "cause", prefix.alias("_prefix"), F.posexplode("_ranked").alias("_pos", "_s")).select(
        "signals", "cause", "_s._signal", "_s._n", (F.col("_pos") < F.col("_prefix")).alias("_early")
    )
    rare = asked.filter(F.col("_n").between(1, hot_postings)).join(postings, "_signal").filter(
        F.col("_early") | F.col("cause").eqNullSafe(F.col("cause_pattern"))
    )
    by_rare = rare.select("signals", "cause", "signature", "cause_pattern").distinct().join(
        oldest, ["signature", "cause_pattern"]
    )
    if not hot.head(1):
        return by_rare.select("signals", "cause", "learning_id", "signature", "cause_pattern")

    def parts(table: DataFrame, of: str, *keys: str) -> DataFrame:
        """The common signals of each array, as a sorted part of it."""
        exploded = table.select(*keys, of, F.explode(of).alias("_signal")).join(broadcast_if_small(hot), "_signal", "left_semi")
        return exploded.groupBy(*keys, of).agg(F.sort_array(F.collect_list("_signal")).alias("_part"))

    case_parts = stage(parts(case_shapes, "signals", "cause"), "case-parts")
    learning_parts = stage(
        first_per_group(
            oldest.join(parts(shapes, "signature", "cause_pattern"), ["signature", "cause_pattern"]),
            ["_part", "cause_pattern"], ["learning_id"], k,
        ),
        "learning-parts",
    )
    met = (
        case_parts.select("_part").distinct().select(F.col("_part").alias("_asked"), F.explode("_part").alias("_signal"))
        .join(learning_parts.select("_part").distinct().select("_part", F.explode("_part").alias("_signal")), "_signal")
        .select("_asked", "_part").distinct()
    )
    by_common = (
        case_parts.withColumnRenamed("_part", "_asked").join(met, "_asked").join(learning_parts, "_part")
        .select("signals", "cause", "learning_id", "signature", "cause_pattern")
    )
    return by_rare.select(by_common.columns).unionByName(by_common)


def similar_cases(cases: DataFrame, learnings: DataFrame, k: int = 3) -> DataFrame:
    """The k most similar learnings of each case.

    ``cases``: case_id, signals (array), cause.  ``learnings``: learning_id
    (insertion order), signature (array), cause_pattern.

    score = 0.6 * |shared signals| / max(|case signals|, 1) + 0.4 * (1.0 for the
    same cause, else 0.3); kept when above 0.3; best first, older first on ties.

    The score depends on signals and cause alone, so both sides collapse to their
    distinct (signal set, cause) shapes, and only shapes are compared.  Learnings of
    one shape tie, so its k oldest stand for all of it.  Shapes meet in three ways:

    * by an index of the signals that stand in at most ``HOT_POSTINGS`` learning shapes.
      With another cause a score above the limit needs more than a certain share of the
      case's signals, so such a pair shares one of the rarest signals of the case, and
      only these (a prefix, rarest first) ask for other causes;
    * by signals more common than that, through the part of a shape that consists of them.
      Learnings with one such part and cause share the same common signals with any
      case, so if such a signal is all that a pair shares, one of the part's k oldest is
      as good: only distinct parts are paired;
    * with the same cause and no shared signal the score is one constant, so only the k
      oldest learnings of a cause can matter.
    """
    shape = F.sort_array(F.array_distinct(F.coalesce("signals", F.array().cast("array<string>"))))
    shaped_cases = cases.select("case_id", shape.alias("signals"), "cause")
    case_shapes = stage(shaped_cases.select("signals", "cause").distinct(), "case-shapes")
    signature = F.sort_array(F.array_distinct(F.coalesce("signature", F.array().cast("array<string>"))))
    oldest = stage(
        first_per_group(
            learnings.select(
                "learning_id", signature.alias("signature"), F.coalesce("cause_pattern", F.lit("")).alias("cause_pattern")
            ),
            ["signature", "cause_pattern"],
            ["learning_id"],
            k,
        ),
        "learning-shapes",
    )
    columns = ["signals", "cause", "learning_id", "signature", "cause_pattern"]
    candidates = similar_candidates(case_shapes, oldest, k).select(columns)
    oldest_of_cause = first_per_group(oldest, ["cause_pattern"], ["learning_id"], k)
    same_cause = case_shapes.join(oldest_of_cause, F.col("cause") == F.col("cause_pattern"))
    candidates = candidates.unionByName(same_cause.select(columns)).distinct()
    cause_match = F.when(F.col("cause_pattern") == F.col("cause"), 1.0).otherwise(fv.SIMILARITY_OTHER_CAUSE)
    score = (
        E.overlap_share("signals", "signature") * fv.SIMILARITY_OVERLAP_WEIGHT
        + cause_match * fv.SIMILARITY_CAUSE_WEIGHT
    )
    scored = candidates.withColumn("score", score).filter(F.col("score") > fv.SIMILARITY_MIN_SCORE)
    best = first_per_group(scored, ["signals", "cause"], [F.desc("score"), "learning_id"], k, out="rank")
    best = stage(best.select("signals", "cause", "rank", "learning_id", "score"), "best-learnings")
    same_shape = F.col("c.signals").eqNullSafe(F.col("b.signals")) & F.col("c.cause").eqNullSafe(F.col("b.cause"))
    return (
        shaped_cases.alias("c")
        .join(broadcast_if_small(best).alias("b"), same_shape)
        .select("c.case_id", "b.rank", "b.learning_id", "b.score")
    )


def recommendations(similar: DataFrame, learnings: DataFrame,
                    min_confidence: float = fv.RECOMMEND_MIN_CONFIDENCE, written: bool = False) -> DataFrame:
    """Citations of similar learnings that have one and are confident enough.

    ``similar`` is read twice: it is written first, unless it is a ``written`` table.

    A popular learning is a hot key of ``similar``, so the learnings in use (few:
    k per case shape) are gathered first and broadcast if that holds.
    """
    similar = similar if written else stage(similar, "similar")
    used = similar.select("learning_id").distinct()
    cited = learnings.filter(
        (F.coalesce(F.col("citation"), F.lit("")) != "") & (F.col("confidence") > min_confidence)
    ).select("learning_id", "citation", "confidence")
    text = F.concat("citation", F.lit(" (confidence: "), E.percent_text("confidence"), F.lit(")"))
    cited = stage(cited.join(used, "learning_id", "left_semi"), "cited")
    return similar.join(broadcast_if_small(cited), "learning_id").select("case_id", "rank", text.alias("recommendation"))
