"""Case memory: append cases, keep checked learnings, look up what helped before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.operators import knowledge, responses
from kpiloom.session import stage
from kpiloom.sources import sinks


def remember(cases: DataFrame, history_path: str, order: list[str], run: str | None = None) -> bool:
    """Append to the history table with running ids, once per run key; False if the run is there already."""
    return sinks.record_cases(cases, history_path, order, run=run)


def learnings_from(answers: DataFrame, case: str = "case_id") -> DataFrame:
    """Valid learnings only; their case id is the insertion order."""
    checked = responses.learning_response(answers, case).filter("valid")
    return checked.select(
        F.col(case).alias("learning_id"), "signature", "cause_pattern", "citation", "confidence"
    )


def recall(cases: DataFrame, learnings: DataFrame, k: int = 3) -> tuple[DataFrame, DataFrame]:
    """Similar learnings and recommendations for cases with ``fingerprint`` and ``rca``."""
    learnings = stage(learnings, "learnings")  # read by both
    signals = cases.select(
        "case_id",
        F.transform("fingerprint", lambda s: s["metric"]).alias("signals"),
        F.col("rca.primary_cause").alias("cause"),
    )
    similar = stage(knowledge.similar_cases(signals, learnings, k), "similar")
    return similar, knowledge.recommendations(similar, learnings, written=True)
