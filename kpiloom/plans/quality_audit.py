"""Full quality analysis of a table, and its cleaned form."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from kpiloom.operators import quality


@dataclass
class QualityAudit:
    score: DataFrame
    missing: DataFrame
    missing_columns: DataFrame
    types: DataFrame
    outliers: DataFrame
    cleaned: DataFrame
    summary: DataFrame


def audit(df: DataFrame, threshold: float = 3.0, columns: list[str] | None = None) -> QualityAudit:
    """All reports are lazy; the outlier bounds take two small jobs up front."""
    return QualityAudit(
        score=quality.quality_score(df),
        missing=quality.missing_overview(df),
        missing_columns=quality.missing_by_column(df),
        types=quality.dtype_report(df),
        outliers=quality.outlier_report(df, columns, threshold),
        cleaned=quality.clean(df),
        summary=quality.clean_summary(df),
    )
