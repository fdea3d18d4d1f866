"""Inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiloom import fixed_values as fv
from kpiloom.operators import cases, features, fingerprint
from kpiloom.session import stage
from kpiloom.sources import views

SIX_HOURS = 6 * 3600


def kpi_r(spark: SparkSession, d: str) -> DataFrame:
    return features.add_ratio(views.kpi_view(spark, d))


def baselines(spark: SparkSession, d: str) -> DataFrame:
    return stage(features.entity_baselines(kpi_r(spark, d), fv.KPIS), "baselines")


def incidents(spark: SparkSession, d: str) -> DataFrame:
    return cases.incident_slots(kpi_r(spark, d))


def batches(spark: SparkSession, d: str, seconds: int = SIX_HOURS) -> DataFrame:
    return cases.lookback_batch(cases.as_cases(incidents(spark, d)), kpi_r(spark, d), seconds)


def anomalies_profiled(spark: SparkSession, d: str) -> DataFrame:
    rows = features.anomalies(kpi_r(spark, d))
    return fingerprint.fingerprint(rows, baselines(spark, d))
