"""The whole run on the smallest table, with and without answers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from kpiloom.plans import case_memory, incident_run
from kpiloom.sources import views
from tests.conftest import table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def full_run(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    names = {"quality": "quality_answers", "profiler": "signal_answers", "rca": "diagnosis_answers",
             "planner": "plan_answers", "executor": "execution_answers", "verifier": "verdicts"}
    answers = {a: views.view(spark, SMALL, n).select("case_id", "text") for a, n in names.items()}
    run = incident_run.run_incidents(
        views.kpi_view(spark, SMALL), answers, num_cases=12, out=out, trees=6, max_depth=6, attribute=True)
    return run, out


def test_artifacts(spark, full_run):
    run, out = full_run
    assert {"detector", "baselines", "cases"} <= set(os.listdir(out))
    stored = spark.read.json(f"{out}/cases")
    assert stored.count() == run.cases.count()
    first = json.loads(spark.read.text(f"{out}/cases").first()[0])
    assert {"case_id", "cell_name", "t0", "quality", "detection", "fingerprint", "rca", "plan", "execution"} <= set(first)


def test_cases(full_run):
    run, _ = full_run
    rows = run.cases.collect()
    assert 0 < len(rows) <= 12 and len(run.features) == 24
    for r in rows:
        kind = r["case_id"] % 6
        assert r["detection"]["is_anomaly_any"] and 0 <= r["detection"]["max_probability"] <= 1
        attributed = [s for s in r["fingerprint"] if s["type"] == "shap"]
        assert len(attributed) == 5
        if kind in (0, 1):  # usable signal answers
            assert len(r["fingerprint"]) - 5 == (2 if kind == 0 else 1)
        if kind == 1:
            assert (r["rca"]["primary_cause"], r["rca"]["confidence"]) == ("inconclusive", 1.7)
        if kind in (3, 5):  # rule diagnosis, with its drivers
            assert r["rca"]["evidence"][-1].startswith("SHAP top drivers: " + attributed[0]["metric"])
        assert (r["plan"] is None) == (r["plan_error"] is not None) == (r["case_id"] % 5 in (2, 3))
        assert r["quality"]["severity"] == {0: "medium", 1: "low", 2: "unknown"}.get(r["case_id"] % 5, "low")
    closure, causes = incident_run.summarize(run.cases)
    assert closure.first()["total_cases"] == len(rows) == sum(r["n_cases"] for r in causes.collect())
    assert run.verification.groupBy("case_id").count().filter("count <> 6").count() == 0
    scores = {r["class"]: r["score"] for r in run.metrics.collect()}
    assert scores["roc_auc"] > 0.9


def test_run_without_answers(spark):
    run = incident_run.run_incidents(views.kpi_view(spark, SMALL), trees=3, max_depth=3, num_cases=5)
    assert run.cases.columns == ["case_id", "cell_name", "t0", "quality", "detection", "fingerprint", "rca"]
    assert incident_run.summarize(run.cases)[0].first()["closed_cases"] == 0


def test_memory(spark, full_run, tmp_path):
    run, _ = full_run
    path = str(tmp_path / "history")
    case_memory.remember(run.cases, path, ["cell_name", "t0", "case_id"])
    case_memory.remember(run.cases, path, ["cell_name", "t0", "case_id"])
    n = run.cases.count()
    assert table(spark.read.parquet(path), "record_id") == sorted(((i,) for i in range(1, 2 * n + 1)), key=repr)
    learned = case_memory.learnings_from(views.view(spark, SMALL, "learning_answers"))
    similar, texts = case_memory.recall(run.cases, learned)
    assert similar.filter("rank > 3 OR score <= 0.3").count() == 0
    assert texts.filter(~F.col("recommendation").endswith("%)")).count() == 0
