import bisect
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.operators import cases, detect, diagnose, features, fingerprint, verify
from kpiloom.session import stage
from tests.conftest import table


def _samples(spark, rows):
    """rows: (event_id, cell, second, label)"""
    return spark.createDataFrame(rows, "event_id int, cell_name string, s int, is_anomaly boolean").withColumn(
        "ts", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)"))


@pytest.fixture(scope="module")
def busy(spark):
    """One cell holds most samples, many at equal times."""
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        cell = "HOT" if rng.random() < 0.7 else f"C{rng.randrange(5)}"
        rows.append((i, cell, rng.randrange(0, 7200) // 5 * 5, rng.random() < 0.2))
    rng.shuffle(rows)
    return rows


def test_first_per_slot_by_brute_force(spark, busy):
    want = {}
    for i, cell, s, bad in busy:
        if bad:
            key = (cell, s // 900)
            want[key] = min(want.get(key, (10**9, 0)), (s, i))
    got = cases.incident_slots(_samples(spark, busy))
    assert table(got, "event_id") == sorted(((i,) for _, i in want.values()), key=repr)
    first = cases.take_cases(got, 4).select("cell_name", "s", "event_id").collect()
    order = sorted((c, s, i) for (c, _), (s, i) in want.items())
    assert [tuple(r) for r in first] == order[:4]


@pytest.mark.parametrize("before,after", [(300, 0), (0, 900), (100, 50), (7200, 7200)])
def test_interval_join_by_brute_force(spark, busy, before, after):
    samples = _samples(spark, busy)
    found = cases.as_cases(samples.filter("is_anomaly AND event_id % 9 = 0"))
    times = {}
    for i, cell, s, _ in busy:
        times.setdefault(cell, []).append((s, i))
    want = []
    for case, cell, t0, bad in busy:
        if bad and case % 9 == 0:
            want += [(case, i) for s, i in times[cell] if t0 - before <= s <= t0 + after]
    assert table(cases.interval_join(found, samples, before, after), "case_id", "event_id") == sorted(want, key=repr)


def test_before_and_after_rows(spark, busy):
    samples = _samples(spark, busy)
    found = cases.as_cases(cases.incident_slots(samples))
    times = {}
    for i, cell, s, _ in busy:
        times.setdefault(cell, []).append((s, i))
    for v in times.values():
        v.sort()
    position = {i: (cell, s) for i, cell, s, _ in busy}

    def last(case, limit):
        cell, s = position[case]
        return times[cell][bisect.bisect_right(times[cell], (s + limit, 10**9)) - 1][1]

    before = cases.before_row(cases.lookback_batch(found, samples))
    for r in before.select("case_id", "event_id").collect():
        assert r["event_id"] == last(r["case_id"], 0)
    after = cases.after_row(found, samples)
    rows = after.select("case_id", "event_id").collect()
    assert len(rows) == found.count()
    for r in rows:
        assert r["event_id"] == last(r["case_id"], 900)


# ---- fingerprint and diagnosis -------------------------------------------------------------

def _baseline(spark, **values):
    base = {m: 100.0 for m in fv.FINGERPRINT_METRICS} | values
    return stage(spark.createDataFrame([("A", *base.values())], "cell_name string, " + ", ".join(f"{m} double" for m in base)))


def _row(spark, **values):
    row = {m: 100.0 for m in fv.FINGERPRINT_METRICS} | values
    return spark.createDataFrame([(1, "A", *row.values())], "case_id int, cell_name string, " + ", ".join(f"{m} double" for m in row))


def _names(df):
    return [s["metric"] for s in df.first()["fingerprint"]]


def test_ties_keep_metric_order_and_size_wins(spark):
    out = fingerprint.fingerprint(_row(spark, thp_dl=50.0, cqi_dl=150.0, avg_power=180.0), _baseline(spark))
    assert _names(out)[:3] == ["avg_power", "cqi_dl", "thp_dl"]
    assert len(_names(out)) == 7
    assert [s["dir"] for s in out.first()["fingerprint"]][:3] == ["up", "up", "down"]


def test_zero_or_missing_baseline_and_missing_value_are_skipped(spark):
    out = fingerprint.fingerprint(_row(spark, rrc_rate=None), _baseline(spark, cqi_dl=0.0, thp_dl=None))
    assert set(_names(out)) == set(fv.FINGERPRINT_METRICS) - {"rrc_rate", "cqi_dl", "thp_dl"}


def test_unknown_entity_gives_an_empty_fingerprint_and_no_verdict(spark):
    row = _row(spark).withColumn("cell_name", F.lit("B"))
    out = diagnose.diagnose(fingerprint.fingerprint(row, _baseline(spark)))
    assert out.first()["fingerprint"] == []
    rca = out.first()["rca"]
    assert (rca["primary_cause"], rca["confidence"], rca["evidence"], rca["secondary"]) == ("inconclusive", 0.5, [], [])


@pytest.mark.parametrize("change,cause,confidence", [
    (dict(bler_dl=140.0, cqi_dl=70.0), "interference", 0.8),
    (dict(bler_dl=140.0, cqi_dl=70.0, prb_dl=130.0, thp_dl=70.0), "high_load", 0.75),
    (dict(prb_dl=130.0, thp_dl=70.0, rrc_rate=50.0), "high_load", 0.75),
    (dict(rrc_rate=80.0, energy_eff=50.0), "connection_failure", 0.7),
    (dict(energy_eff=70.0), "power_anomaly", 0.7),
    (dict(avg_power=120.0, thp_dl=70.0), "power_anomaly", 0.7),
    (dict(thp_dl=70.0), "low_throughput", 0.65),
    (dict(thp_dl=81.0, prb_dl=124.0, rrc_rate=91.0), "inconclusive", 0.5),
])
def test_rules_in_order(spark, change, cause, confidence):
    base = _baseline(spark)
    rca = diagnose.diagnose(fingerprint.fingerprint(_row(spark, **change), base)).first()["rca"]
    assert (rca["primary_cause"], rca["confidence"]) == (cause, confidence)
    wide = diagnose.diagnose_wide(_row(spark, **change), base).first()
    assert (wide["primary_cause"], wide["confidence"]) == (cause, confidence)


def test_evidence_with_attributions(spark):
    contributions = {"a": F.lit(0.1), "b": F.lit(-0.4), "c": F.lit(0.2), "d": F.lit(None).cast("double"), "e": F.lit(0.0),
                     "f": F.lit(0.1), "g": F.lit(0.01)}
    out = diagnose.diagnose(fingerprint.fingerprint(_row(spark, avg_power=150.0), _baseline(spark), contributions)).first()
    attributed = [s for s in out["fingerprint"] if s["type"] == "shap"]
    assert [s["metric"] for s in attributed] == ["b", "c", "a", "f", "g"]
    assert [s["attr_dir"] for s in attributed] == ["negative", "positive", "positive", "positive", "positive"]
    # Power alone fired, yet the efficiency is quoted.
    assert out["rca"]["evidence"] == ["Energy efficiency down 0.0%", "SHAP top drivers: b, c, a"]


# ---- detection -----------------------------------------------------------------------------

def test_split_is_exact_stratified_and_order_free(spark):
    df = spark.range(1003).select(F.col("id").alias("event_id"), (F.col("id") % 7 == 0).alias("is_anomaly"))
    first = detect.stratified_split(df)
    sizes = {(r["is_anomaly"], r["is_test"]): r["n"] for r in first.groupBy("is_anomaly", "is_test").agg(F.count("*").alias("n")).collect()}
    for label, total in ((True, 144), (False, 859)):
        assert sizes[(label, True)] == int(total * 0.25 + 0.5)
    again = detect.stratified_split(df.orderBy(F.desc("event_id")).repartition(5))
    assert table(first, "event_id", "is_test") == table(again, "event_id", "is_test")


def test_split_of_tiny_classes(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, False)], "event_id int, is_anomaly boolean")
    out = detect.stratified_split(df)
    assert out.count() == 3 and out.filter("is_test").count() == 1


@pytest.mark.parametrize("values", ["few", "many", "outside"])
def test_auc_by_brute_force(spark, values):
    rng = random.Random(9)
    draw = {"few": lambda: rng.choice([0.0, 0.2, 0.5, 1.0]), "many": rng.random, "outside": lambda: rng.gauss(0, 3)}[values]
    rows = [(bool(rng.random() < 0.3), draw()) for _ in range(400)]
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    want = np.mean([1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg])
    df = spark.createDataFrame(rows, "is_anomaly boolean, probability double")
    assert detect.roc_auc(df).first()["roc_auc"] == pytest.approx(want)


@pytest.mark.parametrize("low, high", [(0.0, 1e-4), (5.0, 9.0), (-1e300, 1e300)])
def test_auc_ranges_follow_the_scores(spark, low, high):
    """Wherever the scores lie, ranges are even and counts are carried across them."""
    rng = random.Random(3)
    rows = [(bool(rng.random() < 0.3), low + (high / 2 - low / 2) * 2 * rng.random()) for _ in range(3000)]
    rows += [(True, low), (False, low), (False, high)] * 40
    df = spark.createDataFrame(rows, "is_anomaly boolean, probability double")
    scores = np.array([p for _, p in rows])
    order = scores.argsort()
    ranks = np.empty(len(rows))
    ranks[order] = np.arange(1, len(rows) + 1)
    for v in (low, high):
        ranks[scores == v] = ranks[scores == v].mean()
    y = np.array([y for y, _ in rows])
    want = (ranks[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    got = detect.roc_auc(df, range_scores=100).first()
    assert got["roc_auc"] == pytest.approx(want, abs=1e-12) and got["n_rows"] == len(rows)
    ranged = df.groupBy("probability").count().repartitionByRange(31, "probability")
    sizes = [r["n"] for r in ranged.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 2.5 * 3000 / 31


def test_auc_without_scores(spark):
    df = spark.createDataFrame([(None, 0.4), (True, None), (True, 0.5), (False, 0.1)], "is_anomaly boolean, probability double")
    assert tuple(detect.roc_auc(df).first()) == (1.0, 2)
    assert tuple(detect.roc_auc(df.where("probability > 7")).first()) == (None, 0)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(True, 0.4), (True, 0.6)], "is_anomaly boolean, probability double")
    assert detect.roc_auc(df).first()["roc_auc"] is None


def test_report_with_an_unpredicted_class(spark):
    df = spark.createDataFrame([(True, 0), (False, 0), (False, 0)], "is_anomaly boolean, prediction int")
    out = {r["class"]: r for r in detect.classification_report(df).collect()}
    assert (out["1"]["precision"], out["1"]["recall"], out["1"]["f1"], out["1"]["support"]) == (0.0, 0.0, 0.0, 1)
    assert out["accuracy"]["f1"] == pytest.approx(2 / 3)
    assert out["weighted avg"]["recall"] == pytest.approx(2 / 3)


def test_train_score_attribute_and_reload(spark, tmp_path):
    from kpiloom.sources import sinks

    df = spark.range(600).select(
        F.col("id").alias("event_id"), F.lit("A").alias("cell_name"), (F.col("id") % 5 == 0).alias("is_anomaly"),
        F.when(F.col("id") % 5 == 0, 9.0 + F.col("id") % 3).otherwise(1.0 + F.col("id") % 3).alias("x"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 13).cast("double")).alias("y"))
    base = stage(features.entity_baselines(df, ["x", "y"]))
    model = detect.train_detector(df, ["x", "y"], trees=8, max_depth=5)
    scored = detect.score(model, df, ["x", "y"])
    assert scored.count() == 600
    assert scored.filter("probability < 0 OR probability > 1 OR prediction NOT IN (0, 1)").count() == 0
    assert scored.filter("prediction = 1 AND probability <= 0.5").count() == 0
    assert detect.roc_auc(scored).first()["roc_auc"] > 0.99
    path = str(tmp_path / "m")
    sinks.save_model(model, path)
    again = detect.score(sinks.load_model(path), df, ["x", "y"])
    assert table(scored, "event_id", "probability") == table(again, "event_id", "probability")
    rows = df.filter("is_anomaly").withColumn("case_id", F.col("event_id"))
    moved = detect.occlusion_contributions(model, rows, ["x", "y"], base)
    assert moved.count() == 2 * 120
    mean = {r["feature"]: r["m"] for r in moved.groupBy("feature").agg(F.avg("contribution").alias("m")).collect()}
    assert mean["x"] > 0.5 > abs(mean["y"])
    wide = detect.attribution_columns(moved, ["x", "y"])
    assert wide.columns == ["case_id", "attr_x", "attr_y"] and wide.count() == 120


@pytest.fixture(scope="module")
def interacting(spark):
    """A forest on a label that needs two features together, and rows to explain."""
    rng = random.Random(5)
    names = ["a", "b", "c", "d"]
    data = [(i, rng.choice("XY"), *[rng.random() for _ in names]) for i in range(800)]
    df = spark.createDataFrame(data, "case_id int, cell_name string, " + ", ".join(f"{n} double" for n in names))
    df = df.withColumn("is_anomaly", (F.col("a") > 0.5) & (F.col("b") > 0.5))
    base = stage(spark.createDataFrame([("X", 0.1, 0.1, 0.5), ("Y", 0.2, 0.9, 0.4)], "cell_name string, a double, b double, c double"))
    return detect.train_detector(df, names, trees=10, max_depth=6), df.where("case_id < 40"), names, base


def _by_enumeration(spark, model, rows, names, base):
    """Shapley values from the definition, over all orders."""
    bases = {r["cell_name"]: r.asDict() for r in base.collect()}
    states, wanted = [], []
    for r in rows.collect():
        for mask in itertools.product([0, 1], repeat=len(names)):
            values = [r[n] if m else bases[r["cell_name"]].get(n, 0.0) for n, m in zip(names, mask)]
            states.append((r["case_id"], str(mask), *values))
    df = spark.createDataFrame(states, "case_id int, mask string, " + ", ".join(f"{n} double" for n in names))
    p = {(r["case_id"], r["mask"]): r["probability"] for r in detect.score(model, df, names).collect()}
    for r in rows.collect():
        for i, name in enumerate(names):
            total = 0.0
            for order in itertools.permutations(range(len(names))):
                before = [int(j in order[: order.index(i)]) for j in range(len(names))]
                after = [int(b or j == i) for j, b in enumerate(before)]
                total += p[r["case_id"], str(tuple(after))] - p[r["case_id"], str(tuple(before))]
            wanted.append((r["case_id"], name, total / math.factorial(len(names))))
    return {(c, n): v for c, n, v in wanted}, p


def test_shapley_values_equal_full_enumeration(spark, interacting):
    model, rows, names, base = interacting
    want, p = _by_enumeration(spark, model, rows, names, base)
    got = {(r["case_id"], r["feature"]): r for r in detect.shapley_contributions(model, rows, names, base).collect()}
    assert got.keys() == want.keys()
    for at, v in want.items():
        assert got[at]["contribution"] == pytest.approx(v, abs=1e-9) and got[at]["standard_error"] == 0.0


def test_drawn_orders_add_up_and_state_their_error(spark, interacting):
    model, rows, names, base = interacting
    want, p = _by_enumeration(spark, model, rows, names, base)
    got = {(r["case_id"], r["feature"]): r
           for r in detect.shapley_contributions(model, rows, names, base, pairs=24, exact_features=0).collect()}
    ends = str((1,) * len(names)), str((0,) * len(names))
    for case in {c for c, _ in want}:
        total = sum(got[case, n]["contribution"] for n in names)
        assert total == pytest.approx(p[case, ends[0]] - p[case, ends[1]], abs=1e-6)
    off = [abs(got[at]["contribution"] - v) - 4 * got[at]["standard_error"] for at, v in want.items()]
    assert max(off) < 0.02 and max(r["standard_error"] for r in got.values()) > 0
    again = detect.shapley_contributions(model, rows.repartition(5), names, base, pairs=24, exact_features=0)
    assert all(got[r["case_id"], r["feature"]]["contribution"] == pytest.approx(r["contribution"], abs=1e-12) for r in again.collect())


@pytest.mark.parametrize("rows, trees, depth", [(10, 200, 30), (10**5, 200, 30), (10**9, 200, 30), (10**13, 200, 30), (10**9, 20, 10)])
def test_forest_stays_within_its_nodes(rows, trees, depth):
    least, share = detect.forest_bounds(rows, trees, depth)
    assert 0 < share <= 1 and rows * share <= detect.TREE_ROWS * 1.01
    assert min(2.0 ** (depth + 1) * trees, 2 * rows * share / least * trees) <= detect.MOST_NODES
    assert least == 1 or rows > 10**4


def test_trees_grow_from_kept_nodes(spark, interacting, monkeypatch):
    """Rows are not walked from the root at every level, and the forest is the one that such walks give."""
    model, _, names, _ = interacting
    assert model.stages[-1].getCacheNodeIds() and spark.sparkContext.getCheckpointDir()
    df = spark.range(500).select(*[((F.col("id") * p) % 101 / 101).alias(n) for n, p in zip(names, (7, 11, 13, 17))])
    df = stage(df.withColumn("is_anomaly", (F.col("a") > 0.5) & (F.col("b") > 0.5)))
    kept = detect.train_detector(df, names, trees=5, max_depth=8).stages[-1]
    forest = detect.RandomForestClassifier
    monkeypatch.setattr(detect, "RandomForestClassifier", lambda **given: forest(**{**given, "cacheNodeIds": False}))
    walked = detect.train_detector(df, names, trees=5, max_depth=8).stages[-1]
    assert kept.totalNumNodes > 20
    assert kept.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]


def test_detection_rollup(spark):
    df = spark.createDataFrame([(1, 0, 0.2), (1, 1, 0.9), (2, 0, 0.5)], "case_id int, prediction int, probability double")
    assert [tuple(r) for r in detect.detect_batches(df).collect()] == [(1, True, 1, 0.9, 2)]
    assert detect.detect_batches(df, only_anomalous=False).count() == 2


# ---- verification --------------------------------------------------------------------------

def test_improvement_by_polarity(spark):
    metrics = ["bler_dl", "cqi_dl", "prb_dl"]
    schema = "case_id int, cell_name string, bler_dl double, cqi_dl double, prb_dl double"
    before = spark.createDataFrame([(1, "A", 2.0, 10.0, 50.0), (2, "A", 0.0, 10.0, 50.0)], schema)
    after = spark.createDataFrame([(1, "A", 1.0, 8.0, 40.0)], schema)
    base = stage(spark.createDataFrame([("A", 1.0, 12.0, 45.0)], "cell_name string, bler_dl double, cqi_dl double, prb_dl double"))
    out = verify.kpi_improvements(verify.verification_context(before, after, base, metrics))
    got = {(r["case_id"], r["metric"]): (r["change_pct"], r["improved"], r["baseline"]) for r in out.collect()}
    assert got[(1, "bler_dl")] == (-50.0, True, 1.0)
    assert got[(1, "cqi_dl")] == (-20.0, False, 12.0)
    assert got[(1, "prb_dl")] == (-20.0, None, 45.0)
    # No after row: compared with itself; a zero before value has no percentage.
    assert got[(2, "bler_dl")] == (None, False, 1.0)
