"""Trees grown whole against MLlib's, and walks over many states against scoring each state."""

import itertools

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from kpiloom.operators import detect, forest
from kpiloom.registry import QUERIES, incidents
from kpiloom.session import stage
from kpiloom.sources import sinks
from tests.conftest import table

NAMES = list("abcdefgh")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    """Few values a feature, a label of two of them and some noise."""
    df = spark.range(2500).select(
        F.col("id").alias("case_id"), F.concat(F.lit("C"), (F.col("id") % 3).cast("string")).alias("cell_name"),
        *[((F.xxhash64("id", F.lit(i)) % 11) * (1.0 + i)).alias(n) for i, n in enumerate(NAMES)])
    return stage(df.withColumn("is_anomaly", (F.col("a") + F.col("b") > 8) | (F.xxhash64("case_id", F.lit(77)) % 13 == 0)))


@pytest.fixture(scope="module")
def whole(rows):
    """A forest whose trees were grown one a task."""
    return detect.train_detector(rows, NAMES, trees=12, max_depth=9, together=0)


@pytest.mark.parametrize("least, depth", [(1, 30), (6, 30), (1, 3), (1, 0)])
def test_a_grown_tree_is_mllibs(spark, rows, least, depth):
    """Without draws there is one tree to grow: node by node the same, with the same thresholds."""
    estimator = RandomForestClassifier(
        labelCol="_label", featuresCol="_features", numTrees=1, maxDepth=depth, featureSubsetStrategy="all", bootstrap=False,
        minInstancesPerNode=least, seed=3)
    data = rows.withColumn("_label", F.col("is_anomaly").cast("double"))
    theirs = estimator.fit(VectorAssembler(inputCols=NAMES, outputCol="_features").transform(data))
    values = data.select("_label", *NAMES).toPandas()
    cuts = forest.thresholds(data, NAMES)
    codes = forest.binned([values[n].to_numpy() for n in NAMES], cuts)
    made = forest.grow(codes, values["_label"].to_numpy(), np.ones(len(codes)), cuts, len(NAMES), depth, least, np.random.default_rng(1))
    order = [part.split()[0] for part in forest._NODES.split(", ")]
    made["tree"] = np.zeros(len(made["id"]), dtype=int)
    nodes = spark.createDataFrame([tuple(r) for r in zip(*[made[k].tolist() for k in order])], forest._NODES)
    mine = forest.as_model(nodes, estimator, len(NAMES))
    assert mine.toDebugString.split("\n")[1:] == theirs.toDebugString.split("\n")[1:]
    assert mine.totalNumNodes > 1 or depth == 0


def test_trees_grown_whole_do_the_whole_job(spark, rows, whole, tmp_path, monkeypatch):
    together = detect.train_detector(rows, NAMES, trees=12, max_depth=9)
    auc = [detect.roc_auc(detect.score(m, rows, NAMES)).first()["roc_auc"] for m in (whole, together)]
    assert auc[0] > 0.9 and abs(auc[0] - auc[1]) < 0.03
    model = whole.stages[-1]
    assert model.getNumTrees == 12 and max(t.depth for t in model.trees) <= 9 and len({t.toDebugString for t in model.trees}) == 12
    again = detect.train_detector(rows, NAMES, trees=12, max_depth=9, together=0)
    assert again.stages[-1].toDebugString.split("\n")[1:] == model.toDebugString.split("\n")[1:]
    path = str(tmp_path / "m")
    sinks.save_model(whole, path)
    scored = [detect.score(m, rows, NAMES) for m in (whole, sinks.load_model(path))]
    assert table(scored[0], "case_id", "probability") == table(scored[1], "case_id", "probability")


def test_many_rows_are_not_walked_by_all_trees_together(rows, monkeypatch):
    """MLlib fits no more than the two rows that lend the form of a model."""
    fitted, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: fitted.append(df.count()) or fit(self, df))
    monkeypatch.setattr(detect, "TOGETHER", 0)
    detect.train_detector(rows, NAMES, trees=3, max_depth=4, together=detect.TOGETHER)
    assert fitted == [2]


def test_one_class_is_left_to_mllib(rows):
    model = detect.train_detector(rows.filter("is_anomaly"), NAMES, trees=3, max_depth=4, together=0)
    assert model.stages[-1].totalNumNodes == 3


def test_every_row_is_drawn_about_as_often_as_asked(spark, rows):
    data = rows.withColumn("_label", F.col("is_anomaly").cast("double")).select("_label", *NAMES)
    for share in (1.0, 0.3):
        nodes = forest.grown(data, "_label", NAMES, 40, 2, 1, share, 7)
        drawn = nodes.filter("id = 0").agg(F.avg(F.col("n0") + F.col("n1")).alias("n"), F.count("*").alias("trees")).first()
        assert drawn["trees"] == 40 and drawn["n"] == pytest.approx(2500 * share, rel=0.05)


def _states(spark, case_rows, base, wanted):
    """Probability of each wanted mixture ``(case, own features)`` by scoring it as a row."""
    made = []
    for at, (r, own) in enumerate(wanted):
        made.append((at, *[r[n] if n in own else base[r["cell_name"]].get(n, 0.0) for n in NAMES]))
    return spark.createDataFrame(made, "at int, " + ", ".join(f"{n} double" for n in NAMES))


@pytest.fixture(scope="module")
def base(spark):
    some = {"C0": {"a": 1.0, "b": 2.0, "c": 9.0}, "C1": {"a": 7.0, "b": 2.0, "c": -3.0}}  # C2 has none
    return some, stage(spark.createDataFrame([(c, *v.values()) for c, v in some.items()], "cell_name string, a double, b double, c double"))


def test_occlusion_is_a_score_of_every_state(spark, rows, whole, base):
    known, baselines = {**base[0], "C2": {}}, base[1]
    some = rows.filter("case_id < 60")
    cases = some.collect()
    wanted = [(r, set(NAMES) - {f}) for r in cases for f in [None, *NAMES]]
    p = [r["probability"] for r in detect.score(whole, _states(spark, cases, known, wanted), NAMES).orderBy("at").collect()]
    want = {}
    for i, r in enumerate(cases):
        at = i * (len(NAMES) + 1)
        want |= {(r["case_id"], f): p[at] - p[at + 1 + j] for j, f in enumerate(NAMES)}
    got = {(r["case_id"], r["feature"]): r["contribution"] for r in detect.occlusion_contributions(whole, some, NAMES, baselines).collect()}
    assert got == want and any(got.values())


@pytest.mark.parametrize("pairs", [1, 3])
def test_drawn_orders_are_a_score_of_every_state(spark, rows, whole, base, pairs):
    known, baselines = {**base[0], "C2": {}}, base[1]
    some = rows.filter("case_id < 25")
    drawn = some.select("case_id", *[F.sort_array(F.array(*[
        F.struct(F.xxhash64("case_id", F.lit(pair), F.lit(i)).alias("h"), F.lit(i).alias("i")) for i in range(len(NAMES))
    ])).alias(f"o{pair}") for pair in range(1, pairs + 1)]).collect()
    orders = {r["case_id"]: [[NAMES[x["i"]] for x in r[f"o{pair}"]] for pair in range(1, pairs + 1)] for r in drawn}
    cases = some.collect()
    wanted = [(r, set(way[:k])) for r in cases for o in orders[r["case_id"]] for way in (o, o[::-1]) for k in range(len(NAMES) + 1)]
    p = iter([r["probability"] for r in detect.score(whole, _states(spark, cases, known, wanted), NAMES).orderBy("at").collect()])
    got = {(r["case_id"], r["feature"]): r for r in detect.shapley_contributions(whole, some, NAMES, baselines, pairs=pairs).collect()}
    assert len(got) == len(cases) * len(NAMES)
    for r in cases:
        means = {f: [] for f in NAMES}
        for o in orders[r["case_id"]]:
            changes = {f: 0.0 for f in NAMES}
            for way in (o, o[::-1]):
                at = [next(p) for _ in range(len(NAMES) + 1)]
                for f, (before, after) in zip(way, itertools.pairwise(at)):
                    changes[f] += (after - before) / 2
            for f in NAMES:
                means[f].append(changes[f])
        for f, m in means.items():
            found = got[r["case_id"], f]
            assert found["contribution"] == pytest.approx(np.mean(m), abs=1e-12)
            assert found["standard_error"] == pytest.approx(np.std(m, ddof=1) / pairs**0.5 if pairs > 1 else 0.0, abs=1e-12)


def test_states_are_not_rows(spark, rows, whole, base):
    """No state of a case is a row of its own, and nothing is gathered by a shuffle."""
    plan = detect.shapley_contributions(whole, rows, NAMES, base[1])._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "collect_list" not in plan and "hashpartitioning" not in plan


def test_shapley_query_draws_all_its_orders(spark):
    """A single pair of orders has no standard error."""
    found = QUERIES["shapley_contributions"](spark, SMALL).agg(F.max("standard_error"), F.min("standard_error")).first()
    assert found[0] > 0 and found[1] >= 0


def test_sums_of_rows_that_come_twice(spark, rows, whole, base, monkeypatch):
    some = rows.filter("case_id < 90").withColumnRenamed("case_id", "event_id")
    twice = stage(some.unionByName(some.filter("event_id % 3 = 0")))
    monkeypatch.setattr(incidents, "_trained", lambda spark, d: (whole, NAMES, twice))
    monkeypatch.setattr(incidents, "baselines", lambda spark, d: base[1])
    n = twice.filter("is_anomaly").count()
    assert tuple(QUERIES["shapley_sums"](spark, "").first()) == (n, n * len(NAMES), 0)
