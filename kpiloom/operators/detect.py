"""Anomaly detector: split, training, scoring, metrics and attribution."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.operators import forest as trees_of
from kpiloom.operators.features import fill_features, first_per_group, with_baseline
from kpiloom.operators.sliding import PARTS, window_aggregates
from kpiloom.session import shared_dir, ship, stage

# Hash prefix used to cut the row order into even buckets: 4 hex digits = 65,536.
_PREFIX = 4


def stratified_split(
    df: DataFrame,
    label: str = "is_anomaly",
    test_share: float = 0.25,
    seed: int = 42,
    id_column: str = "event_id",
) -> DataFrame:
    """Adds ``is_test``: exactly ``floor(n * share + 0.5)`` rows per class, in md5(id-seed) order.

    The order within a class is never sorted as a whole.  Hash prefixes spread
    every class over even buckets; bucket counts tell in which bucket the limit
    falls, and only that bucket's rows are ranked to find the limit row.
    """
    order = F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f"-{seed}")))
    keyed = df.withColumn("_hash", order)
    prefix = F.substring("_hash", 1, _PREFIX)
    counts = keyed.groupBy(label, prefix.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(label)
    edge = stage(
        counts.withColumn("_upto", F.sum("_n").over(upto))
        .withColumn("_want", F.floor(F.sum("_n").over(whole) * F.lit(test_share) + F.lit(0.5)))
        .filter((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
        .select(label, "_bucket", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_take")),
        "split-edge",
    )
    # ``edge`` has at most one row per class.
    in_edge = keyed.withColumn("_bucket", prefix).join(F.broadcast(edge), [label, "_bucket"])
    position = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_hash", id_column))
    limit = stage(
        in_edge.select(label, "_bucket", "_hash", id_column, "_take")
        .withColumn("_pos", position)
        .filter(F.col("_pos") == F.col("_take"))
        .select(label, F.struct("_hash", F.col(id_column).alias("_id")).alias("_limit")),
        "split-limit",
    )
    place = F.struct("_hash", F.col(id_column).alias("_id"))
    return (
        keyed.join(F.broadcast(limit), label, "left")
        .withColumn("is_test", F.coalesce(place <= F.col("_limit"), F.lit(False)))
        .drop("_hash", "_limit")
    )


#: Nodes that the trees of a forest, which live on the driver, may have together: at about
#: 250 bytes each, 1 GB.  And rows that a tree is grown on at most.
MOST_NODES = 4_000_000
TREE_ROWS = 2_000_000
#: Rows times trees up to which MLlib grows all trees together; beyond, each is grown in a task of its own.
TOGETHER = 100_000_000


def forest_bounds(rows: int, trees: int, max_depth: int, most_nodes: int = MOST_NODES, tree_rows: int = TREE_ROWS) -> tuple[int, float]:
    """Least rows per leaf and share of rows per tree that keep ``trees`` trees within ``most_nodes`` nodes.

    A tree on n rows with m rows to a leaf has at most 2 n / m nodes.  Trees get fewer rows
    before leaves get more: a forest loses little by the first.
    """
    share = min(1.0, tree_rows / max(1, rows))
    deepest = 2.0 ** (max_depth + 1) * trees
    grown = 2.0 * rows * share * trees
    return (1 if min(deepest, grown) <= most_nodes else math.ceil(grown / most_nodes)), share


def train_detector(
    df: DataFrame,
    features: list[str],
    label: str = "is_anomaly",
    trees: int = 200,
    max_depth: int = 30,
    seed: int = 42,
    min_instances: int | None = None,
    subsampling: float | None = None,
    together: int = TOGETHER,
) -> PipelineModel:
    """Random forest on all features, NULL as 0.

    Depth 30 is the deepest Spark grows.  ``min_instances`` and ``subsampling`` follow from
    the number of rows (:func:`forest_bounds`) unless given, so the trees on the driver have
    a bounded size whatever the table.

    Each row keeps the node it has reached in every tree, so a level costs one step a row and
    tree instead of a walk from the root.  The forest is the same.  The kept nodes are
    checkpointed, or every task would carry the splits of all levels before.

    That is a number a row and tree.  From ``together`` of them on, every tree is grown whole in
    one task, on the rows it has drawn (:mod:`kpiloom.operators.forest`): by the same rules and
    of the same kind, with other draws.
    """
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    rows = df.count()
    if min_instances is None or subsampling is None:
        least, share = forest_bounds(rows, trees, max_depth)
        min_instances, subsampling = min_instances or least, subsampling or share
    data = fill_features(df, features).withColumn("_label", F.col(label).cast("double"))
    forest = RandomForestClassifier(
        labelCol="_label",
        featuresCol="_features",
        numTrees=trees,
        maxDepth=max_depth,
        featureSubsetStrategy="sqrt",
        minInstancesPerNode=min_instances,
        subsamplingRate=subsampling,
        seed=seed,
        maxMemoryInMB=512,
        cacheNodeIds=True,
    )
    assembler = VectorAssembler(inputCols=features, outputCol="_features")
    data = data.select("_label", *features)
    if rows * trees > together and _two_classes(data):
        nodes = trees_of.grown(data, "_label", features, trees, max_depth, min_instances, subsampling, seed)
        return PipelineModel([assembler, trees_of.as_model(nodes, forest, len(features))])
    return Pipeline(stages=[assembler, forest]).fit(data)


def _two_classes(data: DataFrame) -> bool:
    """Whether the labels are 0 and 1, both there; anything else is left to MLlib."""
    of = data.agg(F.min("_label"), F.max("_label"), F.count_if(F.coalesce(F.col("_label").isin(0.0, 1.0), F.lit(False)) == F.lit(False))).first()
    return tuple(of) == (0.0, 1.0, 0)


def score(model: PipelineModel, df: DataFrame, features: list[str]) -> DataFrame:
    """Adds ``probability`` of an anomaly and the predicted class (0 on a tie)."""
    filled = df.select("*", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"_f_{f}") for f in features])
    assembled = VectorAssembler(
        inputCols=[f"_f_{f}" for f in features], outputCol="_features"
    ).transform(filled).drop(*[f"_f_{f}" for f in features])
    scored = model.stages[-1].transform(assembled)
    return (
        scored.withColumn("_p", F.get(vector_to_array("probability"), F.lit(1)))
        .withColumn("_predicted", F.col("prediction").cast("int"))
        .drop("_features", "rawPrediction", "probability", "prediction")
        .withColumnsRenamed({"_p": "probability", "_predicted": "prediction"})
    )


def detection_aggregates() -> list[Column]:
    """Any anomaly, number of predicted anomalies, highest probability of a group of samples."""
    return [
        (F.max("prediction") > 0).alias("is_anomaly_any"),
        F.sum("prediction").alias("anomaly_count"),
        F.max("probability").alias("max_probability"),
    ]


def detect_batches(scored: DataFrame, case: str = "case_id", only_anomalous: bool = True) -> DataFrame:
    """Per case: any anomaly, number of predicted anomalies, highest probability.

    The per-sample predictions stay where they are, as rows of ``scored`` keyed
    by case and time; gathering them into one list would tie a case's whole
    batch to one task.
    """
    rolled = scored.groupBy(case).agg(*detection_aggregates(), F.count(F.lit(1)).alias("n_samples"))
    return rolled.filter("is_anomaly_any") if only_anomalous else rolled


def detection_values() -> dict[str, tuple[Column, str]]:
    """What :func:`detect_windows` gathers over the samples of a window."""
    return {
        "_any": (F.col("prediction"), "max"),
        "anomaly_count": (F.col("prediction").cast("bigint"), "sum"),
        "max_probability": (F.col("probability"), "max"),
    }


def detect_windows(
    cases: DataFrame, scored: DataFrame, before_seconds: int, after_seconds: int = 0, only_anomalous: bool = True,
    entity: str = "cell_name", ts: str = "ts", parts: int = PARTS,
) -> DataFrame:
    """:func:`detect_batches` of each case's window, without building the batches."""
    values = detection_values() | {"n_samples": (F.lit(1).cast("bigint"), "sum")}
    rolled = window_aggregates(cases, scored, before_seconds, after_seconds, values, entity, ts, parts)
    rolled = rolled.select("case_id", (F.col("_any") > 0).alias("is_anomaly_any"), "anomaly_count", "max_probability", "n_samples")
    return rolled.filter("is_anomaly_any") if only_anomalous else rolled


def anomaly_samples(
    scored: DataFrame, case: str = "case_id", ts: str = "ts", tiebreak: str = "event_id", n: int = 3,
    metrics: list[str] = fv.SAMPLE_METRICS,
) -> DataFrame:
    """The first n predicted anomalies of each batch in time order."""
    hits = scored.filter(F.col("prediction") == 1)
    first = first_per_group(hits, [case], [ts, tiebreak], n, out="pos")
    return first.select(case, "pos", "probability", *[m for m in metrics if m in scored.columns])


def classification_report(scored: DataFrame, label: str = "is_anomaly", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted rows.

    Everything after the confusion counts works on at most four rows.
    """
    cells = scored.groupBy(
        F.col(label).cast("int").alias("_y"), F.col(prediction).cast("int").alias("_p")
    ).agg(F.count(F.lit(1)).alias("_n"))

    def cell(y: int, p: int):
        return F.coalesce(F.sum(F.when((F.col("_y") == y) & (F.col("_p") == p), F.col("_n"))), F.lit(0)).cast("double")

    m = cells.agg(
        cell(0, 0).alias("n00"), cell(0, 1).alias("n01"), cell(1, 0).alias("n10"), cell(1, 1).alias("n11")
    )
    names = {0: ("n00", "n10", "n01"), 1: ("n11", "n01", "n10")}  # hit, wrongly predicted, missed
    for c, (hit, wrong, missed) in names.items():
        m = m.withColumns(
            {
                f"p{c}": F.coalesce(F.try_divide(F.col(hit), F.col(hit) + F.col(wrong)), F.lit(0.0)),
                f"r{c}": F.coalesce(F.try_divide(F.col(hit), F.col(hit) + F.col(missed)), F.lit(0.0)),
                f"s{c}": F.col(hit) + F.col(missed),
            }
        ).withColumn(
            f"f{c}",
            F.coalesce(
                F.try_divide(2 * F.col(f"p{c}") * F.col(f"r{c}"), F.col(f"p{c}") + F.col(f"r{c}")), F.lit(0.0)
            ),
        )
    total = F.col("s0") + F.col("s1")

    def macro(x: str):
        return (F.col(f"{x}0") + F.col(f"{x}1")) / 2

    def weighted(x: str):
        return F.try_divide(F.col(f"{x}0") * F.col("s0") + F.col(f"{x}1") * F.col("s1"), total)

    accuracy = F.try_divide(F.col("n00") + F.col("n11"), total)
    rows = [
        ("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        ("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), accuracy, total),
        ("macro avg", macro("p"), macro("r"), macro("f"), total),
        ("weighted avg", weighted("p"), weighted("r"), weighted("f"), total),
    ]
    return m.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("class"),
                        p.alias("precision"),
                        r.alias("recall"),
                        f.alias("f1"),
                        s.cast("bigint").alias("support"),
                    )
                    for n, p, r, f, s in rows
                ]
            )
        )
    )


#: Distinct scores of a range of the ROC area, and ranges at most.
RANGE_SCORES = 200_000
MOST_RANGES = 10_000


def roc_auc(scored: DataFrame, label: str = "is_anomaly", probability: str = "probability",
            range_scores: int = RANGE_SCORES) -> DataFrame:
    """Exact area under the ROC curve; ties count half; NULL with a single class.

    Scores collapse to one row per distinct value, so a value shared by a third
    of all rows is one row.  Distinct scores are cut into even ranges at bounds
    drawn from the scores themselves, wherever these lie; running counts are taken
    inside each range and carried across the ranges.  Rows without a score or a label are
    left out.
    """
    y = F.col(label).cast("int")
    points = stage(
        scored.filter(F.col(probability).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(probability).cast("double").alias("_s"))
        .agg(F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg")),
        "scores",
    )
    ranges = min(MOST_RANGES, -(-points.count() // range_scores))
    if ranges > 1:
        points = points.repartitionByRange(ranges, "_s").withColumn("_r", F.spark_partition_id())
        # written, so that the ranges stay what they are when a task is repeated
        points = stage(points, "score-ranges")
    else:
        points = points.withColumn("_r", F.lit(0))
    below = Window.partitionBy("_r").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    inside = points.withColumn("_neg_below", F.coalesce(F.sum("_neg").over(below), F.lit(0)))
    per_range = inside.groupBy("_r").agg(
        F.sum("_pos").alias("_pos"),
        F.sum("_neg").alias("_neg"),
        F.sum(F.col("_pos") * (F.col("_neg_below") + F.col("_neg") / 2)).alias("_wins"),
    )
    # At most ``MOST_RANGES`` rows remain here.
    lower = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_range.withColumn("_carry", F.coalesce(F.sum("_neg").over(lower), F.lit(0)))
    return carried.agg(
        F.try_divide(
            F.sum(F.col("_wins") + F.col("_pos") * F.col("_carry")), F.sum("_pos").cast("double") * F.sum("_neg")
        ).alias("roc_auc"),
        F.coalesce(F.sum(F.col("_pos") + F.col("_neg")), F.lit(0)).alias("n_rows"),
    )


def evaluate(scored: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """Classification report with the ROC area as one more row."""
    auc = roc_auc(scored, label).select(
        F.lit("roc_auc").alias("class"),
        F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        F.col("roc_auc").alias("f1"),
        F.col("n_rows").alias("support"),
    )
    return classification_report(scored, label).unionByName(auc).withColumnsRenamed({"f1": "score"})


def occlusion_contributions(
    model: PipelineModel, rows: DataFrame, features: list[str], baselines: DataFrame,
    entity: str = "cell_name", key: str = "case_id",
) -> DataFrame:
    """Per case row and feature: P(row) - P(row with that feature at its normal value).

    Normal is the entity baseline, or 0 for deviation features.  This ranks
    features like an attribution method does; it is not a Shapley value.  Meant
    for incident rows: each is scored once per feature plus once as it is.
    """
    own_and_normal = _own_and_normal(rows, features, baselines, entity, key)
    forest, kind = trees_of.as_arrays(model.stages[-1], rows.sparkSession), rows.schema[key].dataType.simpleString()

    def without(trees: trees_of.Trees, batch: pa.RecordBatch) -> list[pa.Array]:
        found = trees_of.probabilities_without(trees, *_states(trees, batch, len(features)))
        return [pa.array(found[:, -1]), pa.array(list(found[:, :-1]), pa.list_(pa.float64()))]

    scored = _walked(own_and_normal, forest, without, f"{key} {kind}, _own double, _p array<double>")
    whole = F.max("_own").over(Window.partitionBy(key))
    cells = [F.struct(F.lit(f).alias("feature"), (F.col("_whole") - F.get("_p", F.lit(i))).alias("contribution")) for i, f in enumerate(features)]
    return scored.withColumn("_whole", whole).select(key, F.inline(F.array(*cells)))


def _own_and_normal(rows: DataFrame, features: list[str], baselines: DataFrame, entity: str, key: str) -> DataFrame:
    """``key``, the features as doubles, then their normal values."""
    bases = [f for f in features if f in baselines.columns]
    filled = fill_features(rows.select(key, entity, *features), features)
    looked_up = with_baseline(filled, baselines, bases, entity)
    normal = [F.coalesce(F.col(f"base_{f}").cast("double"), F.lit(0.0)) if f in bases else F.lit(0.0) for f in features]
    return looked_up.select(
        key, *[F.col(f).cast("double").alias(f) for f in features], *[v.alias(f"_normal_{f}") for f, v in zip(features, normal)]
    )


def _states(trees: trees_of.Trees, batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Own and normal values of a batch, as places among the thresholds."""
    columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 1 + 2 * n)]
    return trees.codes(columns[:n]), trees.codes(columns[n:])


def _walked(
    rows: DataFrame, forest: trees_of.Trees, walk: Callable[[trees_of.Trees, pa.RecordBatch], list[pa.Array]], schema: str,
) -> DataFrame:
    """The first column of ``rows`` and what ``walk`` finds for each of them in the forest, which is broadcast."""
    spark = rows.sparkSession
    ship(spark)
    sent, names = spark.sparkContext.broadcast(forest), [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *walk(sent.value, batch)], names)

    return rows.mapInArrow(run, schema)


#: Up to so many features all coalitions are scored; beyond, permutations are drawn.
EXACT_FEATURES = 6


def shapley_contributions(
    model: PipelineModel, rows: DataFrame, features: list[str], baselines: DataFrame,
    entity: str = "cell_name", key: str = "case_id", pairs: int = 8, exact_features: int = EXACT_FEATURES,
) -> DataFrame:
    """``key, feature, contribution, standard_error``: Shapley values of P(row) against P(normal values).

    Normal is the entity baseline, or 0 for deviation features.  Features change from
    normal to their own value one by one; a feature's contribution is the mean change
    of the probability when its turn comes.  Orders are drawn by a hash of the key, each
    with its reverse (``pairs`` times two); all states of all cases are rows of one scoring
    pass.  Over any order the changes add up to P(row) - P(normal), so the contributions
    do.  With few features all coalitions are scored instead, and the error is 0.

    Keys must be unique; meant for incident rows.
    """
    own_and_normal = _own_and_normal(rows, features, baselines, entity, key)

    def state(own: dict[str, Column]) -> list[Column]:
        return [F.when(own[f], F.col(f)).otherwise(F.col(f"_normal_{f}")).alias(f) for f in features]

    n = len(features)
    if n <= exact_features:
        masks = F.explode(F.sequence(F.lit(0), F.lit(2**n - 1)))
        states = own_and_normal.withColumn("_mask", masks).select(
            key, "_mask", *state({f: F.col("_mask").bitwiseAND(1 << i) != 0 for i, f in enumerate(features)})
        )
        scored = score(model, states, features).select(key, "_mask", "probability")
        size = F.bit_count("_mask")
        weight = [math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n) for k in range(n)]
        weights = F.array(*[F.lit(w) for w in weight])
        values = [
            F.sum(F.col("probability") * F.when(
                F.col("_mask").bitwiseAND(1 << i) != 0, F.get(weights, size - 1)
            ).otherwise(-F.get(weights, size))).alias(f)
            for i, f in enumerate(features)
        ]
        found = scored.groupBy(key).agg(*values)
        cells = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("contribution"), F.lit(0.0).alias("standard_error")) for f in features]
        return found.select(key, F.inline(F.array(*cells)))

    def drawn(pair: Column) -> Column:
        return F.transform(F.sort_array(F.array(*[
            F.struct(F.xxhash64(F.col(key), pair, F.lit(i)).alias("h"), F.lit(i).alias("i")) for i in range(n)
        ])), lambda x: x["i"])

    forest, kind = trees_of.as_arrays(model.stages[-1], rows.sparkSession), rows.schema[key].dataType.simpleString()
    ordered = own_and_normal.withColumn("_orders", F.flatten(F.transform(F.sequence(F.lit(1), F.lit(pairs)), drawn)))

    def changes(trees: trees_of.Trees, batch: pa.RecordBatch) -> list[pa.Array]:
        orders = batch.column(1 + 2 * n).flatten().to_numpy(zero_copy_only=False).reshape(-1, pairs, n)
        turn = np.empty((len(orders), pairs, n), dtype=np.int64)
        np.put_along_axis(turn, orders.astype(np.int64), np.arange(1, n + 1), axis=2)
        mean = trees_of.changes_by_order(trees, *_states(trees, batch, n), turn.transpose(0, 2, 1))
        error = mean.std(axis=1, ddof=1) / math.sqrt(pairs) if pairs > 1 else np.zeros((len(mean), n))
        return [pa.array(list(v), pa.list_(pa.float64())) for v in (mean.mean(axis=1), error)]

    found = _walked(ordered, forest, changes, f"{key} {kind}, _mean array<double>, _error array<double>")
    cells = [F.struct(
        F.lit(f).alias("feature"), F.get("_mean", F.lit(i)).alias("contribution"), F.get("_error", F.lit(i)).alias("standard_error")
    ) for i, f in enumerate(features)]
    return found.select(key, F.inline(F.array(*cells)))


def attribution_columns(contributions: DataFrame, features: list[str], key: str = "case_id") -> DataFrame:
    """Wide form of the contributions: one column ``attr_<feature>`` each, one row per case."""
    return contributions.groupBy(key).agg(
        *[F.max(F.when(F.col("feature") == f, F.col("contribution"))).alias(f"attr_{f}") for f in features]
    )
