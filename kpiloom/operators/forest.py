"""Forests on many rows: trees grown whole, one a task, and walked for many states of a row at once.

MLlib grows all trees together, level by level, and keeps one number a row and tree for it, so
time and memory follow rows times trees.  A tree here is grown where its own rows are.  The
trees are MLlib's: same candidate splits by equal shares of rows, Gini gain, Poisson weights,
features drawn anew per node, leaves that predict alike merged.  They come back as an MLlib model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.session import ship, stage_path

#: Bins of a feature, MLlib's default, and points of its distribution that they are cut from.
BINS = 32
POINTS = 5_000
#: Rows that are put into bins at once, and nodes whose rows are counted at once.
CHUNK_ROWS = 1 << 17
NODE_BLOCK = 1 << 15
#: Shares that are added at once: adding costs a copy of all sums.
ADDED = 1 << 20

_NODES = (
    "tree int, id int, prediction double, impurity double, n0 double, n1 double, gain double, "
    "left_child int, right_child int, feature int, threshold double"
)


# ---- growing -------------------------------------------------------------------------------


def cut_points(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """At most ``bins - 1`` thresholds between sorted values, each value as often as its share of rows."""
    distinct, counts = np.unique(values, return_counts=True)
    between = (distinct[:-1] + distinct[1:]) / 2
    if len(between) < bins:
        return between
    stride, upto = len(values) / bins, np.cumsum(counts)
    out, target = [], stride
    for i in range(1, len(distinct)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out[: bins - 1])


def thresholds(data: DataFrame, features: list[str]) -> list[np.ndarray]:
    """Candidate splits of each feature, from a sketch of all rows."""
    shares = F.lit([i / POINTS for i in range(POINTS + 1)])
    found = data.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, 10_000).alias(f"_{i}") for i, f in enumerate(features)]).first()
    return [cut_points(np.array(found[i])) for i in range(len(features))]


def binned(columns: list[np.ndarray], cuts: list[np.ndarray], kind: type = np.uint8) -> np.ndarray:
    """Row by row, how many of a feature's thresholds lie below its value: at most i if the value is at most the i-th."""
    out = np.empty((len(columns[0]) if columns else 0, len(columns)), dtype=kind)
    for i, (values, cut) in enumerate(zip(columns, cuts)):
        out[:, i] = np.searchsorted(cut, values, side="left")
    return out


def _gini(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    n = np.maximum(n0 + n1, 1)
    return 1.0 - (n0 / n) * (n0 / n) - (n1 / n) * (n1 / n)


def best_splits(codes, label, weight, rows, slot, n0, n1, chosen, n_cuts, least):
    """Per node the gain, feature, bin and left counts of its best split among its chosen features."""
    nodes, bins = len(n0), int(n_cuts.max(initial=0)) + 1
    whole, impurity = n0 + n1, _gini(n0, n1)
    gain, feature, cut = np.full(nodes, -np.inf), np.zeros(nodes, dtype=np.int64), np.zeros(nodes, dtype=np.int64)
    left0, left1 = np.zeros(nodes), np.zeros(nodes)
    if bins == 1:
        return gain, feature, cut, left0, left1
    flat, width, own = codes.reshape(-1), codes.shape[1], np.arange(nodes)
    base, key0, w = rows * width, slot * (2 * bins) + label[rows], weight[rows]
    for j in range(chosen.shape[1]):
        f = chosen[:, j]
        key = key0 + 2 * flat[base + f[slot]].astype(np.int64)
        counts = np.bincount(key, weights=w, minlength=nodes * bins * 2).reshape(nodes, bins, 2).cumsum(axis=1)
        l0, l1 = counts[:, :-1, 0], counts[:, :-1, 1]
        r0, r1 = n0[:, None] - l0, n1[:, None] - l1
        left, right = l0 + l1, r0 + r1
        found = impurity[:, None] - left / whole[:, None] * _gini(l0, l1) - right / whole[:, None] * _gini(r0, r1)
        ok = (left >= least) & (right >= least) & (np.arange(bins - 1) < n_cuts[f][:, None])
        found = np.where(ok, found, -np.inf)
        at = found.argmax(axis=1)
        better = found[own, at] > gain
        gain = np.where(better, found[own, at], gain)
        feature, cut = np.where(better, f, feature), np.where(better, at, cut)
        left0, left1 = np.where(better, l0[own, at], left0), np.where(better, l1[own, at], left1)
    return gain, feature, cut, left0, left1


def grow(
    codes: np.ndarray, label: np.ndarray, weight: np.ndarray, cuts: list[np.ndarray], drawn: int, max_depth: int,
    least: int, rng: np.random.Generator,
) -> dict[str, np.ndarray]:
    """One tree, level by level; nodes in the order they are made, children always after their parent."""
    label, weight = label.astype(np.int64), weight.astype(np.float64)
    n_cuts, width = np.array([len(c) for c in cuts]), codes.shape[1]
    total = np.bincount(label, weights=weight, minlength=2)
    n0, n1 = total[:1], total[1:2]
    levels, made = [], 1
    rows, slot = np.arange(len(label)), np.zeros(len(label), dtype=np.int64)
    open_ = np.array([max_depth > 0])
    while True:
        nodes = len(n0)
        gain, left, right = np.full(nodes, -1.0), np.full(nodes, -1), np.full(nodes, -1)
        feature, cut = np.full(nodes, -1), np.full(nodes, -1)
        level = {"n0": n0, "n1": n1, "gain": gain, "left": left, "right": right, "feature": feature, "cut": cut}
        levels.append(level)
        todo = np.flatnonzero(open_)
        if not len(todo):
            break
        l0, l1 = np.zeros(nodes), np.zeros(nodes)
        for at in range(0, len(todo), NODE_BLOCK):
            block = todo[at: at + NODE_BLOCK]
            place = np.full(nodes, -1)
            place[block] = np.arange(len(block))
            mine = place[slot]
            here = mine >= 0
            chosen = np.argsort(rng.random((len(block), width)), axis=1)[:, :drawn] if drawn < width else np.tile(np.arange(width), (len(block), 1))
            g, f, c, a, b = best_splits(codes, label, weight, rows[here], mine[here], n0[block], n1[block], chosen, n_cuts, least)
            split = g > 0
            on = block[split]
            gain[on], feature[on], cut[on], l0[on], l1[on] = g[split], f[split], c[split], a[split], b[split]
        on = np.flatnonzero(feature >= 0)
        if not len(on):
            break
        left[on] = made + 2 * np.arange(len(on))
        right[on] = left[on] + 1
        child = np.full(nodes, -1)
        child[on] = 2 * np.arange(len(on))
        kept = child[slot] >= 0
        rows, slot = rows[kept], slot[kept]
        slot = child[slot] + (codes[rows, feature[slot]] > cut[slot])
        n0 = np.stack([l0[on], n0[on] - l0[on]], axis=1).reshape(-1)
        n1 = np.stack([l1[on], n1[on] - l1[on]], axis=1).reshape(-1)
        made += len(n0)
        open_ = (_gini(n0, n1) >= np.finfo(float).eps) & (len(levels) < max_depth)
        kept = open_[slot]
        rows, slot = rows[kept], slot[kept]
    return _merged({k: np.concatenate([level[k] for level in levels]) for k in levels[0]}, cuts)


def _merged(tree: dict[str, np.ndarray], cuts: list[np.ndarray]) -> dict[str, np.ndarray]:
    """The tree without splits into two leaves that predict alike, numbered anew, level by level."""
    left, right = tree["left"].copy(), tree["right"].copy()
    says = (tree["n1"] > tree["n0"]).astype(float)
    while True:  # a round a level at most: a merged node may be one of two such leaves itself
        inner = np.flatnonzero(left >= 0)
        a, b = left[inner], right[inner]
        alike = inner[(left[a] < 0) & (left[b] < 0) & (says[a] == says[b])]
        if not len(alike):
            break
        left[alike] = right[alike] = -1
    kept, at = [np.zeros(1, dtype=np.int64)], np.zeros(1, dtype=np.int64)
    while len(at):
        at = at[left[at] >= 0]
        at = np.stack([left[at], right[at]], axis=1).reshape(-1)
        kept.append(at)
    kept = np.concatenate(kept)
    number = np.full(len(left), -1)
    number[kept] = np.arange(len(kept))
    inner = left[kept] >= 0
    n0, n1, feature, cut = (tree[k][kept] for k in ("n0", "n1", "feature", "cut"))
    return {
        "id": np.arange(len(kept)), "prediction": says[kept], "impurity": _gini(n0, n1), "n0": n0, "n1": n1,
        "gain": np.where(inner, tree["gain"][kept], -1.0),
        "left_child": np.where(inner, number[left[kept]], -1), "right_child": np.where(inner, number[right[kept]], -1),
        "feature": np.where(inner, feature, -1),
        "threshold": np.array([cuts[f][c] if i else np.nan for f, c, i in zip(feature, cut, inner)], dtype=float),
    }


def _columns(batch: pa.RecordBatch, at: range) -> list[np.ndarray]:
    return [batch.column(i).to_numpy(zero_copy_only=False) for i in at]


def grown(
    data: DataFrame, label: str, features: list[str], trees: int, max_depth: int, least: int, share: float, seed: int,
) -> DataFrame:
    """Nodes of all trees.  Rows move once, in bins, to every tree that has drawn them.

    How often a row of a chunk is drawn for a tree is a Poisson number; the draws of a whole
    chunk are a Poisson number too, dealt evenly, so drawing costs what is drawn.
    """
    spark, width = data.sparkSession, len(features)
    ship(spark)
    cuts = thresholds(data, features)
    sent, drawn = spark.sparkContext.broadcast(cuts), math.ceil(math.sqrt(width))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, chunk, waiting = TaskContext.get().partitionId(), 0, []

        def dealt():
            table = np.concatenate(waiting)
            ids, bags = [], []
            for t in range(trees):
                rng = np.random.default_rng([seed, part, chunk, t])
                n = rng.poisson(len(table) * share)
                times = np.bincount(rng.integers(0, len(table), n), minlength=len(table))
                of = np.flatnonzero(times)
                bag = table[of]
                bag[:, -1] = np.minimum(times[of], 255)
                ids.append(t)
                bags.append(bag.tobytes())
                if sum(map(len, bags)) > 1 << 24 or t == trees - 1:
                    yield pa.record_batch([pa.array(ids, pa.int32()), pa.array([part] * len(ids), pa.int32()),
                                           pa.array([chunk] * len(ids), pa.int32()), pa.array(bags, pa.binary())],
                                          names=["tree", "part", "chunk", "bag"])
                    ids, bags = [], []

        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = binned(_columns(batch, range(1, 1 + width)), sent.value)
            says = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint8)
            waiting.append(np.column_stack([codes, says, np.zeros(len(says), dtype=np.uint8)]))
            held += len(says)
            if held >= CHUNK_ROWS:
                yield from dealt()
                waiting, held, chunk = [], 0, chunk + 1
        if waiting:
            yield from dealt()

    def one_tree(key: tuple, table: pa.Table) -> pa.Table:
        t = key[0].as_py()
        order = np.lexsort([table.column("chunk").to_numpy(), table.column("part").to_numpy()])  # however they came
        bags = table.column("bag").to_pylist()
        rows = np.frombuffer(b"".join(bags[i] for i in order), dtype=np.uint8).reshape(-1, width + 2)
        del table, bags
        made = grow(np.ascontiguousarray(rows[:, :width]), rows[:, width], rows[:, width + 1], sent.value, drawn, max_depth, least,
                    np.random.default_rng([seed, t]))
        kinds = {f.split()[0]: pa.int32() if f.split()[1] == "int" else pa.float64() for f in _NODES.split(", ")}
        made["tree"] = np.full(len(made["id"]), t)
        return pa.table({k: pa.array(made[k]).cast(kind) for k, kind in kinds.items()})

    dealt = data.select(label, *features).mapInArrow(deal, "tree int, part int, chunk int, bag binary")
    return dealt.repartition(trees, "tree").groupBy("tree").applyInArrow(one_tree, _NODES)


def as_model(nodes: DataFrame, estimator: RandomForestClassifier, width: int) -> RandomForestClassificationModel:
    """An MLlib model of grown trees.  A forest of the estimator's own on two rows lends all but the nodes."""
    spark = nodes.sparkSession
    two = spark.createDataFrame(
        [(0.0, Vectors.dense([0.0] * width)), (1.0, Vectors.dense([1.0] * width))],
        [estimator.getLabelCol(), estimator.getFeaturesCol()],
    )
    lent, path = stage_path(spark, "forest-form"), stage_path(spark, "forest")
    estimator.fit(two).write().overwrite().save(lent)
    leaf = F.col("left_child") < 0
    split = F.struct(
        F.col("feature").alias("featureIndex"),
        F.when(leaf, F.array().cast("array<double>")).otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    nodes.select(F.col("tree").alias("treeID"), F.struct(
        "id", "prediction", "impurity", F.array("n0", "n1").alias("impurityStats"),
        (F.col("n0") + F.col("n1")).cast("bigint").alias("rawCount"), "gain",
        F.col("left_child").alias("leftChild"), F.col("right_child").alias("rightChild"), split.alias("split"),
    ).alias("nodeData")).write.parquet(f"{path}/data")
    spark.read.parquet(f"{lent}/treesMetadata").write.parquet(f"{path}/treesMetadata")
    spark.read.text(f"{lent}/metadata").write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)


# ---- walking -------------------------------------------------------------------------------


@dataclass
class Trees:
    """A forest as arrays: nodes of all trees one after the other, splits as places among a feature's thresholds.

    ``n0`` and ``n1`` are the shares of the classes at a node, 0 where it has no rows.
    """

    start: np.ndarray
    feature: np.ndarray
    place: np.ndarray
    left: np.ndarray
    right: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    cuts: list[np.ndarray]

    def codes(self, columns: list[np.ndarray]) -> np.ndarray:
        return binned(columns, self.cuts, np.min_scalar_type(max(map(len, self.cuts), default=0) + 1).type)

    def tree(self, t: int) -> tuple[np.ndarray, ...]:
        of = slice(self.start[t], self.start[t + 1])
        return tuple(a[of] for a in (self.feature, self.place, self.left, self.right, self.n0, self.n1))

    def __len__(self) -> int:
        return len(self.start) - 1


def as_arrays(model: RandomForestClassificationModel, spark) -> Trees:
    """The arrays of a model, whose nodes the driver holds anyway."""
    path = stage_path(spark, "forest")
    model.write().overwrite().save(path)
    n = F.col("nodeData")
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", n["id"].alias("id"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        F.get(n["impurityStats"], 0).alias("n0"), F.get(n["impurityStats"], 1).alias("n1"),
    ).toArrow()
    c = {name: np.nan_to_num(rows.column(name).to_numpy(), nan=0.0) for name in ("n0", "n1")}
    c |= {name: rows.column(name).to_numpy() for name in ("treeID", "id", "feature", "threshold", "left", "right")}
    order = np.lexsort([c["id"], c["treeID"]])
    c = {name: a[order] for name, a in c.items()}
    start = np.searchsorted(c["treeID"], np.arange(model.getNumTrees + 1))
    feature = c["feature"].astype(np.int64)
    cuts = [np.unique(c["threshold"][feature == f]) for f in range(model.numFeatures)]
    place = np.zeros(len(feature), dtype=np.int64)
    for f, cut in enumerate(cuts):
        place[feature == f] = np.searchsorted(cut, c["threshold"][feature == f])
    total = c["n0"] + c["n1"]
    some = np.where(total > 0, total, 1)
    # a leaf asks any feature and leads to itself
    at = np.arange(len(feature)) - np.repeat(start[:-1], np.diff(start))
    leaf = feature < 0
    return Trees(
        start, np.where(leaf, 0, feature), place, np.where(leaf, at, c["left"]), np.where(leaf, at, c["right"]),
        c["n0"] / some, c["n1"] / some, cuts,
    )


def probabilities_without(forest: Trees, own: np.ndarray, normal: np.ndarray) -> np.ndarray:
    """``rows x (features + 1)``: the probability with each feature at its normal value, last with none.

    One walk a row and tree: it follows the row, and leaves a second walker for a feature where
    its normal value first leads elsewhere.
    """
    n, width = own.shape
    votes = np.zeros((2, n, width + 1))
    own_flat, normal_flat = own.reshape(-1), normal.reshape(-1)
    for t in range(len(forest)):
        feature, place, left, right, n0, n1 = forest.tree(t)
        seen = np.zeros(n * width, dtype=bool)
        row, node, changed = np.arange(n), np.zeros(n, dtype=np.int64), np.full(n, width)
        ends: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(row):
            done = left[node] == node
            if done.any():
                ends.append((row[done], node[done], changed[done]))
                row, node, changed = row[~done], node[~done], changed[~done]
            f = feature[node]
            at, limit = row * width + f, place[node]
            goes, would = own_flat[at] <= limit, normal_flat[at] <= limit
            new = np.flatnonzero((goes != would) & (changed == width) & ~seen[at])
            seen[at[new]] = True
            mine = np.where(changed == f, would, goes)
            more = np.where(would[new], left[node[new]], right[node[new]])
            node = np.where(mine, left[node], right[node])
            row, node, changed = np.concatenate([row, row[new]]), np.concatenate([node, more]), np.concatenate([changed, f[new]])
        row, node, changed = (np.concatenate(x) for x in zip(*ends)) if ends else (row, node, changed)
        as_it_is = changed == width
        found = np.empty(n, dtype=np.int64)
        found[row[as_it_is]] = node[as_it_is]
        row, node, changed = row[~as_it_is], node[~as_it_is], changed[~as_it_is]
        for k, share in enumerate((n0, n1)):
            vote = np.repeat(share[found][:, None], width + 1, axis=1)
            vote[row, changed] = share[node]
            votes[k] += vote
    whole = votes[0] + votes[1]
    return votes[1] / np.where(whole > 0, whole, 1)


def changes_by_order(forest: Trees, own: np.ndarray, normal: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """``rows x pairs x features``: mean change of the probability at a feature's turn, over an order and its reverse.

    ``turn`` (rows x features x pairs) is the place, from 1, of a feature in each order.  One walk
    a row and tree visits every leaf that some step of some order reaches.  Where own and
    normal value lead apart the walker parts.  A leaf lies on the steps of an order from the
    last of the features that must be changed already to the first that must not be: there its
    share comes and goes.
    """
    n, width, pairs = turn.shape
    kind = np.min_scalar_type(width + 1)
    turns = np.ascontiguousarray(turn.astype(kind)).reshape(n * width, pairs)
    own_flat, normal_flat = own.reshape(-1), normal.reshape(-1)
    came, counted = np.zeros(n * pairs * (width + 2)), 0
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    base = (np.arange(n)[:, None] * pairs + np.arange(pairs)) * (width + 2)
    # of the features that must be changed, or not: last and first place.  Four columns a pair;
    # walkers know theirs by its row, 0 where they have not parted
    last, first, last_not, first_not = (slice(i * pairs, (i + 1) * pairs) for i in range(4))
    start = np.zeros((1, 4 * pairs), dtype=kind)
    start[:, first] = start[:, first_not] = width + 1

    def add() -> None:
        np.add.at(came, np.concatenate([at for at, _ in waiting]), np.concatenate([share for _, share in waiting]))
        waiting.clear()

    for t in range(len(forest)):
        feature, place, left, right, n0, n1 = forest.tree(t)
        if n0[0] + n1[0] == 0:
            continue
        counted += 1
        leaf = left == np.arange(len(left))
        row, node, bound = np.arange(n), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        bounds, filled = np.repeat(start, 2 * n + 1, axis=0), 1
        ends: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(row):
            done = leaf.take(node)
            if done.any():
                of, still = np.flatnonzero(done & (bound > 0)), np.flatnonzero(~done)
                ends.append((row.take(of), n1.take(node.take(of)), bound.take(of)))
                row, node, bound = row.take(still), node.take(still), bound.take(still)
            at, limit = row * width + feature.take(node), place.take(node)
            goes, would = own_flat.take(at) <= limit, normal_flat.take(at) <= limit
            onward = np.where(goes, left.take(node), right.take(node))
            parts = np.flatnonzero(goes != would)
            if not len(parts):
                node = onward
                continue
            of, mine = turns.take(at.take(parts), axis=0), bounds.take(bound.take(parts), axis=0)
            other = mine.copy()
            mine[:, last], mine[:, first] = np.maximum(mine[:, last], of), np.minimum(mine[:, first], of)
            other[:, last_not], other[:, first_not] = np.maximum(other[:, last_not], of), np.minimum(other[:, first_not], of)
            more = np.where(would.take(parts), left.take(node.take(parts)), right.take(node.take(parts)))
            stays = np.ones(len(row), dtype=bool)
            stays[parts] = alive = _reached(mine, pairs)
            new = _reached(other, pairs)
            kept = np.concatenate([mine[alive], other[new]])
            if filled + len(kept) > len(bounds):
                bounds = np.concatenate([bounds[:filled], np.repeat(start, filled + len(kept), axis=0)])
            bounds[filled: filled + len(kept)] = kept
            bound[parts[alive]] = np.arange(filled, filled + int(alive.sum()))
            filled += len(kept)
            stays, parts = np.flatnonzero(stays), parts[new]
            bound = np.concatenate([bound.take(stays), np.arange(filled - len(parts), filled)])
            row, node = np.concatenate([row.take(stays), row.take(parts)]), np.concatenate([onward.take(stays), more[new]])
        row, share, bound = (np.concatenate(x) for x in zip(*ends))
        if (share == 1).sum() > (share == 0).sum():
            share = share - 1  # the changes are the same, and fewer walkers bring anything
        some = np.flatnonzero(share)
        at, share, b = base.take(row.take(some), axis=0), share.take(some), bounds.take(bound.take(some), axis=0)
        there, back = b[:, last] < b[:, first_not], b[:, first] > b[:, last_not]
        for on, comes, leaves in ((there, last, first_not), (back, first, last_not)):
            on = np.flatnonzero(on)
            cells, shares = at.reshape(-1).take(on), share.take(on // pairs)
            waiting.append((cells + np.ascontiguousarray(b[:, comes]).reshape(-1).take(on), shares))
            waiting.append((cells + np.ascontiguousarray(b[:, leaves]).reshape(-1).take(on), -shares))
        if sum(len(share) for _, share in waiting) > ADDED:
            add()
    if waiting:
        add()
    by_place = came.reshape(n, pairs, width + 2) / (2 * max(1, counted))
    return np.take_along_axis(by_place, turn.transpose(0, 2, 1).astype(np.int64), axis=2)


def _reached(bounds: np.ndarray, pairs: int) -> np.ndarray:
    """Whether any step of any order, or of its reverse, lies between the bounds."""
    last, first, last_not, first_not = (bounds[:, i * pairs: (i + 1) * pairs] for i in range(4))
    return ((last < first_not) | (first > last_not)).any(axis=1)
