"""Exact percentiles per group that hold up when one group dominates.

The built-in exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer.  That is the cheapest plan while groups have few rows or few
distinct values, and fails for a group holding a third of a huge table of
readings.  So rows and distinct values (a bounded sketch) are checked first, and
only large groups take the selection path, for their many-valued columns:

1. the rows of large groups are written once, with nothing but the columns in question;
2. one bounded sketch per group gives a narrow value band around each target rank, and
   one partial aggregate counts the values below and inside each band, which says
   between which two limits the target ranks really lie (the sketch may be off: then
   the limits are wider, the result is the same);
3. values between the limits collapse to distinct ones with their counts.  While a target
   keeps more than ``RANKED_VALUES`` of them, a histogram of them (equally many distinct
   values to a bin) says in which bin the rank lies, and only that bin goes on;
4. what is left is ranked, so a ranking task has a fixed bound whatever the group.

Pass 2 shuffles one row per group and task, pass 3 a tiny share of the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.session import broadcast_if_small, stage

#: Rows, and distinct values of a column, up to which one buffer may hold a group.
LARGE_GROUP = 20_000
#: Rank error of a sketch is 1 / accuracy; the band reaches twice that far on each side.
SKETCH_ACCURACY = 2_000
#: Distinct values that one task ranks at most, and bins of a histogram that narrows more of them.
RANKED_VALUES = 100_000
BINS = 64

_ALL = "_all_rows"


def group_percentiles(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    probs: list[float],
    large: int = LARGE_GROUP,
    ranked: int | None = None,
) -> DataFrame:
    """One row per group: keys and, per column, an array of its percentiles.

    Linear interpolation between neighbours, NULLs skipped; a column without any
    value in a group gives NULLs.  With no keys the whole table is one group.
    Keys must not be NULL.
    """
    if not keys:
        whole = df.select(F.lit(0).alias(_ALL), *columns)
        return group_percentiles(whole, [_ALL], columns, probs, large, ranked).drop(_ALL)

    data = df.select(*keys, *columns)
    spreads = data.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.approx_count_distinct(c).alias(f"_d{i}") for i, c in enumerate(columns)]
    )
    widest = spreads.agg(F.max("_rows").alias("_rows"), *[F.max(f"_d{i}").alias(f"_d{i}") for i in range(len(columns))]).first()
    many = [i for i in range(len(columns)) if (widest["_rows"] or 0) > large and widest[f"_d{i}"] > large]
    if not many:
        return _builtin(data, keys, columns, probs)

    spreads = stage(spreads, "value-counts")
    is_hot = reduce(lambda a, b: a | b, [F.col(f"_d{i}") > large for i in many])
    hot = stage(spreads.filter(is_hot).select(*keys), "hot-groups")
    wide = [columns[i] for i in many]
    rows = stage(data.select(*keys, *wide).join(broadcast_if_small(hot), keys, "left_semi"), "hot-rows")
    result = _select(rows, keys, wide, probs, hot, ranked or RANKED_VALUES)
    if not spreads.filter(~is_hot).isEmpty():
        cold = data.join(broadcast_if_small(hot), keys, "left_anti")
        result = result.unionByName(_builtin(cold, keys, wide, probs))
    narrow = [c for c in columns if c not in wide]
    if narrow:
        result = result.join(_builtin(data, keys, narrow, probs), keys)
    return result.select(*keys, *columns)


def _builtin(data: DataFrame, keys: list[str], columns: list[str], probs: list[float]) -> DataFrame:
    wanted = F.array(*[F.lit(p) for p in probs])
    return data.groupBy(*keys).agg(*[F.percentile(c, wanted).alias(c) for c in columns])


def _select(
    data: DataFrame, keys: list[str], columns: list[str], probs: list[float], hot: DataFrame, ranked: int
) -> DataFrame:
    targets = [(i, j, c, p) for i, c in enumerate(columns) for j, p in enumerate(probs)]

    band = 2.0 / SKETCH_ACCURACY
    edges = F.array(*[F.lit(e) for p in probs for e in (max(0.0, p - band), min(1.0, p + band))])
    bands = stage(
        data.groupBy(*keys).agg(
            *[F.percentile_approx(c, edges, SKETCH_ACCURACY).alias(f"_q{i}") for i, c in enumerate(columns)]
        ),
        "bands",
    )
    counted = (
        data.join(broadcast_if_small(bands), keys)
        .groupBy(*keys)
        .agg(
            *[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)],
            *[F.count_if(F.col(c) < _edge(i, 2 * j)).alias(f"_lt{i}_{j}") for i, j, c, _ in targets],
            *[F.count_if(F.col(c) <= _edge(i, 2 * j + 1)).alias(f"_le{i}_{j}") for i, j, c, _ in targets],
        )
    )
    limits = stage(
        counted.join(broadcast_if_small(bands), keys).select(
            *keys, *[_limits(i, j, p).alias(f"_t{i}_{j}") for i, j, _, p in targets]
        ),
        "limits",
    )

    def within(i: int, j: int, c: str) -> Column:
        low, high = F.col(f"_t{i}_{j}.low"), F.col(f"_t{i}_{j}.high")
        return F.col(c).isNotNull() & (low.isNull() | (F.col(c) >= low)) & (high.isNull() | (F.col(c) <= high))

    kept = [
        F.when(
            within(i, j, c),
            F.struct(F.lit(i).alias("_i"), F.lit(j).alias("_j"), F.col(c).cast("double").alias("_v")),
        )
        for i, j, c, _ in targets
    ]
    values = stage(
        data.join(broadcast_if_small(limits), keys)
        .filter(reduce(lambda a, b: a | b, [within(i, j, c) for i, j, c, _ in targets]))
        .select(*keys, F.explode(F.array_compact(F.array(*kept))).alias("_x"))
        .select(*keys, "_x.*")
        .groupBy(*keys, "_i", "_j", "_v")
        .agg(F.count(F.lit(1)).alias("_c")),
        "band-values",
    )
    each = [*keys, "_i", "_j"]
    goals = stage(
        limits.select(
            *keys,
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(i).alias("_i"), F.lit(j).alias("_j"),
                            *[F.col(f"_t{i}_{j}.{name}").alias(name) for name in ("r1", "r2", "share", "skipped")],
                        )
                        for i, j, _, _ in targets
                    ]
                )
            ),
        ),
        "goals",
    )
    values, goals = _narrowed(values, goals, each, ranked)
    upto = Window.partitionBy(*each).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.col("skipped") + F.col("_upto")
    found = (
        values.withColumn("_upto", F.sum("_c").over(upto))
        .join(broadcast_if_small(goals), each)
        .groupBy(*each)
        .agg(
            F.max(F.when((seen >= F.col("r1")) & (seen - F.col("_c") < F.col("r1")), F.col("_v"))).alias("_a"),
            F.max(F.when((seen >= F.col("r2")) & (seen - F.col("_c") < F.col("r2")), F.col("_v"))).alias("_b"),
            F.max("share").alias("_share"),
        )
        .withColumn("_value", F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_share"))
    )
    wide = found.groupBy(*keys).agg(
        *[
            F.array(
                *[
                    F.max(F.when((F.col("_i") == i) & (F.col("_j") == j), F.col("_value")))
                    for j in range(len(probs))
                ]
            ).alias(c)
            for i, c in enumerate(columns)
        ]
    )
    return limits.select(*keys).join(wide, keys, "left")


def _narrowed(
    values: DataFrame, goals: DataFrame, each: list[str], ranked: int
) -> tuple[DataFrame, DataFrame]:
    """``values`` (written: ``each``, ``_v``, ``_c``) cut down to ``ranked`` rows per target, ``goals`` made to fit.

    Bins hold equally many distinct values, so every round leaves a fixed share of them.
    """
    fractions = F.array(*[F.lit(k / BINS) for k in range(BINS + 1)])
    while True:
        sizes = values.groupBy(*each).agg(F.count(F.lit(1)).alias("_n"))
        large = stage(sizes.filter(F.col("_n") > ranked).select(*each), "wide-bands")
        if not large.head(1):
            return values, goals
        edges = stage(
            values.join(broadcast_if_small(large), each, "left_semi").groupBy(*each).agg(
                F.array_distinct(F.percentile_approx("_v", fractions, SKETCH_ACCURACY)).alias("_edges")
            ),
            "edges",
        )
        # rows of targets that are small enough already have no edges and bin 0
        binned = values.join(broadcast_if_small(edges), each, "left").withColumn(
            "_bin", F.coalesce(F.size(F.filter("_edges", lambda e: e <= F.col("_v"))), F.lit(0))
        ).drop("_edges")
        upto = Window.partitionBy(*each).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
        bins = binned.groupBy(*each, "_bin").agg(F.sum("_c").alias("_c")).withColumn("_upto", F.sum("_c").over(upto))
        seen = F.col("skipped") + F.col("_upto")
        meets = (seen >= F.col("r1")) & (seen - F.col("_c") < F.col("r2"))
        chosen = stage(
            bins.join(broadcast_if_small(goals), each).filter(meets).groupBy(*each).agg(
                F.min("_bin").alias("_low"), F.max("_bin").alias("_high"),
                F.min(F.col("_upto") - F.col("_c")).alias("_below"),
            ),
            "bins",
        )
        values = stage(
            binned.join(broadcast_if_small(chosen), each)
            .filter(F.col("_bin").between(F.col("_low"), F.col("_high"))).select(*each, "_v", "_c"),
            "narrower",
        )
        goals = stage(
            goals.join(broadcast_if_small(chosen), each, "left")
            .withColumn("skipped", F.col("skipped") + F.coalesce("_below", F.lit(0))).drop("_low", "_high", "_below"),
            "goals",
        )


def _edge(i: int, at: int) -> Column:
    return F.get(F.col(f"_q{i}"), F.lit(at))


def _limits(i: int, j: int, p: float) -> Column:
    """The two 1-based ranks to read and value limits that surely enclose them."""
    n = F.col(f"_n{i}")
    position = (n - 1) * F.lit(p)
    r1, r2 = F.floor(position) + 1, F.ceil(position) + 1
    below, upto = F.col(f"_lt{i}_{j}"), F.col(f"_le{i}_{j}")
    low_holds, high_holds = r1 > below, r2 <= upto
    return F.struct(
        r1.alias("r1"),
        r2.alias("r2"),
        (position - F.floor(position)).alias("share"),
        F.when(low_holds, below).otherwise(F.lit(0)).alias("skipped"),
        F.when(low_holds, _edge(i, 2 * j)).alias("low"),
        F.when(high_holds, _edge(i, 2 * j + 1)).alias("high"),
    )
