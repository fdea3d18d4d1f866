"""Data quality: missing values, duplicates, outliers, cleaning, time consistency.

Table-wide reports take one pass where possible.  Duplicates are found by 128-bit digests of
the rows: digests are counted first, which moves 16 bytes a row, and only rows whose
digest stands twice are grouped on all columns, so rows that merely share a digest stay
apart.  Grouping collapses copies before each shuffle: a row repeated billions of
times is no hot key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.operators.features import numeric_features
from kpiloom.operators.percentiles import LARGE_GROUP, group_percentiles
from kpiloom.operators.sliding import PARTS, window_aggregates
from kpiloom.session import BROADCAST_LIMIT_BYTES, stage


# ---- per-incident batches ------------------------------------------------------------------

def quality_aggregates(features: list[str]) -> list[Column]:
    """``n_rows`` and ``_share`` (missing share over all features) of a group of samples."""
    share = F.avg(E.missing_count(features) / F.lit(float(len(features))))
    return [F.count(F.lit(1)).alias("n_rows"), share.alias("_share")]


def batch_quality(batches: DataFrame, features: list[str], case: str = "case_id") -> DataFrame:
    """Rows, missing share over all features, and severity band of each batch."""
    return (
        batches.groupBy(case)
        .agg(*quality_aggregates(features))
        .select(
            case,
            "n_rows",
            (F.col("_share") * 100).alias("missing_pct"),
            F.lit(fv.ISSUE_BASIC_CHECK).alias("issues"),
            E.severity("_share").alias("severity"),
        )
    )


def window_values(features: list[str]) -> dict[str, tuple[Column, str]]:
    """What :func:`window_quality` sums over the samples of a window."""
    return {
        "n_rows": (F.lit(1).cast("bigint"), "sum"),
        "_missing": (E.missing_count(features).cast("bigint"), "sum"),
    }


def window_share(features: list[str]) -> Column:
    """Missing share of a window from its sums."""
    return F.col("_missing") / (F.col("n_rows") * F.lit(float(len(features))))


def window_quality(
    cases: DataFrame, samples: DataFrame, features: list[str], before_seconds: int, after_seconds: int = 0,
    entity: str = "cell_name", ts: str = "ts", parts: int = PARTS,
) -> DataFrame:
    """:func:`batch_quality` of each case's window, without building the batches."""
    summed = window_aggregates(
        cases, samples, before_seconds, after_seconds, window_values(features), entity, ts, parts
    ).withColumn("_share", window_share(features))
    return summed.select(
        "case_id",
        "n_rows",
        (F.col("_share") * 100).alias("missing_pct"),
        F.lit(fv.ISSUE_BASIC_CHECK).alias("issues"),
        E.severity("_share").alias("severity"),
    )


def batch_stats(batches: DataFrame, features: list[str], case: str = "case_id", n_stats: int = 5) -> DataFrame:
    """Rows per batch; mean, missing count and missing percent of the first features."""
    shown = features[:n_stats]
    aggregates = [F.count(F.lit(1)).alias("total_rows")]
    for c in shown:
        aggregates += [
            F.avg(c).alias(f"{c}_mean"),
            F.count_if(F.col(c).isNull()).alias(f"{c}_missing"),
            (F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"{c}_missing_pct"),
        ]
    return (
        batches.groupBy(case)
        .agg(*aggregates)
        .withColumn("columns", E.lit_array(features[:10]))
    )


def window_stats(
    cases: DataFrame, samples: DataFrame, features: list[str], before_seconds: int, after_seconds: int = 0,
    n_stats: int = 5, entity: str = "cell_name", ts: str = "ts", parts: int = PARTS,
) -> DataFrame:
    """:func:`batch_stats` of each case's window, without building the batches."""
    shown = features[:n_stats]
    values: dict[str, tuple[Column, str]] = {"total_rows": (F.lit(1).cast("bigint"), "sum")}
    for c in shown:
        values |= {f"_sum_{c}": (F.col(c).cast("double"), "sum"), f"_n_{c}": (F.col(c).isNotNull().cast("bigint"), "sum")}
    summed = window_aggregates(cases, samples, before_seconds, after_seconds, values, entity, ts, parts)
    columns = []
    for c in shown:
        missing = F.col("total_rows") - F.col(f"_n_{c}")
        columns += [
            F.try_divide(F.col(f"_sum_{c}"), F.col(f"_n_{c}")).alias(f"{c}_mean"),
            missing.alias(f"{c}_missing"),
            (missing / F.col("total_rows") * 100).alias(f"{c}_missing_pct"),
        ]
    return summed.select("case_id", "total_rows", *columns, E.lit_array(features[:10]).alias("columns"))


# ---- whole-table reports -------------------------------------------------------------------

def row_digest(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of all columns of a row, equal for rows that grouping takes for equal."""
    values = [
        F.col(f.name) + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    # a hash skips NULLs, so which columns are NULL is hashed too
    missing = F.concat(*[F.when(F.col(f.name).isNull(), F.lit("1")).otherwise(F.lit("0")) for f in df.schema.fields])
    return [F.xxhash64(missing, *values), F.xxhash64(F.lit("second"), *reversed(values), missing)]


def _by_digest(df: DataFrame, digest=row_digest) -> tuple[DataFrame, DataFrame | None]:
    """Distinct rows whose digest stands twice, with ``_copies``; and all other rows.

    Repeated digests are broadcast after a check of their size.  Where they are too many,
    most rows are repeated: then all rows are grouped, and there are no others.
    """
    h1, h2 = digest(df)
    keyed = df.withColumns({"_h1": h1, "_h2": h2})
    twice = stage(
        keyed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_h1", "_h2"), "repeated"
    )
    suspects, others = df, None
    if twice.count() * 64 <= BROADCAST_LIMIT_BYTES:
        suspects = keyed.join(F.broadcast(twice), ["_h1", "_h2"], "left_semi").select(df.columns)
        others = keyed.join(F.broadcast(twice), ["_h1", "_h2"], "left_anti").select(df.columns)
    return suspects.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")), others


def duplicate_count(df: DataFrame, digest=row_digest) -> DataFrame:
    """Rows equal on all columns to another row, minus one per set of copies."""
    copies, _ = _by_digest(df, digest)
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("n_duplicates"))


def _null_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )


def _melt(df: DataFrame, columns: list[str], fields: dict[str, list[Column]], keep: list[str]) -> DataFrame:
    """One output row per column from a one-row table (a fixed number of columns)."""
    rows = [
        F.struct(F.lit(c).alias("column"), *[values[i].alias(name) for name, values in fields.items()])
        for i, c in enumerate(columns)
    ]
    return df.select(*keep, F.inline(F.array(*rows)))


def missing_by_column(df: DataFrame) -> DataFrame:
    """Columns with NULLs: count, percent of rows and data type."""
    types = dict(df.dtypes)
    long = _melt(
        _null_counts(df),
        df.columns,
        {
            "missing_count": [F.col(c) for c in df.columns],
            "data_type": [F.lit(types[c]) for c in df.columns],
        },
        ["_rows"],
    )
    return long.filter("missing_count > 0").select(
        "column",
        "missing_count",
        (F.col("missing_count") / F.col("_rows") * 100).alias("missing_pct"),
        "data_type",
    )


def missing_overview(df: DataFrame) -> DataFrame:
    """Missing cells, their percentage, rows with and without any NULL."""
    missing = E.missing_count(df.columns)
    return df.agg(
        F.coalesce(F.sum(missing), F.lit(0)).alias("total_missing"),
        F.try_divide(F.sum(missing) * 100.0, F.count(F.lit(1)) * len(df.columns)).alias("missing_pct"),
        F.count_if(missing > 0).alias("rows_with_missing"),
        F.count_if(missing == 0).alias("complete_rows"),
    )


def dtype_report(df: DataFrame) -> DataFrame:
    """One row per column: its type, next to the number of rows and columns."""
    types = dict(df.dtypes)
    return _melt(
        df.agg(F.count(F.lit(1)).alias("total_rows"), F.lit(len(df.columns)).alias("total_columns")),
        df.columns,
        {"data_type": [F.lit(types[c]) for c in df.columns]},
        ["total_rows", "total_columns"],
    )


def _totals(df: DataFrame, min_frac: float, digest) -> DataFrame:
    """One row: rows, rows dense enough, missing cells, duplicates, and duplicates among the dense rows."""
    missing = E.missing_count(df.columns)
    dense = len(df.columns) - missing >= math.ceil(len(df.columns) * min_frac)
    zero = F.lit(0).cast("bigint")
    copies, _ = _by_digest(df, digest)
    whole = df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(dense).alias("_dense"), F.sum(missing).cast("bigint").alias("_missing"),
        zero.alias("n_duplicates"), zero.alias("_dense_duplicates"),
    )
    repeated = copies.agg(
        zero.alias("total_rows"), zero.alias("_dense"), zero.alias("_missing"),
        F.sum(F.col("_copies") - 1).alias("n_duplicates"),
        F.sum(F.when(dense, F.col("_copies") - 1)).alias("_dense_duplicates"),
    )
    both = whole.unionByName(repeated)  # two rows
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in both.columns])


def _score(n_columns: int) -> Column:
    """100 minus missing percent minus duplicate percent, not below 0, from the totals."""
    missing = F.coalesce(F.try_divide(F.col("_missing") * 100.0, F.col("total_rows") * n_columns), F.lit(0.0))
    duplicated = F.coalesce(F.try_divide(F.col("n_duplicates") * 100.0, F.col("total_rows")), F.lit(0.0))
    return F.round(F.greatest(F.lit(0.0), F.lit(100.0) - missing - duplicated), 2).alias("quality_score")


def quality_score(df: DataFrame, digest=row_digest) -> DataFrame:
    """100 minus mean missing percent minus duplicate percent, not below 0."""
    n_cols = len(df.columns)
    return _totals(df, 0.0, digest).select("total_rows", F.lit(n_cols).alias("total_columns"), "n_duplicates", _score(n_cols))


def _stats_row(df: DataFrame, columns: list[str], large: int) -> dict[str, dict]:
    """Quartiles, mean and deviation of each column as one driver-side row of scalars."""
    quartiles = group_percentiles(df, [], columns, [0.25, 0.75], large).first()
    moments = df.agg(
        *[f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_samp))]
    ).first()
    stats = {}
    for i, c in enumerate(columns):
        q1, q3 = quartiles[c] if quartiles and quartiles[c] else (None, None)
        if q1 is None:
            continue
        stats[c] = {
            "lower": q1 - 1.5 * (q3 - q1),
            "upper": q3 + 1.5 * (q3 - q1),
            "mean": moments[f"m_{i}"],
            "std": moments[f"s_{i}"],
        }
    return stats


def outlier_report(
    df: DataFrame,
    columns: list[str] | None = None,
    threshold: float = 3.0,
    only_hits: bool = True,
    large: int = LARGE_GROUP,
) -> DataFrame:
    """Outliers per numeric column by quartile fences and by z-score.

    Columns without any value are left out.  The grand total counts fence
    outliers only.  Bounds and moments enter the counting pass as literals, so
    that pass is one aggregate without a join.
    """
    columns = columns or numeric_features(df)
    stats = _stats_row(df, columns, large) if columns else {}
    columns = list(stats)
    if not columns:
        return df.sparkSession.createDataFrame([], _OUTLIER_SCHEMA)
    counts = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        s = stats[c]
        counts.append(F.count_if((F.col(c) < s["lower"]) | (F.col(c) > s["upper"])).alias(f"_iqr{i}"))
        if s["std"]:
            z = F.abs((F.col(c) - F.lit(s["mean"])) / F.lit(s["std"]))
            counts.append(F.count_if(z > threshold).alias(f"_z{i}"))
        else:
            counts.append(F.lit(0).cast("bigint").alias(f"_z{i}"))
    counted = df.agg(*counts).withColumn("total_outliers", sum((F.col(f"_iqr{i}") for i in range(len(columns))), F.lit(0)))

    def constants(name: str) -> list[Column]:
        return [F.lit(stats[c][name]).cast("double") for c in columns]

    long = _melt(
        counted,
        columns,
        {
            "iqr_outliers": [F.col(f"_iqr{i}") for i in range(len(columns))],
            "z_score_outliers": [F.col(f"_z{i}") for i in range(len(columns))],
            "pct": [F.try_divide(F.col(f"_iqr{i}") * 100.0, F.col("_rows")) for i in range(len(columns))],
            "lower_bound": constants("lower"),
            "upper_bound": constants("upper"),
            "mean": constants("mean"),
            "std": constants("std"),
        },
        ["total_outliers"],
    )
    if only_hits:
        long = long.filter("iqr_outliers > 0 OR z_score_outliers > 0")
    return long.select(*_OUTLIER_SCHEMA.names)


_OUTLIER_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("iqr_outliers", T.LongType()),
        T.StructField("z_score_outliers", T.LongType()),
        T.StructField("pct", T.DoubleType()),
        T.StructField("lower_bound", T.DoubleType()),
        T.StructField("upper_bound", T.DoubleType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
        T.StructField("total_outliers", T.LongType()),
    ]
)


def iqr_outliers(df: DataFrame, columns: list[str] | None = None, **options) -> DataFrame:
    """Fence bounds, count and percent of every numeric column that has values."""
    report = outlier_report(df, columns, only_hits=False, **options)
    return report.select("column", "iqr_outliers", "pct", "lower_bound", "upper_bound")


def zscore_outliers(df: DataFrame, columns: list[str] | None = None, threshold: float = 3.0) -> DataFrame:
    """Rows further than ``threshold`` sample deviations from the mean, per column."""
    columns = columns or numeric_features(df)
    moments = df.agg(
        *[f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_samp))]
    ).first()
    counts = []
    for i, c in enumerate(columns):
        mean, std = moments[f"m_{i}"], moments[f"s_{i}"]
        far = F.abs((F.col(c) - F.lit(mean)) / F.lit(std)) > threshold if std else F.lit(False)
        counts.append(F.count_if(far).alias(f"_z{i}"))
    return _melt(
        df.agg(*counts),
        columns,
        {
            "z_score_outliers": [F.col(f"_z{i}") for i in range(len(columns))],
            "mean": [F.lit(moments[f"m_{i}"]).cast("double") for i in range(len(columns))],
            "std": [F.lit(moments[f"s_{i}"]).cast("double") for i in range(len(columns))],
        },
        [],
    )


# ---- cleaning ------------------------------------------------------------------------------

def drop_exact_duplicates(df: DataFrame, digest=row_digest) -> DataFrame:
    """One row of each set of copies; rows without a copy never move."""
    copies, others = _by_digest(df, digest)
    copies = copies.drop("_copies")
    return copies if others is None else others.unionByName(copies)


def drop_sparse_rows(df: DataFrame, min_frac: float = 0.5) -> DataFrame:
    """Keep rows with at least this share of non-NULL columns (exactly half stays)."""
    return df.dropna(thresh=math.ceil(len(df.columns) * min_frac))


def append_rows(df: DataFrame, more: DataFrame) -> DataFrame:
    return df.unionByName(more)


def clean(df: DataFrame, min_frac: float = 0.5) -> DataFrame:
    """Exact duplicates out, then sparse rows.

    The sparse filter is a pure row filter and copies share its verdict, so it
    runs first: less data reaches the shuffle and the result is the same.
    """
    return drop_exact_duplicates(drop_sparse_rows(df, min_frac))


def clean_summary(df: DataFrame, min_frac: float = 0.5, digest=row_digest) -> DataFrame:
    """Total, clean and removed rows next to the quality score."""
    clean_rows = F.col("_dense") - F.col("_dense_duplicates")
    return _totals(df, min_frac, digest).select(
        "total_rows", clean_rows.alias("clean_rows"), (F.col("total_rows") - clean_rows).alias("rows_removed"),
        _score(len(df.columns)),
    )


# ---- time and range consistency ------------------------------------------------------------

def timestamp_issues(
    df: DataFrame,
    expected_gap_seconds: int,
    entity: str = "cell_name",
    ts: str = "ts",
    bucket_seconds: int = 86_400,
) -> DataFrame:
    """Per entity: repeated timestamps, and gaps between samples above the expected one.

    Samples first collapse to distinct (entity, time).  Gaps are then taken
    inside time buckets, and across buckets from the first and last time of each
    bucket, so one entity's whole history never meets in one task.
    """
    times = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(entity, ts)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_t", E.epoch_micros(ts))
        .withColumn("_bucket", F.floor(F.col("_t") / (bucket_seconds * 1_000_000)))
    )
    inside = Window.partitionBy(entity, "_bucket").orderBy("_t")
    gap = (F.col("_t") - F.lag("_t").over(inside)) / F.lit(1_000_000.0)
    buckets = (
        times.withColumn("_gap", gap)
        .groupBy(entity, "_bucket")
        .agg(
            F.sum(F.col("_n") - 1).alias("_dups"),
            F.count_if(F.col("_gap") > expected_gap_seconds).alias("_gaps"),
            F.max("_gap").alias("_max_gap"),
            F.min("_t").alias("_from"),
            F.max("_t").alias("_to"),
        )
    )
    across = Window.partitionBy(entity).orderBy("_bucket")
    jump = (F.col("_from") - F.lag("_to").over(across)) / F.lit(1_000_000.0)
    return (
        buckets.withColumn("_jump", jump)
        .groupBy(entity)
        .agg(
            F.sum("_dups").alias("duplicate_timestamps"),
            (F.sum("_gaps") + F.count_if(F.col("_jump") > expected_gap_seconds)).alias("gaps"),
            F.greatest(F.max("_max_gap"), F.max("_jump")).alias("max_gap_seconds"),
        )
    )


def range_violations(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Values below or above the allowed range, per bounded column (one aggregate)."""
    columns = [c for c in bounds if c in df.columns]
    counts = []
    for i, c in enumerate(columns):
        low, high = bounds[c]
        counts.append(F.count_if(F.col(c) < low if low is not None else F.lit(False)).alias(f"_lo{i}"))
        counts.append(F.count_if(F.col(c) > high if high is not None else F.lit(False)).alias(f"_hi{i}"))
    return _melt(
        df.agg(*counts),
        columns,
        {
            "below_min": [F.col(f"_lo{i}") for i in range(len(columns))],
            "above_max": [F.col(f"_hi{i}") for i in range(len(columns))],
        },
        [],
    )
