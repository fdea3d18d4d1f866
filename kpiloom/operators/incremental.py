"""Baselines and profiles kept up to date from mergeable summaries; history is not read again.

Every batch of samples leaves one row per entity and day: counts, and a KLL sketch of each
feature's normal values; and one row per day: rows, missing cells by column, an HLL sketch
of the entities.  Sketches merge in any order, so late days are rows like any others.  A
batch is added once under its key, however often it is tried.

Counts are exact.  A median lies within ``RANK_ERROR`` of the middle rank (with
``KLL_SIZE``, for all features of all entities together, in practice far nearer), the
number of entities within 2 percent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.features import normals
from kpiloom.session import stage
from kpiloom.sources import commits

#: Items a KLL sketch keeps per level, the rank error it is good for, and the HLL's registers (2 ** 12).
KLL_SIZE = 800
RANK_ERROR = 0.01
HLL_BITS = 12


def entity_days(
    df: DataFrame, features: list[str], entity: str = "cell_name", ts: str = "ts", label: str | None = "is_anomaly"
) -> DataFrame:
    """``entity, day, n_normal``, and per feature the count ``n_`` and sketch ``kll_`` of its normal values."""
    rows = (normals(df, label) if label else df).filter(F.col(entity).isNotNull())
    return rows.groupBy(entity, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n_normal"),
        *[F.count(c).alias(f"n_{c}") for c in features],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_SIZE).alias(f"kll_{c}") for c in features],
    )


def table_days(df: DataFrame, entity: str = "cell_name", ts: str = "ts") -> DataFrame:
    """``day, n_rows``, an HLL sketch of the entities, and the missing cells of every column (``missing_``)."""
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.hll_sketch_agg(F.col(entity).cast("string"), HLL_BITS).alias("hll_entities"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in df.columns],
    )


def add_batch(
    df: DataFrame, path: str, run: str, features: list[str], entity: str = "cell_name", ts: str = "ts",
    label: str | None = "is_anomaly",
) -> None:
    """Summarize a batch of samples into the state below ``path``, once per run key."""
    commits.append_once(stage(entity_days(df, features, entity, ts, label), "entity-days"), f"{path}/entities", run)
    commits.append_once(stage(table_days(df, entity, ts), "table-days"), f"{path}/table", run)


def baselines(spark: SparkSession, path: str, features: list[str], entity: str = "cell_name") -> DataFrame:
    """Median of every feature per entity, from the state alone; NULL without a value."""
    merged = spark.read.parquet(f"{path}/entities").groupBy(entity).agg(
        *[F.sum(f"n_{c}").alias(f"n_{c}") for c in features],
        *[F.kll_merge_agg_double(F.when(F.col(f"n_{c}") > 0, F.col(f"kll_{c}"))).alias(f"kll_{c}") for c in features],
    )
    return merged.select(
        entity,
        *[F.when(F.col(f"n_{c}") > 0, F.kll_sketch_get_quantile_double(f"kll_{c}", F.lit(0.5))).alias(c) for c in features],
    )


def profile(spark: SparkSession, path: str, features: list[str]) -> DataFrame:
    """Rows, distinct entities (estimated) and number of features in one row."""
    return spark.read.parquet(f"{path}/table").agg(
        F.sum("n_rows").alias("n_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("hll_entities")).alias("n_entities"),
    ).withColumn("n_features", F.lit(len(features)))


def missing_by_column(spark: SparkSession, path: str) -> DataFrame:
    """Columns with NULLs: count and percent of rows."""
    state = spark.read.parquet(f"{path}/table")
    names = [c.removeprefix("missing_") for c in state.columns if c.startswith("missing_")]
    totals = state.agg(F.sum("n_rows").alias("_rows"), *[F.sum(f"missing_{c}").alias(f"missing_{c}") for c in names])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"missing_{c}").alias("missing_count")) for c in names]
    return totals.select("_rows", F.inline(F.array(*cells))).filter("missing_count > 0").select(
        "column", "missing_count", (F.col("missing_count") / F.col("_rows") * 100).alias("missing_pct")
    )
