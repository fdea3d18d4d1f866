"""Writing and reloading what a run leaves behind."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.session import broadcast_if_small, stage
from kpiloom.sources import commits
from kpiloom.sources.kpi import normalize_nan


def write_baselines(df: DataFrame, path: str, entity: str = "cell_name") -> None:
    """CSV with the entity column first and doubles in full precision."""
    ordered = [entity] + [c for c in df.columns if c != entity]
    df.select(ordered).write.mode("overwrite").option("header", True).csv(path)


def read_baselines(spark: SparkSession, path: str, features: list[str], entity: str = "cell_name") -> DataFrame:
    schema = T.StructType(
        [T.StructField(entity, T.StringType())] + [T.StructField(f, T.DoubleType()) for f in features]
    )
    return normalize_nan(spark.read.option("header", True).schema(schema).csv(path))


def write_cases(df: DataFrame, path: str) -> None:
    """Case history as JSON lines, nested columns kept as nested JSON."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def global_row_number(df: DataFrame, order: list, out: str = "row_no", start: int = 0) -> DataFrame:
    """1-based position in a total order, without a window over one partition.

    The rows are range-sorted and staged with their partition number and their
    offset inside it; only the per-partition counts (one row per partition) are
    summed up to give each partition its start.
    """
    placed = stage(
        df.orderBy(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_pos", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_id"),
        "ordered",
    )
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "starts"
    )
    return (
        placed.join(broadcast_if_small(starts), "_part")
        .withColumn(out, F.col("_start") + F.col("_pos") + F.lit(start + 1))
        .drop("_part", "_pos", "_start")
    )


def record_cases(cases: DataFrame, path: str, order: list, id_column: str = "record_id", run: str | None = None) -> bool:
    """Append cases to the history table once per run key; ids go on from the highest one claimed.

    Without a key every call is a run of its own.  False if the run is there already: its
    rows are counted, but not sorted and written again.
    """
    if run and commits.is_there(cases.sparkSession, path, run):
        commits.claim(cases.sparkSession, path, run, cases.count())  # fails if it has other rows now
        return False
    numbered = global_row_number(cases, order, id_column)  # of written tables: the same whenever it is read
    return commits.append_once(numbered, path, run or uuid.uuid4().hex, position=id_column, id_column=id_column)
