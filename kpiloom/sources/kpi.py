"""Reading the KPI fact table: one row per entity and sample time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.fixed_values import RAW_KPIS, SOURCE_COLUMNS

_CANONICAL_TO_SOURCE = {v: k for k, v in SOURCE_COLUMNS.items()}


def kpi_schema(dotted: bool = True, extra: list[T.StructField] | None = None) -> T.StructType:
    """Explicit schema of a KPI CSV file, with time as text (see :func:`parse_ts`)."""
    name = (lambda c: _CANONICAL_TO_SOURCE.get(c, c)) if dotted else (lambda c: c)
    fields = [
        T.StructField("cell_name", T.StringType()),
        T.StructField(name("ts"), T.StringType()),
        T.StructField("is_anomaly", T.BooleanType()),
        *[T.StructField(name(c), T.DoubleType()) for c in RAW_KPIS],
    ]
    return T.StructType((extra or []) + fields)


def rename_sources(df: DataFrame) -> DataFrame:
    """Dotted column names to canonical ones; names already canonical stay."""
    return df.toDF(*[SOURCE_COLUMNS.get(c, c) for c in df.columns])


def normalize_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float column: one notion of *missing* everywhere."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def parse_ts(df: DataFrame, column: str = "ts", fmt: str | None = None) -> DataFrame:
    """Text to naive timestamp; a value that does not parse raises."""
    if fmt:
        return df.withColumn(column, F.to_timestamp_ntz(F.col(column), F.lit(fmt)))
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def read_kpi_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV scan with header.

    Pass a schema whenever the columns are known: inference costs an additional
    pass over the files.  Without one, types are inferred and time stays text
    until it is parsed here.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        raw = reader.option("inferSchema", True).option("inferTimestamp", False).csv(path)
    else:
        raw = reader.schema(schema).csv(path)
    return normalize_nan(parse_ts(rename_sources(raw)))


def sort_kpi(df: DataFrame, entity: str = "cell_name", ts: str = "ts", tiebreak: str = "event_id") -> DataFrame:
    """Total order by entity and time (range-partitioned sort, no single task)."""
    return df.orderBy(entity, ts, tiebreak)
