"""A stored layout for samples: partitioned by day, bucketed and sorted by entity.

A range of days reads only its partitions, and tables bucketed alike join or group by
entity without moving a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a day; tables that are to be joined must have the same number.
BUCKETS = 64


def write_samples(
    df: DataFrame, table: str, path: str, entity: str = "cell_name", ts: str = "ts", buckets: int = BUCKETS
) -> None:
    """Save samples as ``table``, files below ``path``; every day's bucket is one sorted file."""
    dated = df.withColumn("day", F.to_date(ts))
    # one task per day and bucket, so a day does not become buckets x tasks small files
    placed = dated.repartition("day", F.pmod(F.hash(entity), F.lit(buckets)))
    placed.write.mode("overwrite").option("path", path).partitionBy("day").bucketBy(buckets, entity).sortBy(entity, ts).saveAsTable(table)


def write_entities(df: DataFrame, table: str, path: str, entity: str = "cell_name", buckets: int = BUCKETS) -> None:
    """Save one row per entity (baselines) in the same buckets."""
    placed = df.repartition(F.pmod(F.hash(entity), F.lit(buckets)))
    placed.write.mode("overwrite").option("path", path).bucketBy(buckets, entity).sortBy(entity).saveAsTable(table)


def with_stored_baseline(
    spark: SparkSession, samples: str, baselines: str, metrics: list[str], entity: str = "cell_name", prefix: str = "base_"
) -> DataFrame:
    """Samples with their entity's baseline columns, joined bucket by bucket: no exchange, whatever the sizes."""
    looked_up = spark.table(baselines).select(entity, *[F.col(m).alias(prefix + m) for m in metrics])
    return spark.table(samples).join(looked_up.hint("merge"), entity, "left")


def stored_between(spark: SparkSession, samples: str, entity_value, start, end, entity: str = "cell_name", ts: str = "ts") -> DataFrame:
    """Rows of one entity with both time limits included; reads one bucket of the days in question."""
    start, end = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    return spark.table(samples).filter(
        (F.col(entity) == entity_value) & F.col(ts).between(start, end) & F.col("day").between(start.cast("date"), end.cast("date"))
    ).drop("day")
