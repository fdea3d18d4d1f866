"""Global ranks without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.session import stage


def ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` (a written table) with ``_rank`` from 0 in this order, without a global window."""
    spark = df.sparkSession
    dealt = stage(
        df.withColumn("_turn", F.monotonically_increasing_id())
        .repartitionByRange(*order, "_turn").sortWithinPartitions(*order, "_turn").drop("_turn")
        .withColumn("_at", F.monotonically_increasing_id()),
        "sorted",
    ).withColumns({
        "_part": F.shiftrightunsigned("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    sizes = dealt.groupBy("_part").count().orderBy("_part").collect()  # one row per partition
    starts, total = [], 0
    for r in sizes:
        starts.append((r["_part"], total))
        total += r["count"]
    before = F.broadcast(spark.createDataFrame(starts, "_part long, _before long"))
    return dealt.join(before, "_part").withColumn("_rank", F.col("_before") + F.col("_at")).drop("_part", "_before", "_at")
