"""Session defaults, staged tables and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper limit for anything this package hints as a broadcast.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def build_session(app: str = "kpiloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC, ANSI and adaptive execution; ``master`` only for local runs."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder is used only when the setting is missing *and* the
    session is local; on a cluster the setting is required, because a folder of
    one machine is lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kpiloom-"))
    return spark.conf.get("spark.checkpoint.dir")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in one folder per application.

    Whoever owns the shared folder can drop ``kpiloom/<application id>`` once the
    application has ended.
    """
    run = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/kpiloom/{run}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and gives the optimizer
    the true table size, so its own broadcast threshold becomes a checked bound.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_bytes(table: DataFrame, limit_bytes: int) -> int:
    """Bytes that the rows of a *staged* table take; counted no further than it takes to pass the limit.

    The number of rows is a Parquet metadata read.  Only where texts and nested columns
    could make the difference are they measured, in one pass over those columns.
    """
    fixed, loose = 0, []
    for field in table.schema.fields:
        fixed += 16
        if field.dataType.typeName() in ("string", "binary"):
            loose.append(F.octet_length(F.col(field.name)))
        elif field.dataType.typeName() in ("array", "map", "struct", "variant"):
            loose.append(F.octet_length(F.to_json(F.struct(F.col(field.name)))) * 2)
    size = table.count() * fixed
    if loose and size <= limit_bytes:
        total = table.agg(F.sum(sum((F.coalesce(x, F.lit(0)) for x in loose), F.lit(0)).cast("bigint"))).first()[0]
        size += total or 0
    return size


def broadcast_if_small(table: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring a *staged* table.

    Above the limit the table is returned without a hint: the join shuffles, and
    adaptive execution splits hot keys.
    """
    return F.broadcast(table) if table_bytes(table, limit_bytes) <= limit_bytes else table


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores on an input that arrives in fewer splits than there are cores.

    One file with one row group is a single task, whatever the cluster.  Large
    inputs have more splits than cores and come back untouched.  Pass a plain
    scan: asking for its partitions must not run a query.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() * 2 <= cores else scan


def ship(spark: SparkSession) -> None:
    """Let local Python workers import this package from where the driver did.

    On a cluster the package comes with ``--py-files`` or is installed; there the
    extra entry on the workers' path does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
