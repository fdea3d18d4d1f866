"""Tables that grow by whole runs: each run is seen once, or not at all.

A run has a key.  It first claims a number and a range of ids with a small file
``_claims/<number>.json``, moved into place by a rename that fails if the file is there: of
two writers one wins, and the other claims the next number.  It then writes its rows to a
hidden folder and renames that to ``_run=<number>``, which a plain Parquet reader of
the table takes for a partition.

* A run tried again finds its claim, writes the same ids, and finds its folder in place
  or puts it there: rows are never doubled.
* A crash leaves at most a claim and a hidden folder: readers see nothing of it, and
  ids of a run that never comes back stay unused.
* Ranges are disjoint whoever writes.

Renames must be atomic, as on HDFS and local disks.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLAIM = "run string, number long, first_id long, rows long"


class _Files:
    """The few file operations needed, on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        fs = spark._jvm.org.apache.hadoop.fs
        self._path = fs.Path
        conf = spark._jsc.hadoopConfiguration()
        self._fs = fs.Path(path).getFileSystem(conf)
        self._context = fs.FileContext.getFileContext(self._fs.getUri(), conf)
        rename = getattr(fs, "Options$Rename")
        self._never_over = spark.sparkContext._gateway.new_array(rename, 1)
        self._never_over[0] = rename.NONE

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def write(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()

    def move(self, source: str, target: str) -> bool:
        """Whether the rename took place; it never replaces what is there."""
        try:
            self._context.rename(self._path(source), self._path(target), self._never_over)
        except Py4JJavaError as failure:
            if "FileAlreadyExists" not in failure.java_exception.getClass().getName() and not self.exists(target):
                raise
            return False
        return True

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def claims(spark: SparkSession, path: str) -> DataFrame:
    """One row per claim."""
    try:
        return spark.read.schema(CLAIM).json(f"{path}/_claims/*.json")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CLAIM)


def _state(spark: SparkSession, path: str, run: str):
    """The run's own claim, if any, and the last number and id claimed: one row, however many runs."""
    own = F.col("run") == run
    return claims(spark, path).agg(
        F.max(F.when(own, F.struct("number", "first_id", "rows"))).alias("own"),
        F.coalesce(F.max("number"), F.lit(0)).alias("number"),
        F.coalesce(F.max(F.col("first_id") + F.col("rows")), F.lit(0)).alias("next_id"),
    ).first()


def claim(spark: SparkSession, path: str, run: str, rows: int) -> tuple[int, int]:
    """Number and first id of the run, claimed now or when it was tried before."""
    files = _Files(spark, path)
    while True:
        state = _state(spark, path, run)
        if state["own"] is not None:
            if state["own"]["rows"] != rows:
                raise ValueError(f"run {run!r} claimed {state['own']['rows']} rows before and has {rows} now")
            return state["own"]["number"], state["own"]["first_id"]
        number = state["number"] + 1
        entry = {"run": run, "number": number, "first_id": state["next_id"], "rows": rows}
        draft = f"{path}/_drafts/{uuid.uuid4().hex}.json"
        files.write(draft, json.dumps(entry))
        files.make(f"{path}/_claims")
        if files.move(draft, f"{path}/_claims/{number:012d}.json"):
            return number, state["next_id"]
        files.remove(draft)


def is_there(spark: SparkSession, path: str, run: str) -> bool:
    """Whether the rows of the run can be seen."""
    own = _state(spark, path, run)["own"]
    return own is not None and _Files(spark, path).exists(f"{path}/_run={own['number']}")


def append_once(rows: DataFrame, path: str, run: str, position: str | None = None, id_column: str = "record_id") -> bool:
    """Add the rows of a run to the table at ``path``; False if the run is there already.

    ``rows`` must be a written table, or follow from written tables alone.  With ``position`` (1-based, gapless) ids are
    ``id_column`` = first id of the run's range + position.
    """
    spark = rows.sparkSession
    number, first = claim(spark, path, run, rows.count())
    target, files = f"{path}/_run={number}", _Files(spark, path)
    if files.exists(target):
        return False
    if position:
        rows = rows.withColumn(id_column, F.col(position) + F.lit(first))
        rows = rows if position == id_column else rows.drop(position)
    hidden = f"{path}/_writing/{uuid.uuid4().hex}"
    rows.write.parquet(hidden)
    if files.move(hidden, target):
        return True
    files.remove(hidden)
    return False
