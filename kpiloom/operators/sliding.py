"""Windows around cases, without pairs of cases and samples.

A case asks for the samples of its entity with ``t0 - before <= time <= t0 + after``.  Time
is cut into buckets of a fixed part of that width, so the two ends of every window lie
exactly ``parts`` buckets apart.  Samples and window ends go into one table ordered inside
(entity, bucket):

* an aggregate of a window is that of the samples from its start to the end of the start's
  bucket, of the whole buckets in between, and of the samples from the beginning of the
  end's bucket to its end.  Sums and maxima run along both orders; nothing is subtracted,
  so no digit is lost.
* the last sample of a window is the last one before its end in the end's bucket or, if
  there is none, in a bucket before.

* the first samples of a window are numbered: samples by their place in the order of their
  entity (that inside the bucket behind the number of samples in all buckets before), and a
  window's start by how many lie before it.  Its first samples have the next numbers.

Whole buckets are rows of a second, much smaller table (collapsed before its shuffle), which
is treated alike, ``parts`` buckets to a block.  A sample moves once whatever the number of
cases, and an entity that holds a third of all rows is spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions import expr as E

#: Buckets to a window: a power of two, so that whole seconds divide evenly.
PARTS = 16
_MERGE = {"sum": F.sum, "max": F.max, "min": F.min}
_START, _SAMPLE, _END = -1, 0, 1


def _width(before_seconds: int, after_seconds: int, parts: int) -> int:
    """Microseconds of a bucket."""
    micros = (before_seconds + after_seconds) * 1_000_000
    if micros <= 0 or micros % parts:
        raise ValueError("a window must be longer than nothing and divide evenly into its buckets")
    return micros // parts


def _bucket(column: Column, width: int) -> Column:
    """Number of the bucket, counted down from the epoch before it."""
    whole = column - F.pmod(column, F.lit(width).cast("bigint"))
    return F.call_function("div", whole, F.lit(width).cast("bigint"))


def _ends(cases: DataFrame, before: int, after: int, entity: str) -> DataFrame:
    """``case_id, entity, _from, _to`` in microseconds."""
    t0 = E.epoch_micros("t0")
    return cases.where(F.col(entity).isNotNull() & F.col("t0").isNotNull()).select(
        "case_id", entity, (t0 - before * 1_000_000).alias("_from"), (t0 + after * 1_000_000).alias("_to")
    )


def _along(points: DataFrame, entity: str, merges: dict[str, str]) -> DataFrame:
    """``case_id`` and aggregates of the points after a start and up to an end, inside (entity, ``_b``).

    ``points`` has ``_b``, place ``_at``, ``_kind``, ``case_id`` and one column per aggregate.
    """
    inside = Window.partitionBy(entity, "_b")
    upto = inside.orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    onward = inside.orderBy(F.desc("_at"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    values = {
        name: F.when(F.col("_kind") == _END, _MERGE[merge](name).over(upto)).otherwise(_MERGE[merge](name).over(onward))
        for name, merge in merges.items()
    }
    found = points.select("_kind", "case_id", *[v.alias(n) for n, v in values.items()])
    return found.where(F.col("_kind") != _SAMPLE).drop("_kind")


def window_aggregates(
    cases: DataFrame,
    samples: DataFrame,
    before_seconds: int,
    after_seconds: int,
    values: dict[str, tuple[Column, str]],
    entity: str = "cell_name",
    ts: str = "ts",
    parts: int = PARTS,
) -> DataFrame:
    """``case_id`` and aggregates of its window: name -> (column of the samples, ``sum``, ``max`` or ``min``).

    Cases whose window holds no sample have no row.
    """
    width = _width(before_seconds, after_seconds, parts)
    merges = {name: merge for name, (_, merge) in values.items()} | {"_n": "sum"}
    columns = {name: column for name, (column, _) in values.items()} | {"_n": F.lit(1).cast("bigint")}
    ends = _ends(cases, before_seconds, after_seconds, entity)
    micros = E.epoch_micros(ts)
    read = samples.where(F.col(entity).isNotNull() & F.col(ts).isNotNull()).select(
        entity, micros.alias("_at"), _bucket(micros, width).alias("_b"),
        F.lit(_SAMPLE).alias("_kind"), F.lit(None).cast(cases.schema["case_id"].dataType).alias("case_id"),
        *[c.alias(n) for n, c in columns.items()],
    )
    kinds = {f.name: f.dataType for f in read.schema.fields}
    nothing = [F.lit(None).cast(kinds[n]).alias(n) for n in merges]

    def probe(frame: DataFrame, at: Column, b: Column, kind: int) -> DataFrame:
        return frame.select(entity, at.alias("_at"), b.alias("_b"), F.lit(kind).alias("_kind"), "case_id", *nothing)

    first, last = F.col("_from"), F.col("_to")
    found = _along(
        read.unionByName(probe(ends, first, _bucket(first, width), _START)).unionByName(
            probe(ends, last, _bucket(last, width), _END)),
        entity, merges,
    )
    between = parts - 1
    if between:
        whole = read.groupBy(entity, "_b").agg(*[_MERGE[m](n).alias(n) for n, m in merges.items()]).select(
            entity, F.col("_b").alias("_at"), _bucket(F.col("_b"), between).alias("_b"),
            F.lit(_SAMPLE).alias("_kind"), F.lit(None).cast(kinds["case_id"]).alias("case_id"), *merges,
        )
        one, other = _bucket(first, width) + 1, _bucket(last, width) - 1
        blocks = ends.select("case_id", entity, one.alias("_one"), other.alias("_other"))
        one, other = F.col("_one"), F.col("_other")
        # where the whole buckets are one block, its end is met by the start alone
        found = found.unionByName(_along(
            whole.unionByName(probe(blocks, one, _bucket(one, between), _START)).unionByName(
                probe(blocks.where(_bucket(one, between) != _bucket(other, between)), other, _bucket(other, between), _END)),
            entity, merges,
        ))
    merged = found.groupBy("case_id").agg(*[_MERGE[m](n).alias(n) for n, m in merges.items()])
    return merged.where(F.col("_n") > 0).drop("_n")


def _last(points: DataFrame, entity: str) -> DataFrame:
    """``_case, _tag, _found``: the last sample up to each end, inside (entity, ``_b``), if there is one.

    ``points`` has ``_b``, ``_at``, ``_kind``, ``_tie``, ``_case``, ``_tag`` and ``_found``.
    """
    upto = Window.partitionBy(entity, "_b").orderBy("_at", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    found = points.select("_kind", "_case", "_tag", F.last("_found", ignorenulls=True).over(upto).alias("_found"))
    return found.where((F.col("_kind") == _END) & F.col("_found").isNotNull()).drop("_kind")


def last_in_windows(
    cases: DataFrame,
    samples: DataFrame,
    windows: dict[str, tuple[int, int]],
    columns: list[str] | None = None,
    entity: str = "cell_name",
    ts: str = "ts",
    tiebreak: str = "event_id",
    parts: int = PARTS,
) -> DataFrame:
    """``case_id``, entity, ``t0`` and, per named window, a struct of the window's last sample, NULL if it holds none.

    ``windows`` are seconds before and after ``t0``; all are answered by the same pass.  At
    equal times the largest tiebreak counts.  Cases must be distinct; one without a
    sample in any window has no row.
    """
    columns = [c for c in (columns or samples.columns) if c not in ("case_id", "t0", entity)]
    width = max(_width(b, a, parts) for b, a in windows.values())
    asking = cases.where(F.col(entity).isNotNull() & F.col("t0").isNotNull()).select(
        F.struct("case_id", entity, "t0").alias("_case"), entity, E.epoch_micros("t0").alias("_t0")
    )
    micros = E.epoch_micros(ts)
    row = F.struct(micros.alias("at"), F.col(tiebreak).alias("tie"), F.struct(*columns).alias("row"))
    none = {"_case": asking.schema["_case"].dataType, "_tag": "string"}
    read = samples.where(F.col(entity).isNotNull() & F.col(ts).isNotNull()).select(
        entity, micros.alias("_at"), _bucket(micros, width).alias("_b"), F.lit(_SAMPLE).alias("_kind"),
        F.col(tiebreak).alias("_tie"), *[F.lit(None).cast(t).alias(n) for n, t in none.items()], row.alias("_found"),
    )
    kinds = {f.name: f.dataType for f in read.schema.fields}

    def probe(at, b) -> DataFrame:
        """The end of every window of every case, at a place in a bucket that both follow from the end's time."""
        each = [
            F.struct(at(F.col("_t0") + after * 1_000_000).alias("_at"), b(F.col("_t0") + after * 1_000_000).alias("_b"),
                     F.lit(tag).alias("_tag"))
            for tag, (_, after) in windows.items()
        ]
        return asking.select(entity, "_case", F.inline(F.array(*each))).select(
            entity, "_at", "_b", F.lit(_END).alias("_kind"), F.lit(None).cast(kinds["_tie"]).alias("_tie"), "_case", "_tag",
            F.lit(None).cast(kinds["_found"]).alias("_found"),
        )

    found = _last(read.unionByName(probe(lambda end: end, lambda end: _bucket(end, width))), entity)
    # of the buckets before the end's: the last sample of each, met at the ends of two blocks
    newest = read.groupBy(entity, "_b").agg(F.max_by("_found", F.struct("_at", "_tie")).alias("_found")).select(
        entity, F.col("_b").alias("_at"), _bucket(F.col("_b"), parts).alias("_b"), F.lit(_SAMPLE).alias("_kind"),
        F.lit(None).cast(kinds["_tie"]).alias("_tie"), *[F.lit(None).cast(t).alias(n) for n, t in none.items()], "_found",
    )

    def block(end):
        return _bucket(_bucket(end, width) - 1, parts)

    found = found.unionByName(_last(
        newest.unionByName(probe(lambda end: _bucket(end, width) - 1, block))
        .unionByName(probe(lambda end: block(end) * parts - 1, lambda end: block(end) - 1)),
        entity,
    ))
    t0 = E.epoch_micros("_case.t0")
    best = []
    for tag, (before, _) in windows.items():
        inside = (F.col("_tag") == tag) & (F.col("_found.at") >= t0 - before * 1_000_000)
        best.append(F.max_by("_found.row", F.when(inside, F.struct("_found.at", "_found.tie"))).alias(tag))
    rows = found.groupBy("_case").agg(*best).where(F.coalesce(*[F.col(t) for t in windows]).isNotNull())
    return rows.select("_case.case_id", F.col("_case")[entity].alias(entity), "_case.t0", *windows)


def last_in_window(
    cases: DataFrame,
    samples: DataFrame,
    before_seconds: int,
    after_seconds: int,
    columns: list[str] | None = None,
    entity: str = "cell_name",
    ts: str = "ts",
    tiebreak: str = "event_id",
    parts: int = PARTS,
) -> DataFrame:
    """``case_id``, entity, ``t0`` and ``columns`` (default all) of the last sample of each case's window."""
    found = last_in_windows(
        cases, samples, {"_row": (before_seconds, after_seconds)}, columns, entity, ts, tiebreak, parts
    )
    return found.select("case_id", entity, "t0", "_row.*")


def _numbered(points: DataFrame, entity: str) -> DataFrame:
    """``points`` with ``_no``: how many samples of the entity there are up to each, itself included.

    ``points`` has ``_b``, ``_at``, ``_kind`` and ``_tie``.  One row per bucket carries the
    numbers from bucket to bucket.
    """
    sample = F.when(F.col("_kind") == _SAMPLE, 1).otherwise(0).cast("bigint")
    earlier = Window.partitionBy(entity).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = points.groupBy(entity, "_b").agg(F.sum(sample).alias("_n")).select(
        entity, "_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_carry")
    )
    upto = Window.partitionBy(entity, "_b").orderBy("_at", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = points.withColumn("_inside", F.sum(sample).over(upto)).join(carried, [entity, "_b"])
    return placed.withColumn("_no", F.col("_carry") + F.col("_inside")).drop("_carry", "_inside")


def first_in_window(
    cases: DataFrame,
    samples: DataFrame,
    before_seconds: int,
    after_seconds: int,
    n: int = 1,
    columns: list[str] | None = None,
    entity: str = "cell_name",
    ts: str = "ts",
    tiebreak: str = "event_id",
    parts: int = PARTS,
) -> DataFrame:
    """``case_id``, entity and ``columns`` (default all) of the first ``n`` samples of each case's window.

    At equal times the smallest tiebreak counts.  Cases without a sample have no row.
    """
    columns = [c for c in (columns or samples.columns) if c not in ("case_id", entity)]
    width = _width(before_seconds, after_seconds, parts)
    ends = _ends(cases, before_seconds, after_seconds, entity)
    micros = E.epoch_micros(ts)
    read = samples.where(F.col(entity).isNotNull() & F.col(ts).isNotNull()).select(
        entity, micros.alias("_at"), _bucket(micros, width).alias("_b"), F.lit(_SAMPLE).alias("_kind"),
        F.col(tiebreak).alias("_tie"), F.struct(*columns).alias("_row"),
    )
    kinds = {f.name: f.dataType for f in read.schema.fields}
    asking = ends.select(
        entity, F.col("_from").alias("_at"), _bucket(F.col("_from"), width).alias("_b"), F.lit(_START).alias("_kind"),
        F.lit(None).cast(kinds["_tie"]).alias("_tie"), F.lit(None).cast(kinds["_row"]).alias("_row"),
        F.struct("case_id", "_to").alias("_case"),
    )
    placed = _numbered(read.withColumn("_case", F.lit(None).cast(asking.schema["_case"].dataType)).unionByName(asking), entity)
    wanted = placed.where(F.col("_kind") == _START).select(
        entity, F.col("_case.case_id").alias("case_id"), F.col("_case._to").alias("_to"),
        F.explode(F.sequence(F.col("_no") + 1, F.col("_no") + F.lit(n))).alias("_no"),
    )
    met = placed.where(F.col("_kind") == _SAMPLE).select(entity, "_no", "_at", "_row")
    found = wanted.join(met, [entity, "_no"]).where(F.col("_at") <= F.col("_to"))
    return found.select("case_id", entity, "_row.*")
