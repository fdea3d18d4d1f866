"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is cut into 16 levels at its quantiles over all rows, the levels are
the coordinates of a cell, and rows are ordered by the cell's place on the Hilbert
curve.  Runs of that order, equal in rows to within one, are the shards: rows that are
near in every dimension share a shard, so the least and largest values of a file prune
on any of them.

Only DataFrame functions: the curve is a table-driven state machine folded over the
levels' bits, the order is a range sort (ties by id, then by row, so a cell that holds
a third of all rows still spreads over many tasks), and a row's rank is its place in
its sorted partition plus the rows of the partitions before.

Defined results: null text counts as no bytes; nulls in a dimension share its lowest
level; repeated rows get places of their own; an empty table gives an empty table;
extra columns are read only where they are asked for as dimensions or kept.  With
fewer rows than shards some shards stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import quoted
from kpiloom.llm.ranks import ranked
from kpiloom.session import stage

SHARDS = 40
#: Bits per dimension; 4 bits in each of 4 dimensions are 65,536 cells.
BITS = 4
#: Rank error of a quantile is at most one part in so many.
ACCURACY = 10_000
#: Fixed bytes of a row beside its text.
ROW_BYTES = 16


def leading_bytes(column: Column) -> Column:
    """A number that orders strings by their first six bytes."""
    digits = F.rpad(F.substring(F.hex(column.cast("binary")), 1, 12), 12, "0")
    return F.conv(digits, 16, 10).cast("double")


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """Output digit and next state for ``state * 2**n + digit``; a state is entry point and direction.

    Per level the cell's corner is read in the frame of the state, its rank in the Gray
    code is the digit of the curve, and entry and direction of that corner turn the frame.
    """
    size, mask = 1 << n, (1 << n) - 1

    def turn(x: int, k: int) -> int:  # rotate left in n bits
        k %= n
        return ((x << k) | (x >> (n - k))) & mask

    def gray(x: int) -> int:
        return x ^ (x >> 1)

    rank = {gray(w): w for w in range(size)}

    def entry(w: int) -> int:
        return 0 if w == 0 else gray(2 * ((w - 1) // 2))

    def ones(x: int) -> int:  # trailing ones
        return (~x & (x + 1)).bit_length() - 1

    def direction(w: int) -> int:
        if w == 0:
            return 0
        return ones(w - 1 if w % 2 == 0 else w) % n

    out, then = [], []
    for state in range(size * n):
        e, d = divmod(state, n)
        for corner in range(size):
            w = rank[turn(corner ^ e, -(d + 1))]
            out.append(w)
            then.append((e ^ turn(entry(w), d + 1)) * n + (d + direction(w) + 1) % n)
    return out, then


def curve_place(levels: list[Column], bits: int = BITS) -> Column:
    """Place on the curve of a cell with these levels (each 0 to 2**bits - 1)."""
    n = len(levels)
    out, then = curve_tables(n)
    digits = [
        sum((F.shiftright(c, k).bitwiseAND(F.lit(1)) * (1 << i) for i, c in enumerate(levels)), F.lit(0))
        for k in reversed(range(bits))
    ]

    def step(acc: Column, digit: Column) -> Column:
        at = acc["state"] * (1 << n) + digit
        return F.struct(
            F.get(F.lit(then), at).cast("int").alias("state"),
            (acc["place"] * (1 << n) + F.get(F.lit(out), at)).cast("long").alias("place"),
        )

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("place"))
    return F.aggregate(F.array(*digits), start, step)["place"]


def with_levels(df: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """``_level_i`` of each dimension: how many of its quantile cuts lie below the value."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = df.agg(*[
        F.percentile_approx(c, F.array(*map(F.lit, shares)), ACCURACY).alias(f"q{i}") for i, c in enumerate(dimensions)
    ]).first()
    for i, c in enumerate(dimensions):
        below = sum((F.coalesce((F.col(c) > F.lit(q)).cast("int"), F.lit(0)) for q in row[i] or []), F.lit(0))
        df = df.withColumn(f"_level_{i}", below)
    return df


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id: str = "doc_id", text: str = "text",
    dimensions: dict[str, Column] | None = None, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, place`` and the kept columns.

    ``dimensions`` maps names to numbers; by default language, source, size and id.
    """
    if clash := {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "place"} & {*keep}:
        raise ValueError(f"kept columns share names with results: {sorted(clash)}")
    data = F.coalesce(quoted(text), F.lit("")).cast("binary")
    size = (F.octet_length(data) + ROW_BYTES).cast("long")
    if dimensions is None:
        dimensions = {c: leading_bytes(quoted(c)) for c in ("lang", "source") if c in docs.columns}
        number = quoted(id) if docs.schema[id].dataType.typeName() != "string" else leading_bytes(quoted(id))
        dimensions |= {"size": size, "id": number}
    names = [f"_dim_{i}" for i in range(len(dimensions))]
    base = stage(
        docs.select(
            quoted(id).alias("doc_id"), size.alias("size"), F.crc32(data).alias("text_crc32"),
            *[v.cast("double").alias(n) for n, v in zip(names, dimensions.values())],
            F.struct(*[quoted(c).alias(c) for c in keep]).alias("_kept") if keep else F.lit(0).alias("_kept"),
        ),
        "metadata",
    )
    levels = with_levels(base, names)
    placed = levels.withColumn("place", curve_place([F.col(f"_level_{i}") for i in range(len(names))])).select(
        "doc_id", "size", "text_crc32", "place", "_kept"
    )
    total = max(1, base.count())
    return (
        ranked(placed, ["place", "doc_id", "text_crc32"])
        .withColumn("shard", F.expr(f"_rank * {shards}L div {total}L").cast("int"))
        # less the first rank of the shard, a quotient rounded up
        .withColumn("slot", F.expr(f"_rank - (shard * {total}L + {shards}L - 1L) div {shards}L"))
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"), "place",
            *[F.col("_kept")[c].alias(c) for c in keep],
        )
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, rows in curve order; files of a shard are runs of its order."""
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
