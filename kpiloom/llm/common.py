"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.session import ship, stage  # noqa: F401  operators take ship from here

#: ASCII white space, as the word definitions of this subpackage mean it.
SPACES = " \t\n\x0b\f\r"
#: A Java and RE2 pattern for a run of it.
SPACE_RUN = r"[ \t\n\x0B\f\r]+"


def quoted(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, row: str = "_row", **wanted: str) -> DataFrame:
    """All columns of ``docs`` as one struct ``row`` and the wanted ones beside it.

    Operators that hand rows on work on this form, so whatever an input column is
    called, it cannot clash with a column that the operator makes.
    """
    whole = F.struct(*[quoted(c) for c in docs.columns]).alias(row)
    return docs.select(whole, *[quoted(source).alias(name) for name, source in wanted.items()])


def unpacked(df: DataFrame, columns: list[str], row: str = "_row") -> DataFrame:
    """The columns that ``packed`` put away."""
    return df.select(*[F.col(row)[c].alias(c) for c in columns])


def text_of(column: Column) -> Column:
    """Null texts count as empty."""
    return F.coalesce(column, F.lit(""))


def words_of(text: Column) -> Column:
    """Words between runs of ASCII white space; the empty array for none."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


#: A key is hot from this many rows on, or from a ten-thousandth of all rows if that is more.
HOT_ROWS = 500
HOT_SHARE = 10_000


def hot_keys(counts: DataFrame, key: str) -> DataFrame:
    """``key, pieces`` of the hot keys of a written table ``key, n``: at most ``HOT_SHARE`` rows."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT_ROWS, total // HOT_SHARE)
    return counts.where((F.col("n") > limit) & F.col(key).isNotNull()).select(
        key, F.ceil(F.col("n") / limit).cast("int").alias("pieces")
    )


def lookup(
    many: DataFrame, one: DataFrame, key: str, how: str = "left", counts: DataFrame | None = None
) -> DataFrame:
    """``many`` joined to ``one`` (unique in ``key``) so that no key lands in one task whole.

    Rows of hot keys are dealt in turn over as many pieces as their number asks for;
    the one row that they meet is repeated once per piece.  ``many`` must come straight
    from files, so that a repeated task deals its rows alike.  Counting is partial before
    its shuffle; ``counts`` (``key, n``, written) spares it.
    """
    if counts is None:
        counts = stage(many.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "counts")
    hot = hot_keys(counts, key)
    if not hot.head(1):
        return many.join(one, key, how)
    pieces = F.broadcast(hot)
    dealt = many.withColumn("_turn", F.monotonically_increasing_id()).join(pieces, key, "left").withColumn(
        "_salt", F.when(F.col("pieces").isNull(), 0).otherwise(F.pmod(F.col("_turn"), F.col("pieces"))).cast("int")
    ).drop("pieces", "_turn")
    copies = one.join(pieces, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("pieces"), F.lit(1)) - 1))
    ).drop("pieces")
    return dealt.join(copies, [key, "_salt"], how).drop("_salt")


#: Bits of a filter, 16 MB, whatever the input.
FILTER_BITS = 27


def bit_filter(slots: DataFrame, slot_bits: int) -> np.ndarray:
    """Bits at the leading digits of the numbers in column ``slot`` (below ``2 ** slot_bits``), set on Spark.

    Its size is fixed, so it may be broadcast whatever the input; the fuller it is, the
    more it lets through, and it never misses a number that was set.
    """
    bit = F.expr(f"shiftright(slot, {slot_bits - FILTER_BITS})")
    rows = (
        slots.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out


def hits(bits: np.ndarray, slots: np.ndarray, slot_bits: int) -> np.ndarray:
    """Which of the numbers the filter may hold."""
    bit = slots >> (slot_bits - FILTER_BITS)
    return (bits[bit >> 6] >> (bit & 63) & 1).astype(bool)


def word_runs(data: bytes, size: int = 4_000_000):
    """Lists of the words of a text, run by run: a very long text is never one list."""
    if len(data) <= size:
        yield data.split()
        return
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data) and data[end] not in _SPACE_BYTES:
            end += 1
        yield data[at:end].split()
        at = end


_SPACE_BYTES = frozenset(SPACES.encode())
