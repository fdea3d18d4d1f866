"""Column expressions shared by the operators; all run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_array(values: list, sql_type: str = "string") -> Column:
    """Literal array; typed even when empty."""
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{sql_type}>")


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL for a zero denominator (also for 0/0)."""
    return col(num) / F.nullif(col(den), F.lit(0.0))


def deviation_pct(value: Column | str, base: Column | str) -> Column:
    """Percent deviation; the small constant keeps a zero baseline finite."""
    return (col(value) - col(base)) / (col(base) + F.lit(fv.EPSILON)) * F.lit(100.0)


def direction(delta: Column | str) -> Column:
    return F.when(col(delta) >= 0, "up").otherwise("down")


def attribution_direction(value: Column | str) -> Column:
    return F.when(col(value) > 0, "positive").otherwise("negative")


def severity(missing_share: Column | str) -> Column:
    """Band of a missing share in 0..1; an empty batch (NULL) is high."""
    share = col(missing_share)
    return (
        F.when(share < fv.SEVERITY_LOW, "low")
        .when(share < fv.SEVERITY_MEDIUM, "medium")
        .otherwise("high")
    )


def clamp01(value: Column | str) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), col(value)))


def one_decimal(value: Column | str) -> Column:
    """Text with one decimal, no grouping; rounds the exact binary value."""
    return F.call_function("format_number", col(value), F.lit("0.0"))


def percent_text(value: Column | str) -> Column:
    return F.concat(one_decimal(col(value) * 100), F.lit("%"))


def missing_count(columns: list[str]) -> Column:
    """Number of NULLs among the columns of one row."""
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in columns], F.lit(0))


def overlap_share(current: Column | str, other: Column | str) -> Column:
    """|current AND other| / max(|current|, 1) on distinct elements."""
    shared = F.size(F.array_intersect(col(current), col(other)))
    return shared / F.greatest(F.size(F.array_distinct(col(current))), F.lit(1))


def model_family(model_id: Column | str) -> Column:
    lowered = F.lower(col(model_id))
    family = F.lit(fv.UNKNOWN)
    for name, words in reversed(fv.MODEL_FAMILIES):
        hit = reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])
        family = F.when(hit, name).otherwise(family)
    return family


def epoch_micros(ts: Column | str) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def shift_seconds(ts: Column | str, seconds: int) -> Column:
    return col(ts) + F.make_dt_interval(secs=F.lit(seconds))


def context_prompt(task: Column | str, context: Column | str, examples: Column | None = None) -> Column:
    """Task line, one ``- key: value`` line per map entry, numbered examples."""
    lines = F.transform(
        F.map_entries(col(context)),
        lambda e: F.concat(F.lit("- "), e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("None")), F.lit("\n")),
    )
    text = F.concat(F.lit("Task: "), col(task), F.lit("\n\nContext:\n"), F.array_join(lines, ""))
    if examples is None:
        return text
    numbered = F.transform(
        examples, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x, F.lit("\n"))
    )
    has_examples = F.coalesce(F.size(examples), F.lit(0)) > 0
    tail = F.when(has_examples, F.concat(F.lit("\nExamples:\n"), F.array_join(numbered, "")))
    return F.concat(text, F.coalesce(tail, F.lit("")))
