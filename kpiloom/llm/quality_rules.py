"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a predicate over a few features of the whole text.  On a bounded sample of
all partitions every feature is timed and every rule's rejections are counted.  Rules
then run in falling order of rejections per second of the features that they are the first
to need, and a feature is computed only for rows that no earlier rule has rejected.  The
order, and so the named reason, may differ from run to run as clocks do; the verdict
never does: a row is kept if no rule rejects it.

Defined results: null text counts as empty (no words, rejected as ``few_words``);
repeated rows and ties are judged row by row; an empty table gives an empty table;
extra columns are handed on untouched, whatever they are called.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import SPACES, packed, quoted, text_of, words_of
from kpiloom.session import stage

#: Words in a window for ``n_repeat_words``.
WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Rows of the sample by which rules are ordered, in expectation, and how often a feature is timed on it.
SAMPLE_ROWS = 1000
TIMINGS = 2
#: Letters of scripts that write words without blanks.
SOLID = r"[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]+"


def _window_hashes(words: Column) -> Column:
    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)])

    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) < WINDOW, none).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - WINDOW, F.lit(0))), window)
    )


def _covered_words(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more; windows overlap, words count once."""

    def starts_twice(pairs: Column) -> Column:
        def twin(pair: Column, j: Column) -> Column:
            before, after = F.get(pairs, j - 1), F.get(pairs, j + 1)
            return F.coalesce(before["h"] == pair["h"], F.lit(False)) | F.coalesce(after["h"] == pair["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(pairs, twin), lambda p: p["at"]))

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("at"))))
    # bound to a lambda variable, so it is made once and not once per element
    starts = F.transform(F.array(pairs), starts_twice)[0]
    walked = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, at: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("n"), at.alias("last")
        ),
    )["n"]
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(walked)


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    return F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0]


def _stutters(words: Column) -> Column:
    return F.size(F.filter(words, lambda w, i: F.coalesce(F.get(words, i - 1) == w, F.lit(False))))


def _count_of(text: Column, marks: str) -> Column:
    return F.length(text) - F.length(F.translate(text, marks, ""))


@dataclass(frozen=True)
class Feature:
    """``make`` builds the value from the features it ``needs``."""

    needs: tuple[str, ...]
    make: object


#: Names start with an underscore inside the job, so that they are told from results.
FEATURES: dict[str, Feature] = {
    "words": Feature(("text",), lambda c: words_of(c["text"])),
    "n_words": Feature(("words",), lambda c: F.size(c["words"])),
    "word_chars": Feature(("text",), lambda c: F.length(F.translate(c["text"], SPACES, ""))),
    "n_symbols": Feature(("text",), lambda c: _count_of(c["text"], SYMBOLS)),
    "n_calls": Feature(("text",), lambda c: _count_of(c["text"], "!")),
    "n_capitals": Feature(("text",), lambda c: F.length(F.regexp_replace(c["text"], r"\P{Lu}+", ""))),
    "n_lines": Feature(("text",), lambda c: F.size(F.split(c["text"], "\n"))),
    "n_dup_lines": Feature(("text",), lambda c: _repeated_lines(c["text"])),
    "n_stutters": Feature(("words",), lambda c: _stutters(c["words"])),
    "hashes": Feature(("words",), lambda c: _window_hashes(c["words"])),
    "n_repeat_words": Feature(("hashes",), lambda c: _covered_words(c["hashes"])),
}


def _long_words(c: dict[str, Column]) -> Column:
    """Over 25 characters a word, unless most of them are letters of a script without blanks (looked at only then)."""
    solid = F.length(F.regexp_replace(c["text"], SOLID, ""))
    return (c["word_chars"] > 25 * c["n_words"]) & (2 * solid <= c["word_chars"])


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    rejects: object


#: The first two are the base rules.
RULES: tuple[Rule, ...] = (
    Rule("few_words", ("n_words",), lambda c: c["n_words"] < 10),
    Rule("repeated_windows", ("n_repeat_words", "n_words"), lambda c: 100 * c["n_repeat_words"] > 20 * c["n_words"]),
    Rule("symbols", ("n_symbols", "n_words"), lambda c: 10 * c["n_symbols"] > 3 * c["n_words"]),
    Rule("shouting", ("n_calls", "n_words"), lambda c: 10 * c["n_calls"] > 5 * c["n_words"]),
    Rule("capitals", ("n_capitals", "word_chars"), lambda c: 10 * c["n_capitals"] > 6 * c["word_chars"]),
    Rule("long_words", ("word_chars", "n_words"), _long_words),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda c: 10 * c["n_dup_lines"] > 5 * c["n_lines"]),
    Rule("stutter", ("n_stutters", "n_words"), lambda c: 100 * c["n_stutters"] > 20 * c["n_words"]),
)
BASE_RULES = ("few_words", "repeated_windows")


def _closure(needs: tuple[str, ...]) -> list[str]:
    """Features that must exist before a rule can run, in an order in which they can be made."""
    found: list[str] = []
    for name in needs:
        if name in FEATURES:
            found += [x for x in _closure(FEATURES[name].needs) if x not in found]
            found += [name] if name not in found else []
    return found


def _columns(df: DataFrame) -> dict[str, Column]:
    return {c.removeprefix("_"): F.col(c) for c in df.columns}


def with_features(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` (with ``_text``) and the named features as ``_name``."""
    for name in names:
        df = df.withColumn(f"_{name}", FEATURES[name].make(_columns(df)))
    return df


def _seconds(sample: DataFrame, names: list[str]) -> float:
    """Time of a job that makes the named features of the sample, the last of them once per row at least."""
    made = with_features(sample, names).select(F.xxhash64(*[f"_{x}" for x in names[-1:]], F.length("_text")).alias("h"))
    best = float("inf")
    for _ in range(TIMINGS):
        started = time.perf_counter()
        made.agg(F.bit_xor("h")).collect()
        best = min(best, time.perf_counter() - started)
    return best


def feature_seconds(sample: DataFrame, names: list[str]) -> dict[str, float]:
    """Measured seconds that each feature (listed after what it needs) adds to those it needs, on a written sample."""
    base = _seconds(sample, [])
    whole = {x: _seconds(sample, _closure((x,))) for x in names}
    own = {}
    for x in names:
        needed = max((whole[n] for n in FEATURES[x].needs if n in whole), default=base)
        own[x] = max(whole[x] - needed, 1e-6)
    return own


def rule_order(
    docs: DataFrame, id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, paid: tuple[str, ...] = ()
) -> list[Rule]:
    """Rules by rejections per second on a sample of about ``SAMPLE_ROWS`` rows from all partitions.

    A feature that an earlier rule needs, or that is ``paid`` for anyhow, costs nothing.
    Only figures come back from the sample, no texts.
    """
    frame = packed(docs, _id=id, _text=text)
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64(F.lit("rules"), "_id", F.xxhash64("_text")), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = stage(frame.where(drawn).select(text_of(F.col("_text")).alias("_text")), "rules-sample")
    needed = list(dict.fromkeys(x for r in rules for x in _closure(r.needs)))
    made = with_features(sample, needed)
    cols = _columns(made)
    counted = made.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.coalesce(r.rejects(cols), F.lit(False))).alias(r.name) for r in rules]
    ).first()
    if not counted["n"]:
        return list(rules)
    seconds = feature_seconds(sample, needed)
    rest, done, order = list(rules), set(paid), []
    while rest:
        def gain(rule: Rule) -> float:
            return counted[rule.name] / (1e-6 + sum(seconds[x] for x in _closure(rule.needs) if x not in done))

        best = max(rest, key=gain)  # ties: the order of RULES
        order.append(best)
        rest.remove(best)
        done.update(_closure(best.needs))
    return order


def verdict(order: list[Rule], known: dict[str, Column]) -> Column:
    """The first rule in ``order`` that rejects, else null, as one expression.

    A feature is bound to a lambda variable in the branch of the first rule that needs
    it: evaluated once, and only for rows that got there.  As one expression it grows
    with the number of rules however the optimizer moves it about.
    """
    if not order:
        return F.lit(None).cast("string")
    rule = order[0]

    def bound(names: list[str], cols: dict[str, Column]) -> Column:
        if names:
            made = F.array(FEATURES[names[0]].make(cols))
            return F.transform(made, lambda v: bound(names[1:], {**cols, names[0]: v}))[0]
        rejected = F.coalesce(rule.rejects(cols), F.lit(False))
        return F.when(rejected, F.lit(rule.name)).otherwise(verdict(order[1:], cols))

    return bound([x for x in _closure(rule.needs) if x not in known], known)


def keep_good(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` that no rule rejects, with the columns of ``docs``; no shuffle."""
    reason = verdict(rule_order(docs, id, text), {"text": text_of(quoted(text))})
    return docs.where(reason.isNull())


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the base counts, ``base_failed``, ``kept`` and ``reason``.

    The counts are asked for on every row, so they are made first and the cascade
    skips only what else the rules need.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    frame = packed(docs, _id=id, _text=text).select("_id", text_of(F.col("_text")).alias("_text"))
    paid = tuple(dict.fromkeys(x for c in counts for x in _closure((c,))))
    frame = with_features(frame, list(paid))
    base = [r for r in RULES if r.name in BASE_RULES]
    cols = _columns(frame)
    frame = frame.withColumn("_base_failed", base[0].rejects(cols) | base[1].rejects(cols))
    frame = frame.withColumn("_verdict", verdict(rule_order(docs, id, text, paid=paid), cols))
    return frame.select(
        F.col("_id").alias("doc_id"),
        *[F.col(f"_{c}").cast("long").alias(c) for c in counts],
        F.col("_base_failed").alias("base_failed"),
        F.col("_verdict").isNull().alias("kept"),
        F.col("_verdict").alias("reason"),
    )
