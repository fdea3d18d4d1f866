"""Document fingerprints from closed syncmers.

A window of ``K`` characters is a closed syncmer if the least hash among its inner
substrings of ``S`` characters lies at its first or last place.  Whether a window is
chosen depends on its own characters alone, so an edit disturbs only the windows it
touches, and any ``K - S`` windows in a row hold at least one.  The fingerprint of a
text is the row of its syncmers: 24 bits of each one's hash and the distance from the
one before.  Two fingerprints are compared by position: equal hashes are paired in
order of occurrence, the longest chain of pairs that rises in both texts counts, and
likeness is twice its length over the number of syncmers of both.

Texts under ``SHORT`` characters have windows of two characters, so that one that keeps
most of them is still like itself; marks of short and long texts do not compare.

Because syncmers need no context, the fingerprint of a text whose tail is replaced is
put together from the syncmers that lie wholly in what stayed and those of the seam
and the new tail.

Defined results: null text counts as empty; the empty text has the empty fingerprint,
like another empty text and unlike any other; a text without syncmers (one character)
has one mark for the whole text; rows of one id follow each
other by a hash of their text, equal rows in the order they are read; null ids come
first; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import quoted, ship, text_of
from kpiloom.llm.ranks import ranked
from kpiloom.session import stage

K = 32
S = 8
#: Below this length a text has windows of ``SHORT_K`` characters with inner ones of ``SHORT_S``.
SHORT = 64
SHORT_K, SHORT_S = 2, 1
#: Windows handled in one numpy step.
STEP = 1 << 20
#: Characters of text in a bucket of neighbouring documents, and buckets at most (their first keys go to the driver).
BUCKET_CHARS = 8_000_000
MOST_BUCKETS = 20_000
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _chosen(points: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and 24-bit hashes of the closed syncmers of one stretch of at least ``k`` characters."""
    h, width = points.astype(np.uint64) * _MIX[0], 1
    with np.errstate(over="ignore"):
        while width < s:  # hashes of substrings of twice the length, until s
            h = h[:-width] * (_MIX[1] + np.uint64(2 * width)) + h[width:]
            width *= 2
        h = _mixed(h)
        span, least, width = k - s + 1, h, 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if span > width:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        n = len(points) - k + 1
        at = np.flatnonzero((h[:n] == least) | (h[k - s : k - s + n] == least))
        mark = np.zeros(len(at), dtype=np.uint64)
        for offset in (*range(0, k - s, s), k - s):
            mark = mark * _MIX[2] + h[at + offset]
        return at, (_mixed(mark) >> np.uint64(40)).astype(np.int64)


def syncmers(points: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all closed syncmers of a whole text, stretch by stretch."""
    if s & (s - 1) or not s < k <= 255:
        raise ValueError("s must be a power of two below k, and k at most 255")
    found = [
        (at + start, mark)
        for start in range(0, len(points) - k + 1, STEP)
        for at, mark in [_chosen(points[start : start + STEP + k - 1], k, s)]
    ]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([m for _, m in found])


Marks = tuple[np.ndarray, np.ndarray]


def _whole(text: str, marks: Marks) -> Marks:
    if len(marks[0]) or not text:
        return marks
    one = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 40
    return np.zeros(1, np.int64), np.array([one], np.int64)


def marks_of(text: str, k: int = K, s: int = S) -> Marks:
    if len(text) < SHORT:
        k, s = SHORT_K, SHORT_S
    return _whole(text, syncmers(code_points(text), k, s))


def marks_of_edited(text: str, marks: Marks, kept: int, tail: str, k: int = K, s: int = S) -> Marks:
    """Marks of ``text[:kept] + tail`` from those of ``text``: only the seam and the tail are read."""
    if kept + len(tail) < SHORT:
        return marks_of(text[:kept] + tail, k, s)
    at, mark = marks if len(text) >= k else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    if len(at) == 1 and at[0] == 0 and not len(syncmers(code_points(text), k, s)[0]):
        at, mark = at[:0], mark[:0]  # the mark of a whole text is no syncmer
    stay = at + k <= kept
    seam = max(0, kept - k + 1)
    more, marks2 = syncmers(code_points(text[seam:kept] + tail), k, s)
    return _whole(text[:kept] + tail, (np.concatenate((at[stay], more + seam)), np.concatenate((mark[stay], marks2))))


def packed_marks(marks: Marks) -> str:
    """Four bytes per mark: its hash and the distance from the one before (from 0 for the first)."""
    at, mark = marks
    out = np.empty((len(at), 4), dtype=np.uint8)
    out[:, 0], out[:, 1], out[:, 2] = mark >> 16, mark >> 8 & 255, mark & 255
    out[:, 3] = np.diff(at, prepend=0)  # at most k - s between closed syncmers
    return base64.b64encode(out.tobytes()).decode("ascii")


def unpacked_marks(fingerprint: str) -> Marks:
    raw = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, 4).astype(np.int64)
    return np.cumsum(raw[:, 3]), raw[:, 0] << 16 | raw[:, 1] << 8 | raw[:, 2]


def _numbered(mark: np.ndarray) -> np.ndarray:
    """Each mark with the number of its occurrence."""
    order = np.argsort(mark, kind="stable")
    ordered = mark[order]
    first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    start = np.maximum.accumulate(np.where(first, np.arange(len(mark)), 0))
    out = np.empty(len(mark), dtype=np.int64)
    out[order] = ordered << 32 | (np.arange(len(mark)) - start)
    return out


def _longest_rise(values: list[int]) -> int:
    tops: list[int] = []
    for v in values:
        i = bisect.bisect_left(tops, v)
        if i == len(tops):
            tops.append(v)
        else:
            tops[i] = v
    return len(tops)


def likeness(a: Marks, b: Marks) -> float:
    """From 0 (no mark in common) to 1 (equal marks in equal order)."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    _, i, j = np.intersect1d(_numbered(a[1]), _numbered(b[1]), assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    places = j[np.argsort(i)]
    chain = len(places) if (np.diff(places) > 0).all() else _longest_rise(places.tolist())
    return 2.0 * chain / (len(a[0]) + len(b[0]))


def compare(one: Column, other: Column) -> Column:
    """Likeness of two columns of fingerprints."""

    @F.arrow_udf("double")
    def likenesses(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([
            None if a is None or b is None else likeness(unpacked_marks(a), unpacked_marks(b))
            for a, b in zip(x.to_pylist(), y.to_pylist())
        ], pa.float64())

    return likenesses(one, other)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every whole text; one scan."""
    ship(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()
    frame = docs.select(quoted(id).alias("doc_id"), text_of(quoted(text)).alias("text"))

    def run(batches):
        for batch in batches:
            texts = [x.as_py() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([packed_marks(marks_of(t, k, s)) for t in texts], pa.string())],
                ["doc_id", "n_chars", "fingerprint"],
            )

    return frame.mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


# --- documents beside their successors ----------------------------------------------


def _search(bounds: Column, key: Column, n: int) -> Column:
    """Index of the last of ``n`` sorted bounds that is not above ``key``, by halving."""

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        below = F.get(bounds, mid) <= key
        open_ = acc["high"] - acc["low"] > 1
        return F.struct(
            F.when(open_ & below, mid).otherwise(acc["low"]).alias("low"),
            F.when(open_ & ~below, mid).otherwise(acc["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(0), F.lit(max(1, n).bit_length()))
    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.lit(n).alias("high")), halve)["low"]


def with_next(docs: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """``bucket, guest, id, text`` dealt so that a row's successor by id stands right after it.

    One narrow pass finds every so manieth key in global order; the texts then move
    once, into buckets of neighbours.  The first row of each bucket also visits the
    bucket before it, as its last row (the first of all visits the last bucket).
    """
    spark = docs.sparkSession
    key = F.struct(F.col("_id").alias("id"), F.xxhash64("_text").alias("hash"), F.col("_turn").alias("turn"))
    frame = docs.select(quoted(id).alias("_id"), text_of(quoted(text)).alias("_text")).withColumn(
        "_turn", F.monotonically_increasing_id()
    ).withColumn("_key", key)
    known = stage(frame.select("_key", F.length("_text").alias("chars")), "keys")
    chars = known.agg(F.sum("chars")).first()[0] or 0
    keys = ranked(known.select("_key"), ["_key"])
    total = keys.count()
    buckets = min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // BUCKET_CHARS)))
    size = max(1, -(-total // buckets))
    firsts = keys.where(F.col("_rank") % size == 0).select(F.to_json("_key").alias("k"), "_rank").collect()
    texts = [r["k"] for r in sorted(firsts, key=lambda r: r["_rank"])]
    n = max(1, len(texts))
    kind = frame.schema["_key"].dataType.simpleString()
    bounds = F.from_json(F.lit(json.dumps([json.loads(x) for x in texts])), f"array<{kind}>")
    placed = frame.withColumn("_bucket", _search(bounds, F.col("_key"), n))
    opens = F.coalesce(F.get(bounds, F.col("_bucket")) == F.col("_key"), F.lit(False))
    own = F.struct(F.col("_bucket").alias("bucket"), F.lit(0).alias("guest"))
    visit = F.struct(F.pmod(F.col("_bucket") - 1, F.lit(n)).alias("bucket"), F.lit(1).alias("guest"))
    rows = placed.withColumn("_place", F.explode(F.when(opens, F.array(own, visit)).otherwise(F.array(own)))).select(
        F.col("_place.bucket").alias("bucket"), F.col("_place.guest").alias("guest"), "_key",
        F.col("_id").alias("id"), F.col("_text").alias("text"),
    )
    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "guest", "_key")
    return dealt.select("bucket", "guest", "id", "text"), total


def edit_likeness(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how near they are.

    The edited text has its last ``n_chars // 4`` characters replaced by the first as
    many of the next document by id (after the last: the first).
    """
    ship(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()
    dealt, _ = with_next(docs, id, text)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def row(this: str, marks: Marks, following: str, next_marks: Marks) -> tuple:
        moved = len(this) // 4
        kept, tail = len(this) - moved, following[:moved]
        edited = marks_of_edited(this, marks, kept, tail, k, s)
        return (
            len(this), hashlib.sha256((this[:kept] + tail).encode("utf-8", "surrogatepass")).hexdigest(),
            packed_marks(marks), packed_marks(edited), likeness(marks, edited), likeness(marks, next_marks),
        )

    def run(batches):
        held = None  # bucket, id (one-row array), text and marks of the row before
        for batch in batches:
            ids, rows = [], []
            buckets, texts = batch.column(0).to_pylist(), batch.column(3)
            for i, bucket in enumerate(buckets):
                this = texts[i].as_py()
                marks = marks_of(this, k, s)
                if held is not None and held[0] == bucket:
                    ids.append(held[1])
                    rows.append(row(held[2], held[3], this, marks))
                held = (bucket, batch.column(2).slice(i, 1), this, marks)
            if rows:
                columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *columns], names)

    return dealt.mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
