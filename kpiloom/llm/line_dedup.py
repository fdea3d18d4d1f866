"""Repeated lines and passages, found by hashing units.

Two kinds of units are hashed to 128 bits after normalising (lower case, words only):
whole lines of at least ``LEAST_LINE`` words, and one unit per clause.  Clauses are
cut after punctuation, before a word with a capital, at line ends and at blanks after
a letter of a script without blanks, so that a passage pasted into a line falls into
units of its own.  A clause of fewer than ``LEAST_UNIT`` words is hashed together with
the clauses after it, across lines, until there are that many; at the end of a text,
together with those before it.  Marks alone go with the clause before.  So every word of
a text stands in a unit, and lists,
verse and menus have units too.  Digests are grouped over the whole corpus; the
occurrence of lowest rank (id, text, offset) stays.  All later ones are candidates: a
line is cut as it is, and the units of consecutive clauses, all of them repeated, if
together they have at least ``LEAST_RUN`` words.  The cut places are returned as
offsets into the original text, in code points.

Words are runs of word characters; in scripts without blanks every two characters
count as one, and symbols beyond ASCII count too.

What moves is narrow.  A unit is written as its document's key, its number in the text
and its digest.  A first count by 48 bits of the digest sets the bits of a filter of
fixed size; a unit that misses it stands once in the corpus and never moves again.
The others are grouped by the whole digest, hot digests dealt in turn on the way back, and
a document gets the numbers of its repeated units, from which the places follow by
cutting its text into units once more.

Defined results: null text counts as empty and stays null, nothing is cut; rows that
agree in id and text count as one document, so they stay alike; a null id ranks
first; an empty table gives an empty table; other columns are handed on untouched.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.llm.common import bit_filter, hits, lookup, packed, ship, unpacked
from kpiloom.session import stage

LEAST_LINE = 8
LEAST_UNIT = 4
LEAST_RUN = 12
#: Scripts whose words have no blanks between them.
_SOLID = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}ー々〆"
_SYMBOL = r"[^\P{S}\x00-\x7f]"
#: A run of marks or of blanks is tried from its beginning only, and whole: a run of a million takes one walk.
_MARKS = r"(?<![.!?,;:])[.!?,;:]++[\"')\]]*+\s++"
_BLANKS = r"(?<![^\S\n])\s++"
_CUT = regex.compile(rf"{_MARKS}|{_BLANKS}(?=\p{{Lu}})")
_CUT_WIDE = regex.compile(
    rf"{_MARKS}|{_BLANKS}(?=\p{{Lu}})|[。．！？，、；：｡､…།]+[」』”’）】》〉\"')\]]*\s*|(?<=[{_SOLID}])\s+"
)
_LINE = regex.compile(r"([^\n]*+)\n*+(?<=.)", regex.DOTALL)
_WORD = regex.compile(r"\w+")
_WORD_WIDE = regex.compile(rf"[{_SOLID}]{{1,2}}|[^\W{_SOLID}]+|{_SYMBOL}+")
#: What only the wide patterns tell apart; elsewhere both give the same.
_WIDE = regex.compile(rf"[{_SOLID}。．！？，、；：｡､…།]|{_SYMBOL}")
#: Anything but ASCII and the Latin letters up to U+02AF; without any, the faster engine's patterns mean the same.
_OTHER = re.compile("[\x1c-\x1f\x85\xa0-\xbf\xd7\xf7\u02b0-\U0010ffff]")
_CAPITALS = "".join(c for c in map(chr, range(0x2B0)) if unicodedata.category(c) == "Lu")
_CUT_LATIN = re.compile(rf"{_MARKS}|{_BLANKS}(?=[{_CAPITALS}])")
_WORD_LATIN = re.compile(r"\w+")
CLAUSE, LINE, END = 0, 1, 2
#: Leading bits of a digest that the first count goes by.
SLOT_BITS = 48


def _digest(seed: int, words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"), seed)


def units(text: str, hashed: bool = True):
    """Kind, start, stop, first word, word after the last, and digest of every unit, those of a kind in order.

    Without ``hashed`` the digests are empty, for those who only want the places.
    """
    digest = _digest if hashed else (lambda seed, words: b"")
    low = text.lower()
    if not _OTHER.search(text) and not _OTHER.search(low):
        cut, a_word = _CUT_LATIN, _WORD_LATIN
    else:
        cut, a_word = (_CUT_WIDE, _WORD_WIDE) if _WIDE.search(text) else (_CUT, _WORD)
    if len(low) == len(text):  # as nearly always: places in both are the same
        def words_in(start, stop):
            return a_word.findall(low, start, stop)
    else:
        def words_in(start, stop):
            return a_word.findall(text[start:stop].lower())
    word, clauses, begin = 0, [], 0
    for line in _LINE.finditer(text):
        at, stop, first, whole = line.start(), line.end(), word, []
        # line ends cut nothing off that the end of the line does not
        for end in (*(m.end() for m in cut.finditer(text, at, line.end(1))), stop):
            words = words_in(at, end)
            if words:
                clauses.append((begin, end, word, words))
                whole += words
                word += len(words)
                begin = end
            elif clauses:  # marks alone go with the clause before
                clauses[-1] = (clauses[-1][0], end, *clauses[-1][2:])
                begin = end
            at = end
        if len(whole) >= LEAST_LINE:
            yield LINE, line.start(), stop, first, word, digest(LINE, whole)
    for i, (at, end, first, words) in enumerate(clauses):
        j = i + 1
        while len(words) < LEAST_UNIT and j < len(clauses):
            words, end, j = words + clauses[j][3], clauses[j][1], j + 1
        last, seed, j = first + len(words), CLAUSE, i
        if len(words) < LEAST_UNIT:  # an end meets only ends of as many words
            seed = END + len(words)
            while len(words) < LEAST_UNIT and j:
                j -= 1
                words = clauses[j][3] + words
        yield CLAUSE, at, end, first, last, digest(seed, words)


def unit_table(rows: DataFrame) -> DataFrame:
    """``id, key, no, h1, h2`` of every unit: number in its text, and the digest as two numbers."""
    ship(rows.sparkSession)
    names = ["id", "key", "no", "h1", "h2"]
    schema = T.StructType([
        rows.schema["id"], rows.schema["key"], T.StructField("no", T.IntegerType()),
        T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()),
    ])

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                found = [b"".join([u[-1] for u in units(x.as_py())]) for x in part.column(2)]
                sizes = np.fromiter(map(len, found), np.int64, len(found)) // 16
                digests = np.frombuffer(b"".join(found), dtype="<i8")
                row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                number = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), part.column(1).take(row), pa.array(number.astype(np.int32)),
                     pa.array(digests[::2]), pa.array(digests[1::2])],
                    names,
                )

    return rows.select("id", "key", "text").mapInArrow(run, schema)


def _maybe_repeated(all_units: DataFrame) -> DataFrame:
    """``id, key, no, digest`` of the units whose digest may stand more than once: all that do, and few others."""
    slot = F.shiftrightunsigned("h1", 64 - SLOT_BITS)
    often = stage(
        all_units.select(slot.alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("slot"),
        "often",
    )
    sent = all_units.sparkSession.sparkContext.broadcast(bit_filter(often, SLOT_BITS))
    fields = all_units.schema
    schema = T.StructType([*fields.fields[:3], T.StructField("digest", T.BinaryType())])

    def run(batches):
        for batch in batches:
            h1, h2 = (batch.column(k).to_numpy() for k in (3, 4))
            at = np.flatnonzero(hits(sent.value, (h1.view(np.uint64) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), SLOT_BITS))
            digests = np.stack((h1[at], h2[at]), axis=1).tobytes()
            found = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(at), [None, pa.py_buffer(digests)])
            rows = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(rows) for k in range(3)), found.cast(pa.binary())], schema.names
            )

    return all_units.mapInArrow(run, schema)


def repeated_units(rows: DataFrame) -> DataFrame:
    """``id, key, numbers``: of each document with any, its units that stand earlier in the corpus."""
    found = stage(_maybe_repeated(stage(unit_table(rows), "units")), "maybe-repeated")
    place = F.struct("id", "key", "no")
    firsts = stage(
        found.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "firsts"
    )
    later = lookup(
        found, firsts.select("digest", "first"), "digest", "inner", counts=firsts.select("digest", "n")
    ).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("id", "key").agg(F.collect_set("no").alias("numbers"))


def spans(text: str, numbers: set[int], least_run: int = LEAST_RUN) -> list[dict]:
    """Places of repeated lines and of long enough runs of repeated clauses, disjoint and in order."""
    places, run = [], None
    for number, (kind, start, stop, first, last, _) in enumerate(units(text, hashed=False)):
        if kind == LINE:
            if number in numbers:
                places.append({"start": start, "stop": stop})
            continue
        if number not in numbers:
            run = None
        elif run is None:
            run = {"start": start, "stop": stop, "first": first, "last": last}
            places.append(run)
        else:
            run["stop"], run["last"] = max(run["stop"], stop), max(run["last"], last)
    kept = [p for p in places if "first" not in p or p["last"] - p["first"] >= least_run]
    return joined(sorted(({"start": p["start"], "stop": p["stop"]} for p in kept), key=lambda p: (p["start"], p["stop"])))


def joined(places: list[dict]) -> list[dict]:
    """Sorted places, those that overlap or touch made one."""
    out: list[dict] = []
    for place in places:
        if out and place["start"] <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], place["stop"])
        else:
            out.append(dict(place))
    return out


def _cut(frame: DataFrame, least_run: int) -> DataFrame:
    """``_text`` without its repeated units, whose places come as ``spans`` instead of ``numbers``."""
    names = frame.columns
    text_at, numbers_at = names.index("_text"), names.index("numbers")
    places_type = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
    schema = T.StructType([
        T.StructField("spans", places_type) if f.name == "numbers" else f for f in frame.schema.fields
    ])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part, texts, found = batch.slice(low, 512), [], []
                for x, numbers in zip(part.column(text_at), part.column(numbers_at)):
                    text, at, pieces = x.as_py(), 0, []
                    found.append(spans(text, set(numbers.as_py()), least_run) if numbers.is_valid else [])
                    for place in found[-1]:
                        pieces.append(text[at : place["start"]])
                        at = place["stop"]
                    texts.append(text if text is None else "".join(pieces) + text[at:])
                part = part.set_column(text_at, part.schema.field(text_at), pa.array(texts, pa.string()))
                yield part.set_column(numbers_at, pa.field("spans", kind), pa.array(found, kind))

    return frame.mapInArrow(run, schema)


def _marked(docs: DataFrame, id: str, text: str, least_run: int) -> DataFrame:
    """``_row``, ``_id``, ``_text`` (cut) and ``spans`` of every row."""
    frame = packed(docs, _id=id, _text=text)
    rows = frame.where(F.col("_text").isNotNull()).select(
        F.col("_id").alias("id"), F.xxhash64("_text").alias("key"), F.col("_text").alias("text")
    )
    # nulls inside a struct are equal, so a null id finds its numbers
    found = stage(repeated_units(rows).select(F.struct("id", "key").alias("doc"), "numbers"), "repeated")
    keyed = frame.withColumn("doc", F.struct(F.col("_id").alias("id"), F.xxhash64("_text").alias("key")))
    return _cut(lookup(keyed, found, "doc").drop("doc"), least_run)


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars",
    least_run: int = LEAST_RUN,
) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` and ``n_chars`` (if there) made to fit."""
    marked = _marked(docs, id, text, least_run)
    out = unpacked(marked.withColumns({"_row": F.col("_row").withField(f"`{text}`", F.col("_text"))}), docs.columns)
    if n_chars in docs.columns and n_chars != text:
        out = out.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType))
    return out


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", least_run: int = LEAST_RUN) -> DataFrame:
    """One row per document: ``doc_id, text`` (cut), ``n_cut`` places and characters, ``cut`` as start-stop;..."""
    marked = _marked(docs, id, text, least_run)
    spans = F.coalesce(F.col("spans"), F.array().cast(marked.schema["spans"].dataType))
    return marked.select(
        F.col("_id").alias("doc_id"), F.col("_text").alias("text"),
        F.size(spans).cast("long").alias("n_cut"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]).alias("chars_cut"),
        F.array_join(
            F.transform(spans, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ";"
        ).alias("cut"),
    )
