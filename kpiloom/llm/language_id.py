"""Language ID by nearest centroid.

A text becomes the counts of its hashed character 1-, 2- and 3-grams (lower case,
anything but letters read as a blank), damped, weighted by IDF over all learning
documents, and scaled to length one.  Each language has a few centroids, found by
spherical k-means on all its learning documents; a text gets the
language of the centroid with the largest cosine.  A centroid rejects what lies much
farther from it than learning texts of like length do: hashed grams collide more, and
cosines grow, the longer a text is, so floors are kept per centroid and length.

Learning documents are those with a language, an id, and crc32 of the id's decimal
text not divisible by ``FOLDS``.  Ids, sources and languages never enter a prediction.

IDF, centroids and floors come from every learning document.  Their counts are written
once, filled slots only; each step of the k-means is one pass over them that adds up whole
numbers, so the model is the same however the rows are spread.

Bounds: ``DIMENSIONS`` counts, ``ROUNDS`` steps.  Every language is learned.  The model, 48 kB a language, is broadcast; if it would pass ``MODEL_BYTES``,
learning fails and says so, it never leaves a language out.

Defined results: null text or one without a letter is ``und`` with score 0, and
rejected; with nothing to learn from everything is; repeated rows are judged row by
row; a null id is not held out and not learned from; an empty table gives an empty
table; ties go to the language first in the alphabet.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import quoted, ship
from kpiloom.operators.percentiles import group_percentiles
from kpiloom.session import stage

DIMENSIONS = 4096
CENTROIDS = 3
MODEL_BYTES = 512 * 1024 * 1024
FOLDS = 5
ROUNDS = 12
#: A centroid rejects below this share of the cosine that all but LOW of its learning texts of like length reach.
SLACK = 0.5
LOW = 0.01
#: Learning texts count whole and cut to these lengths, so that there are some of every length.
CUTS = [1 << n for n in range(14)]
#: Lengths are alike by the bits of the number of filled slots.
LENGTHS = DIMENSIONS.bit_length() + 1
CHUNK = 500_000
#: Coordinates are added up as whole multiples of this.
STEP = 2.0 ** -32
#: Languages whose sums a task keeps before it hands them on.
OPEN_SUMS = 256
#: Cosines of one centroid and length that one buffer may hold.
LARGE_GROUP = 200_000
#: Logarithms of one and the counts below this are looked up.
LOOKED_UP = 1 << 15
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-case letter, or a blank, in the basic plane."""
    table = np.full(1 << 16, 32, dtype=np.uint32)
    for cp in range(1 << 16):
        c = chr(cp)
        if c.isalpha():
            table[cp] = ord(c.lower()[0])
    return table


def _normal(points: np.ndarray) -> np.ndarray:
    out = _letters().take(points, mode="clip")  # the last of the plane is no letter
    if len(points) and points.max() > 0xFFFF:
        for cp in np.unique(points[points > 0xFFFF]).tolist():
            out[points == cp] = cp if chr(cp).isalpha() else 32
    return out


#: Last two steps of the hash of a gram, for each length: factor and what is added.
_MIX = 0x9FB21C651E98DF25
_FACTOR = np.uint64(0xC2B2AE3D27D4EB4F * _MIX % 2**64)
_ADDED = [np.uint64(n * _MIX % 2**64) for n in range(4)]


def _slots(c: np.ndarray, back: int = 0):
    """Per length of gram: slots of the grams that end at ``back`` or later, and which of the ends count, ascending."""
    letter = c != 32
    c = c.astype(np.uint64)
    two = c[:-1] * np.uint64(0x9E3779B1) + c[1:]
    three = two[:-1] * np.uint64(0x85EBCA77) + c[2:]
    pair = letter[:-1] | letter[1:]
    for n, gram, some in ((1, c, letter), (2, two, pair), (3, three, pair[:-1] | letter[2:])):
        new = max(0, back - n + 1)
        slot = gram[new:] * _FACTOR
        slot += _ADDED[n]
        slot >>= np.uint64(52)
        yield slot.view(np.int64), some[new:]


def _damped(counts: np.ndarray) -> np.ndarray:
    if len(counts) and counts.max() >= LOOKED_UP:
        return np.log1p(counts.astype(np.int64, copy=False))
    return _logs().take(counts)


@functools.lru_cache(maxsize=1)
def _logs() -> np.ndarray:
    return np.log1p(np.arange(LOOKED_UP))


@functools.lru_cache(maxsize=1)
def _cuts() -> np.ndarray:
    """The first of ``CUTS`` that keeps a character, by its place."""
    return np.searchsorted(CUTS, np.arange(CUTS[-1]), "right").astype(np.uint16)


def prefix_grams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut, slot, count up to the cut before and count up to the cut, wherever a count grows; slots ascending, cuts within.

    Cuts are numbered as in ``CUTS``; a text not longer than the last of them is whole at
    the first cut that is no shorter.
    """
    c = _normal(np.frombuffer(text[: CUTS[-1]].encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
    cuts, wide = _cuts()[: len(c)], np.uint16(len(CUTS) + 1)
    key = np.concatenate([
        (slot.astype(np.uint16) * wide + cuts[n:])[some] for n, (slot, some) in enumerate(_slots(c))
    ])
    key.sort()
    new = np.flatnonzero(key[1:] != key[:-1]) + 1
    first = np.append(0, new)[: len(key)]
    end = np.append(new, len(key))[: len(key)]
    slot, cut = np.divmod(key[first], wide)
    fresh = np.append(True, slot[1:] != slot[:-1])[: len(key)]
    base = first[fresh][np.cumsum(fresh) - 1]
    return cut, slot, first - base, end - base


def prefix_counts(text: str):
    """``gram_counts`` of the text cut to each of ``CUTS`` that is shorter; one array, changed in place."""
    cut, slot, _, after = prefix_grams(text)
    counts = np.zeros(DIMENSIONS, dtype=np.int64)
    for n, size in enumerate(CUTS):
        if size >= len(text):
            return
        here = cut == n
        counts[slot[here]] = after[here]
        if counts.any():
            yield counts


def prefix_cosines(text: str, idf: np.ndarray, centers: np.ndarray) -> tuple[list[int], list[int], list[float]]:
    """Nearest of the centers (a column each), bits of filled slots and cosine of a whole text and of it cut to each
    of ``CUTS``; nothing for what has no letter.  From one cut to the next only counts that grow are looked at."""
    cut, slot, before, after = prefix_grams(text)
    rows = min(int(np.searchsorted(CUTS, len(text))) + 1, len(CUTS))
    found: tuple = ([], [], [])
    if len(slot):
        fresh = before == 0
        low, high, weight = _damped(before), _damped(after), idf[slot]
        grown = np.zeros((rows, int(fresh.sum())), np.float32)
        grown[cut, np.cumsum(fresh) - 1] = (high - low) * weight
        dots = np.cumsum(grown @ centers.take(slot[fresh], axis=0), axis=0, dtype=np.float64)
        squares = np.cumsum(np.bincount(cut, (high * high - low * low) * weight * weight, rows))
        filled = np.cumsum(np.bincount(cut[fresh], minlength=rows))
        best, some = np.argmax(dots, axis=1), np.flatnonzero(filled)
        best = best[some]
        cosines = dots[some, best] / np.maximum(np.sqrt(squares[some]), 1e-9)
        found = best.tolist(), [n.bit_length() for n in filled[some].tolist()], cosines.tolist()
    if len(text) > CUTS[-1] and (counts := gram_counts(text)) is not None:
        cosines = unit(counts, idf) @ centers
        best = int(np.argmax(cosines))
        for kept, x in zip(found, (best, length_of(counts), float(cosines[best]))):
            kept.append(x)
    return found


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed grams of a whole text; null for a text without a letter."""
    counts, any_letter = np.zeros(DIMENSIONS, dtype=np.int64), False
    for start in range(0, len(text), CHUNK):
        chunk = text[max(0, start - 2) : start + CHUNK]  # two characters back: no gram is lost at a cut
        c = _normal(np.frombuffer(chunk.encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
        back = min(2, start)
        any_letter |= bool((c[back:] != 32).any())
        counts += np.bincount(np.concatenate([slot[some] for slot, some in _slots(c, back)]), minlength=DIMENSIONS)
    return counts if any_letter else None


@dataclass(frozen=True)
class Model:
    """One row of ``centroids`` per entry of ``langs``; ``floors`` are the cosines below which a row rejects, by length."""

    idf: np.ndarray
    langs: list[str]
    centroids: np.ndarray
    floors: np.ndarray

    def vector(self, counts: np.ndarray) -> np.ndarray:
        return unit(counts, self.idf)


def length_of(counts: np.ndarray) -> int:
    return int(np.count_nonzero(counts)).bit_length()


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _scaled((_damped(counts) * idf).astype(np.float32))


def _scaled(v: np.ndarray) -> np.ndarray:
    return v / max(float(np.sqrt(v.dot(v))), 1e-9)


def fold(id: Column, folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(id.cast("string")), F.lit(folds))


def _learning(docs: DataFrame, id: str, text: str, lang: str) -> DataFrame:
    return docs.select(
        quoted(id).alias("doc_id"), quoted(text).alias("text"), quoted(lang).cast("string").alias("lang")
    ).where((fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())


def _grams(learning: DataFrame) -> DataFrame:
    """``lang``, filled slots and their counts of every learning document with a letter, written."""

    def count(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [gram_counts(x.as_py()) for x in part.column(1)]
                keep = [i for i, c in enumerate(found) if c is not None]
                filled = [np.flatnonzero(found[i]) for i in keep]
                counts = [found[i][f] for i, f in zip(keep, filled)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(keep, pa.int64())),
                    pa.array([f.astype(np.uint16).tobytes() for f in filled], pa.binary()),
                    pa.array([c.astype(np.min_scalar_type(c.max())).tobytes() for c in counts], pa.binary()),
                ], ["lang", "slots", "counts"])

    return stage(learning.select("lang", "text").mapInArrow(count, "lang string, slots binary, counts binary"), "grams")


def _read(slots: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(slots, np.uint16)
    return at, np.frombuffer(counts, f"u{len(counts) // len(at)}")


def _idf(grams: DataFrame) -> np.ndarray:
    """One row per task and dimension, summed; the driver gets ``DIMENSIONS`` sums."""

    def count(batches):
        seen, total = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for batch in batches:
            for x in batch.column(0):
                seen[np.frombuffer(x.as_py(), np.uint16)] += 1
                total += 1
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, DIMENSIONS)), pa.array(np.append(total, seen))], ["slot", "n"]
            )

    rows = grams.select("slots").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    n = np.zeros(DIMENSIONS + 1)
    for r in rows.collect():
        n[r["slot"] + 1] = r["n"]
    return np.log((n[0] + 1) / (n[1:] + 1)) + 0.1


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows of a binary column, and where each row begins and the last ends."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends.astype(np.int64) - ends[0]


def _vectors(batches, idf: np.ndarray):
    """Batches of at most 256 rows with their languages, filled slots, the coordinates in them, and row limits of both."""
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            data, ends = _flat(batch.column(1))
            at, ends = data.view(np.uint16), ends // 2
            n, n_ends = _flat(batch.column(2))
            if not np.array_equal(ends, n_ends):  # counts past 255 take more bytes
                sizes = np.diff(n_ends) // np.diff(ends)
                n = np.concatenate([
                    n[a:b].view(f"u{size}").astype(np.int64)
                    for a, b, size in zip(n_ends[:-1].tolist(), n_ends[1:].tolist(), sizes.tolist())
                ])
            v = (_damped(n) * idf.take(at)).astype(np.float32)
            ends = ends.tolist()
            for a, b in zip(ends, ends[1:]):
                v[a:b] = _scaled(v[a:b])
            yield batch, batch.column(0).to_pylist(), at, v, ends


def _sums(grams: DataFrame, idf: np.ndarray, centers: dict[str, np.ndarray] | None) -> dict[str, dict[int, np.ndarray]]:
    """Sums of the vectors nearest to each centroid of their language; without any, of all of a language."""
    sent = grams.sparkSession.sparkContext.broadcast((idf, centers))

    def add(batches):
        weights, known = sent.value
        sums: dict = {}

        def handed_on():
            for (lang, row), q in sums.items():
                at = np.flatnonzero(q)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array([row] * len(at), pa.int32()),
                     pa.array(at.astype(np.int32)), pa.array(q[at])], ["lang", "row", "slot", "q"])
            sums.clear()

        for _, langs, at, v, ends in _vectors(batches, weights):
            places: dict = {}
            mine = [
                places.setdefault(
                    (lang, 0 if known is None else int(np.argmax(known[lang].take(at[a:b], axis=1) @ v[a:b]))), len(places)
                ) for lang, a, b in zip(langs, ends, ends[1:])
            ]
            slot = np.repeat(np.array(mine, np.int64) * DIMENSIONS, np.diff(ends))
            slot += at
            # 256 numbers of at most 2 ** 32: doubles hold their sums exactly
            parts = np.bincount(slot, np.rint(v / STEP), len(places) * DIMENSIONS).astype(np.int64).reshape(-1, DIMENSIONS)
            for place, q in zip(places, parts):
                if place not in sums and len(sums) >= OPEN_SUMS:
                    yield from handed_on()
                sums[place] = sums.get(place, 0) + q
        yield from handed_on()

    rows = (
        grams.mapInArrow(add, "lang string, row int, slot int, q long").groupBy("lang", "row", "slot")
        .agg(F.sum("q").alias("q")).toArrow()
    )
    out: dict = {}
    slots, q = rows.column("slot").to_numpy(), rows.column("q").to_numpy()
    for i, (lang, row) in enumerate(zip(rows.column("lang").to_pylist(), rows.column("row").to_pylist())):
        out.setdefault(lang, {}).setdefault(row, np.zeros(DIMENSIONS))[slots[i]] = q[i] * STEP
    return out


def _extremes(grams: DataFrame, idf: np.ndarray, centers: dict[str, np.ndarray], nearest: bool) -> dict[str, tuple[float, np.ndarray]]:
    """Per language the vector nearest to its centroids, or farthest from all of them, and its cosine."""
    sent = grams.sparkSession.sparkContext.broadcast((idf, centers))
    sign = 1.0 if nearest else -1.0

    def best(batches):
        weights, known = sent.value
        found: dict = {}

        def handed_on():
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.string()),
                     *[pa.array(c, t) for c, t in zip(zip(*found.values()), (pa.float64(), pa.binary(), pa.binary()))]],
                    ["lang", "score", "slots", "counts"])
            found.clear()

        for batch, langs, at, v, ends in _vectors(batches, weights):
            for i, (lang, a, b) in enumerate(zip(langs, ends, ends[1:])):
                if lang in known:
                    score = sign * float((known[lang].take(at[a:b], axis=1) @ v[a:b]).max())
                    if lang not in found and len(found) >= OPEN_SUMS:
                        yield from handed_on()
                    if lang not in found or score >= found[lang][0]:
                        here = score, batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                        found[lang] = max(found.get(lang, here), here)
        yield from handed_on()

    rows = (
        grams.mapInArrow(best, "lang string, score double, slots binary, counts binary").groupBy("lang")
        .agg(F.max(F.struct("score", "slots", "counts")).alias("best")).select("lang", "best.*").collect()
    )
    out = {}
    for r in rows:
        counts = np.zeros(DIMENSIONS, np.int64)
        at, n = _read(bytes(r["slots"]), bytes(r["counts"]))
        counts[at] = n
        out[r["lang"]] = sign * r["score"], unit(counts, idf)
    return out


def fit_centroids(grams: DataFrame, idf: np.ndarray, k: int = CENTROIDS) -> dict[str, np.ndarray]:
    """Spherical k-means of every language from a fixed start (nearest to the mean, then farthest first)."""

    def scaled(x):
        return (x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)).astype(np.float32)

    means = {lang: scaled(rows[0])[None] for lang, rows in _sums(grams, idf, None).items()}
    centers = {lang: v[None] for lang, (_, v) in _extremes(grams, idf, means, nearest=True).items()}
    growing = centers
    while growing and len(next(iter(growing.values()))) < k:
        far = _extremes(grams, idf, growing, nearest=False)
        growing = {lang: np.vstack([centers[lang], v]) for lang, (cosine, v) in far.items() if cosine <= 1 - 1e-6}
        centers = centers | growing
    for _ in range(ROUNDS if centers else 0):
        sums = _sums(grams, idf, centers)
        moved = {
            lang: np.stack([scaled(sums[lang][j]) if j in sums[lang] else c for j, c in enumerate(rows)])
            for lang, rows in centers.items()
        }
        still = all(np.array_equal(moved[lang], rows) for lang, rows in centers.items())
        centers = moved
        if still:
            break
    return centers


def _floors(learning: DataFrame, idf: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """A row per centroid, a column per length; where a centroid has no text of a length, that of the next shorter."""
    sent = learning.sparkSession.sparkContext.broadcast((idf, np.ascontiguousarray(centroids.T)))

    def nearest(batches):
        weights, centers = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                found: tuple = ([], [], [])
                for x in batch.column(0).slice(start, 256):
                    for kept, more in zip(found, prefix_cosines(x.as_py(), weights, centers)):
                        kept += more
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(found, (pa.int32(), pa.int32(), pa.float64()))],
                    ["row", "length", "cosine"],
                )

    cosines = stage(learning.select("text").mapInArrow(nearest, "row int, length int, cosine double"), "cosines")
    rows = group_percentiles(cosines, ["row", "length"], ["cosine"], [LOW], LARGE_GROUP).collect()
    floors = np.full((len(centroids), LENGTHS), np.nan)
    for r in rows:
        floors[r["row"], r["length"]] = SLACK * r["cosine"][0]
    floors[:, 0] = np.where(np.isnan(floors[:, 0]), 0.0, floors[:, 0])
    for n in range(1, LENGTHS):
        floors[:, n] = np.where(np.isnan(floors[:, n]), floors[:, n - 1], floors[:, n])
    return floors


def learn(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    ship(docs.sparkSession)
    learning = _learning(docs, id, text, lang)
    grams = _grams(learning)
    idf = _idf(grams)
    languages = grams.select("lang").distinct().count()
    if (size := languages * CENTROIDS * DIMENSIONS * 4) > MODEL_BYTES:
        raise ValueError(f"{languages} languages make a model of {size} bytes, more than MODEL_BYTES")
    fitted = sorted(fit_centroids(grams, idf).items())
    if not fitted:
        return Model(idf, [], np.zeros((0, DIMENSIONS), np.float32), np.zeros((0, LENGTHS)))
    centroids = np.concatenate([rows for _, rows in fitted])
    return Model(idf, [lang for lang, rows in fitted for _ in rows], centroids, _floors(learning, idf, centroids))


def judge(texts: list[str | None], model: Model) -> list[tuple[str, float, bool]]:
    """Language, cosine and whether it is rejected, for each text."""
    out: list[tuple[str, float, bool]] = []
    for start in range(0, len(texts), 256):
        found = [None if t is None else gram_counts(t) for t in texts[start : start + 256]]
        known = [i for i, c in enumerate(found) if c is not None]
        part = [(UNKNOWN, 0.0, True)] * len(found)
        if known and model.langs:
            cosines = np.stack([model.vector(found[i]) for i in known]) @ model.centroids.T
            best = np.argmax(cosines, axis=1)
            for i, j, c in zip(known, best.tolist(), cosines[np.arange(len(best)), best].tolist()):
                part[i] = (model.langs[j], min(1.0, max(0.0, c)), c < model.floors[j, length_of(found[i])])
        out += part
    return out


def predict(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every whole text."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id].dataType.simpleString()
    frame = docs.select(
        quoted(id).alias("doc_id"), F.coalesce(fold(quoted(id)) == 0, F.lit(False)).alias("held_out"),
        quoted(text).alias("text"),
    )

    def run(batches):
        for batch in batches:
            judged = judge([x.as_py() for x in batch.column(2)], sent.value)
            langs, scores, rejected = zip(*judged) if judged else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rejected, pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return frame.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows of ``docs`` that are not rejected; no shuffle, no join."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            rejected = [r for _, _, r in judge([x.as_py() for x in batch.column(at)], sent.value)]
            yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
