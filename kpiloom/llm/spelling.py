"""Spelling variants: words one edit apart, by range searches in k-d trees over letter counts.

A word becomes the vector of its letter counts.  Replacing a letter lowers one count and
raises another, inserting one raises one count, so words one edit apart are at L1 distance
two at most: up one and down one within a length, up one from a length to the next.

Words of a length are cut into cells by the top of a k-d tree over their counts, planned
on a bounded sample (``SAMPLE``); every word lies in one cell.  A word goes as a point to
its own cell and as a query to all cells, of its length and of the next, whose box is
within reach.  In a cell the tree goes on down to leaves of a few words: queries descend
together, a box out of reach is pruned, and the words of a leaf are compared letter by
letter.  A pair is met in the one cell that holds its point, so partial counts and best
forms per word simply add up.  Words with equal counts are never compared: one edit changes
them.

The plan has at most ``MOST_CELLS`` cells, which is its size bound as a broadcast; cells
hold ``CELL`` words where that suffices.

Defined results: null text has no words; a null id counts as the empty string in the hash
of a run; repeated rows count each; words under ``LEAST_LENGTH`` letters or seen less than
``LEAST_COUNT`` times are left out; an empty table gives an empty table; other columns are
not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import quoted, ship
from kpiloom.session import stage

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form must be so many times as frequent.
FORM_RATIO = 10
#: One run in so many loses a letter.
LOSSY = 31
CELL = 20_000
MOST_CELLS = 16_384
SAMPLE = 400_000
LEAF = 16
#: Letter comparisons that a worker holds at once.
HELD = 4_000_000
#: Distinct words that a worker counts before it hands them on.
KNOWN_WORDS = 400_000
_LETTERS = 26 + 64
#: Shorter runs cannot become words.
_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
#: Dimension of a latin-1 byte: a-z, then U+00C0 to U+00FF.
_DIMENSION = np.zeros(256, dtype=np.int64)
_DIMENSION[97:123] = np.arange(26)
_DIMENSION[192:256] = np.arange(26, _LETTERS)


def runs_of(text: str, id: str) -> Counter:
    """Occurrences of each long enough word of a text, after the loss of a letter where the hash asks for it."""
    begin = zlib.crc32(f"{id}:".encode("utf-8", "surrogatepass"))
    # bytes are lowered in ASCII only
    low = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    out: Counter = Counter()
    for run, n in Counter(_RUN.findall(low)).items():
        h = zlib.crc32(run.encode(), begin)
        if h % LOSSY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        out[run] += n
    return out


def word_counts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of every word that is long and frequent enough."""
    ship(docs.sparkSession)
    frame = docs.where(quoted(text).isNotNull()).select(
        F.coalesce(quoted(id).cast("string"), F.lit("")).alias("id"), quoted(text).alias("text")
    )

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for x, t in zip(batch.column(0), batch.column(1)):
                for word, n in runs_of(t.as_py(), x.as_py()).items():
                    held[word] += n
                if len(held) > KNOWN_WORDS:
                    yield _counted(held)
                    held = Counter()
        if held:
            yield _counted(held)

    def _counted(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
        )

    return frame.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= LEAST_COUNT
    )


def letters_of(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), length)


def counts_of(letters: np.ndarray) -> np.ndarray:
    """Letter counts, those above 255 as 255, which brings vectors only nearer."""
    out = np.zeros((len(letters), _LETTERS), dtype=np.uint8)
    step = max(1, HELD // max(1, letters.shape[1]))
    for low in range(0, len(letters), step):
        part = _DIMENSION[letters[low : low + step]]
        flat = part + np.arange(len(part))[:, None] * _LETTERS
        sums = np.bincount(flat.ravel(), minlength=len(part) * _LETTERS).reshape(len(part), _LETTERS)
        out[low : low + step] = np.minimum(sums, 255)
    return out


def best_cut(counts: np.ndarray) -> tuple[int, int] | None:
    """Dimension and largest count of the lower half of the evenest cut; none if all vectors are equal."""
    best, where, half = 0, None, len(counts) / 2
    for d in np.flatnonzero(counts.min(axis=0) != counts.max(axis=0)):
        below = np.cumsum(np.bincount(counts[:, d]))[:-1]
        k = int(np.argmin(np.abs(below - half)))
        smaller = min(below[k], len(counts) - below[k])
        if smaller > best:
            best, where = smaller, (int(d), k)
    return where


def descend(queries: np.ndarray, at: np.ndarray, ups: np.ndarray, downs: np.ndarray, box, cut, most_downs: int):
    """The queries that reach the lower and the upper half of a box, with their ways up and down to it.

    ``box`` has the least and greatest count of each dimension; a query may rise by one
    and fall by ``most_downs`` on its way to a point.
    """
    d, k = cut
    low, high = int(box[0][d]), int(box[1][d])
    q = queries[at, d].astype(np.int16)
    out = []
    for new_low, new_high in ((low, k), (k + 1, high)):
        u = ups - np.maximum(low - q, 0) + np.maximum(new_low - q, 0)
        v = downs - np.maximum(q - high, 0) + np.maximum(q - new_high, 0)
        stay = (u <= 1) & (v <= most_downs)
        out.append((at[stay], u[stay], v[stay]))
    return out


def halves(box, cut):
    d, k = cut
    lower, upper = box[1].copy(), box[0].copy()
    lower[d], upper[d] = k, k + 1
    return (box[0], lower), (upper, box[1])


def whole_box() -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(_LETTERS, dtype=np.int16), np.full(_LETTERS, 255, dtype=np.int16)


def plan(counts: np.ndarray, cells: int):
    """Nested cuts of a sample into about so many cells: a cell, or (cut, lower, upper)."""
    number = iter(range(1 << 62))

    def grow(part: np.ndarray, wanted: float):
        cut = best_cut(part) if wanted > 1 and len(part) > 1 else None
        if cut is None:
            return next(number)
        below = part[:, cut[0]] <= cut[1]
        share = below.mean()
        return cut, grow(part[below], wanted * share), grow(part[~below], wanted * (1 - share))

    return grow(counts, cells)


def cell_of(tree, counts: np.ndarray) -> np.ndarray:
    """The cell in which each vector lies."""
    out = np.zeros(len(counts), dtype=np.int64)
    todo = [(tree, np.arange(len(counts)))]
    while todo:
        node, at = todo.pop()
        if isinstance(node, int):
            out[at] = node
        elif len(at):
            (d, k), lower, upper = node
            below = counts[at, d] <= k
            todo += [(lower, at[below]), (upper, at[~below])]
    return out


def cells_near(tree, counts: np.ndarray, most_downs: int):
    """Query number and cell, for every cell within reach."""
    zero = np.zeros(len(counts), dtype=np.int16)
    todo, rows, cells = [(tree, whole_box(), np.arange(len(counts)), zero, zero)], [], []
    while todo:
        node, box, at, ups, downs = todo.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            rows.append(at)
            cells.append(np.full(len(at), node, dtype=np.int64))
            continue
        cut, *children = node
        parts = descend(counts, at, ups, downs, box, cut, most_downs)
        todo += [(c, b, *p) for c, b, p in zip(children, halves(box, cut), parts)]
    return (np.concatenate(rows), np.concatenate(cells)) if rows else (np.zeros(0, int), np.zeros(0, int))


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.count_nonzero(a != b, axis=-1) == 1


def one_inserted(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether leaving out one letter of ``longer`` gives ``shorter``."""
    n = shorter.shape[-1]
    # equal before the first difference, and after it when shifted by one
    same, shifted = shorter == longer[..., :n], shorter == longer[..., 1:]
    before = np.logical_and.accumulate(same, axis=-1).sum(axis=-1)
    after = np.logical_and.accumulate(shifted[..., ::-1], axis=-1).sum(axis=-1)
    return before + after >= n


def search(points: np.ndarray, point_counts: np.ndarray, queries: np.ndarray, query_counts: np.ndarray):
    """Query and point number of every pair one edit apart; queries are as long as the points or one shorter.

    Yields blocks, so the pairs of a cell are never held together.
    """
    shorter = queries.shape[1] < points.shape[1]
    check, most_downs = (one_inserted, 0) if shorter else (one_replaced, 1)
    zero = np.zeros(len(queries), dtype=np.int16)
    todo = [(whole_box(), np.arange(len(points)), np.arange(len(queries)), zero, zero)]
    width = points.shape[1]
    while todo:
        box, inside, at, ups, downs = todo.pop()
        if not len(at):
            continue
        part = point_counts[inside]
        cut = best_cut(part) if len(inside) > LEAF else None
        if cut is None:
            if len(inside) > LEAF:  # all points have one vector: queries at another distance go
                apart = np.abs(query_counts[at].astype(np.int16) - part[0]).sum(axis=1)
                at = at[(apart > 0) & (apart <= 1 + most_downs)]
            step = max(1, HELD // (len(inside) * width))
            for low in range(0, len(at), step):
                some = at[low : low + step]
                q, p = np.nonzero(check(queries[some][:, None, :], points[inside][None, :, :]))
                if len(q):
                    yield some[q], inside[p]
            continue
        below = part[:, cut[0]] <= cut[1]
        parts = descend(query_counts, at, ups, downs, box, cut, most_downs)
        for b, points_in, p in zip(halves(box, cut), (inside[below], inside[~below]), parts):
            todo.append((b, points_in, *p))


def _plans(words: DataFrame) -> dict[int, object]:
    """A plan of cells for each length that asks for more than one."""
    lengths = words.groupBy(F.length("word").alias("length")).count().where(F.col("count") > CELL)
    sizes = {r["length"]: r["count"] for r in lengths.collect()}
    if not sizes:
        return {}
    total = sum(sizes.values())
    cell = max(CELL, total // MOST_CELLS)
    share = min(1.0, SAMPLE / total)
    drawn = words.where(
        F.length("word").isin(list(sizes))
        & (F.pmod(F.xxhash64(F.lit("cells"), "word"), F.lit(1 << 20)) < int(share * (1 << 20)))
    ).select("word").toArrow().column("word").to_pylist()
    by_length: dict[int, list[bytes]] = {}
    for word in sorted(drawn):
        by_length.setdefault(len(word), []).append(word.encode("latin-1"))
    return {
        n: plan(counts_of(letters_of(found, n)), -(-sizes[n] // cell))
        for n, found in sorted(by_length.items())
    }


_PLACED = "length int, cell long, point boolean, code binary, n long"


def _placed(words: DataFrame, plans: dict[int, object]) -> DataFrame:
    """Every word as a point of its cell, and as a query of all cells in reach."""
    sent = words.sparkSession.sparkContext.broadcast(plans)

    def run(batches):
        for batch in batches:
            by_length: dict[int, list[int]] = {}
            codes = [x.as_py().encode("latin-1") for x in batch.column(0)]
            for k, code in enumerate(codes):
                by_length.setdefault(len(code), []).append(k)
            codes, n = pa.array(codes, pa.binary()), batch.column(1)
            for length, rows in by_length.items():
                rows = np.array(rows)
                counts = counts_of(letters_of(codes.take(pa.array(rows)).to_pylist(), length))
                own = sent.value.get(length, 0)
                yield _rows(length, cell_of(own, counts), True, codes, n, rows)
                at, cells = cells_near(own, counts, 1)
                yield _rows(length, cells, False, codes, n, rows[at])
                at, cells = cells_near(sent.value.get(length + 1, 0), counts, 0)
                yield _rows(length + 1, cells, False, codes, n, rows[at])

    def _rows(length, cells, point, codes, n, rows):
        at = pa.array(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(rows), length), pa.int32()), pa.array(cells), pa.array(np.full(len(rows), point)),
             codes.take(at), n.take(at)],
            ["length", "cell", "point", "code", "n"],
        )

    return words.select("word", "n").mapInArrow(run, _PLACED)


def _in_cell(table: pa.Table) -> pa.Table:
    """Near words and the most frequent of them, for each word of a cell that has any there."""
    is_point = table.column("point").to_numpy()
    codes, n = table.column("code").to_pylist(), table.column("n").to_numpy()
    at = sorted(np.flatnonzero(is_point).tolist(), key=codes.__getitem__)
    out: list[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    length = len(codes[at[0]]) if at else 0
    points = [codes[i] for i in at]
    point_letters = letters_of(points, length)
    point_counts, point_n = counts_of(point_letters), n[at]
    for size in (length, length - 1):
        asking = sorted(
            (i for i in np.flatnonzero(~is_point).tolist() if len(codes[i]) == size), key=codes.__getitem__
        ) if at else []
        if not asking:
            continue
        queries = [codes[i] for i in asking]
        letters = letters_of(queries, size)
        asked = _Best(queries, n[asking])
        points_best = _Best(points, point_n)
        for q, p in search(point_letters, point_counts, letters, counts_of(letters)):
            asked.add(q, p, points_best)
            if size < length:
                points_best.add(p, q, asked)
        out += [asked.table(), points_best.table()]
    return pa.concat_tables(out) if out else _Best([], np.zeros(0, dtype=np.int64)).table()


class _Best:
    """Number of near words and the best of them, for sorted words of which the others are told in blocks."""

    def __init__(self, words: list[bytes], n: np.ndarray):
        self.words, self.n = words, n
        self.near = np.zeros(len(words), dtype=np.int64)
        self.best_n = np.zeros(len(words), dtype=np.int64)
        self.best: dict[int, bytes] = {}

    def add(self, own: np.ndarray, other: np.ndarray, others: _Best) -> None:
        self.near += np.bincount(own, minlength=len(self.words))
        # of each own word the other one of largest n, then the smallest, which comes first
        order = np.lexsort((other, -others.n[other], own))
        own, other = own[order], other[order]
        first = np.ones(len(own), dtype=bool)
        first[1:] = own[1:] != own[:-1]
        for i, j in zip(own[first].tolist(), other[first].tolist()):
            if others.n[j] > self.best_n[i] or others.n[j] == self.best_n[i] and others.words[j] < self.best[i]:
                self.best_n[i], self.best[i] = others.n[j], others.words[j]

    def table(self) -> pa.Table:
        at = np.flatnonzero(self.near)
        return pa.table({
            "word": pa.array([self.words[i].decode("latin-1") for i in at], pa.string()),
            "n_near": pa.array(self.near[at], pa.int64()),
            "best_n": pa.array(self.best_n[at], pa.int64()),
            "best": pa.array([self.best[i].decode("latin-1") for i in at.tolist()], pa.string()),
        })


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of the words (written table ``word, n``) that have a word one edit away."""
    ship(words.sparkSession)
    found = (
        _placed(words, _plans(words)).groupBy("length", "cell")
        .applyInArrow(_in_cell, "word string, n_near long, best_n long, best string")
    )
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    ).select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form, by doubling the step each round."""
    steps = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(
            steps.join(ahead, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        steps = moved.select("word", "root")
        # n grows tenfold with every step, so 64-bit counts end this after five rounds
        if not moved.where("moved").head(1):
            return steps


def variants(docs: DataFrame, id: str = "doc_id", text: str = "text", ratio: int = FORM_RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    words = stage(word_counts(docs, id, text), "words")
    is_form = F.col("best_n") >= F.col("n") * ratio
    joined = stage(
        words.join(near_words(words), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(joined.where(F.col("form").isNotNull()))
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
