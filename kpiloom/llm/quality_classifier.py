"""Quality classifier from supervised subword embeddings.

A document is the bag of its words, of its neighbouring word pairs and of the character
3- and 4-grams inside words (edges marked by the blank beside them), all hashed to
``SLOTS`` slots.  Each slot has a learned vector; the mean of a document's vectors enters
a softmax over two classes.  Vectors and softmax are trained together by stochastic
gradient descent in numpy, one document at a time, on a bounded sample of labelled
documents.  A word that equals the one before it makes a pair of its own kind, so
stuttering texts share a slot whatever they repeat.

Training happens in one Spark task on at most about ``SAMPLE`` documents and
``SAMPLE_SLOTS`` filled slots, chosen by a hash of the id, in an order that no
partitioning changes: a lost executor repeats it with the same outcome.  As the softmax
is linear in the mean, a trained model scores with one number per slot; scoring is one
scan over whole texts and the model is 512 kB whatever the corpus.

Defined results: null and empty texts have no slots and get the learned bias alone; a null
id is never learned from and never held out; labels that are null, other than 0 and 1, or
contradict each other for one id are not learned from; without any label every score is
0.5; repeated rows are scored alike; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import quoted, ship, text_of
from kpiloom.session import stage

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS
#: Labelled documents that a model is fitted on, and the slots that they may fill together.
SAMPLE = 6000
SAMPLE_SLOTS = 24_000_000
DIMENSIONS, EPOCHS, RATE, SEED = 8, 12, 0.5, 42
#: Bytes of text whose slots are held at once.
HELD = 1_000_000
_GRAMS = (3, 4)
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)
_LAST = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _slot(h: np.ndarray, kind: int) -> np.ndarray:
    return ((h + np.uint64(kind)) * _LAST >> np.uint64(64 - SLOT_BITS)).astype(np.int32)


def slots(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slot of every feature of every text, and the number of its text."""
    data = np.frombuffer(b" " + b" ".join(parts) + b" ", dtype=np.uint8)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    owner = np.repeat(np.arange(len(parts)), sizes)  # of the byte after the first blank
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    found, owners = [], []
    wide = data.astype(np.uint32)
    for n in _GRAMS:
        if len(data) < n:
            continue
        last = len(data) - n + 1
        h = wide[:last] * _ODD[0]
        inner = np.zeros(last, dtype=bool)
        for k in range(1, n):
            h ^= (wide[k : last + k] + np.uint32(k)) * _ODD[k]
            h = (h << np.uint32(7)) | (h >> np.uint32(25))
            if k < n - 1:
                inner |= blank[k : last + k]
        # the blank between two texts is an edge mark of both
        at = np.flatnonzero(~inner)
        found.append(_slot(h[at].astype(np.uint64), n))
        owners.append(owner[np.minimum(at, len(owner) - 1)])
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    if len(starts):
        stops = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        lengths = stops - starts
        letters = np.flatnonzero(~blank)
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(letters)) - np.repeat(first, lengths)
        powers = _powers(1 << int(lengths.max() - 1).bit_length())
        h = np.add.reduceat((data[letters].astype(np.uint64) + np.uint64(1)) * powers[place], first)
        whose = owner[starts - 1]
        found.append(_slot(h, 1))
        owners.append(whose)
        near = np.flatnonzero(whose[1:] == whose[:-1]) + 1
        pair = np.where(h[near] == h[near - 1], np.uint64(0), h[near - 1] * np.uint64(31) + h[near])
        found.append(_slot(pair, 2))
        owners.append(whose[near])
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owners)


def _pieces(text: bytes):
    """A very long text in parts cut at blanks (or anywhere in a word of over ``HELD`` bytes)."""
    at = 0
    while at < len(text):
        stop = min(len(text), at + HELD)
        if stop < len(text):
            stop = max(text.rfind(b" ", at + 1, stop), text.rfind(b"\n", at + 1, stop)) + 1 or stop
        yield text[at:stop]
        at = stop


def _grouped(texts: list[str]):
    """Texts, split where they are long, in groups of about ``HELD`` bytes: parts and the number of each one's text."""
    parts, whose, held = [], [], 0
    for k, x in enumerate(texts):
        for part in _pieces(x.encode("utf-8", "surrogatepass")):
            if parts and held + len(part) > HELD:
                yield parts, np.array(whose)
                parts, whose, held = [], [], 0
            parts.append(part)
            whose.append(k)
            held += len(part) + 1
    if parts:
        yield parts, np.array(whose)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots of a text and the share of its features in each."""
    total = np.zeros(SLOTS, dtype=np.int64)
    for parts, _ in _grouped([text]):
        total += np.bincount(slots(parts)[0], minlength=SLOTS)
    at = np.flatnonzero(total)
    return at.astype(np.uint16), (total[at] / max(1, total.sum())).astype(np.float32)


@dataclass
class Model:
    """Learned vectors of the slots, softmax weights and bias."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def per_slot(self) -> tuple[np.ndarray, float]:
        """What a slot adds to the log odds of class 1, and the odds without any."""
        toward = self.weights[:, 1] - self.weights[:, 0]
        return (self.vectors @ toward).astype(np.float64), float(self.bias[1] - self.bias[0])


def untrained() -> Model:
    return Model(np.zeros((SLOTS, DIMENSIONS), np.float32), np.zeros((DIMENSIONS, 2)), np.zeros(2))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> Model:
    """Stochastic gradient descent on the cross entropy of the softmax, one document a step, the rate falling to zero."""
    draw = np.random.default_rng(SEED)
    model = untrained()
    if not bags:
        return model
    model.vectors[:] = draw.uniform(-1.0 / DIMENSIONS, 1.0 / DIMENSIONS, model.vectors.shape)
    model.weights[:] = draw.uniform(-0.5, 0.5, model.weights.shape)
    steps, step = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for k in draw.permutation(len(bags)):
            at, share = bags[k]
            rate = RATE * (1 - step / steps)
            step += 1
            mean = share @ model.vectors[at]
            z = mean @ model.weights + model.bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[k]] -= 1.0
            back = model.weights @ p
            model.weights -= rate * np.outer(mean, p)
            model.bias -= 0.1 * rate * p
            # a mean shrinks every slot's gradient by its share; the square norm of the shares gives it back
            model.vectors[at] -= (rate / max(float(share @ share), 1e-4) * share)[:, None] * back[None, :].astype(np.float32)
    return model


def fold(id: Column) -> Column:
    return F.crc32(id.cast("string").cast("binary")) % FOLDS


def _draw(id: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("quality"), id), F.lit(1 << 20)) / float(1 << 20)


def learn(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE,
) -> Model:
    """A model of ``label`` from the documents outside the held-out fold."""
    ship(docs.sparkSession)
    known = stage(
        labels.select(quoted(id).alias("doc_id"), quoted(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & (fold(F.col("doc_id")) != HELD_OUT))
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where(F.col("label") == F.col("other")).select("doc_id", "label"),
        "labels",
    )
    count = known.count()
    chosen = known.where(_draw(F.col("doc_id")) < min(1.0, sample / max(1, count)))
    # the chosen labels are bounded by ``sample``, whatever the tables hold
    rows = docs.select(quoted(id).alias("doc_id"), text_of(quoted(text)).alias("text")).join(F.broadcast(chosen), "doc_id")

    def bags(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                found = [bag(x.as_py()) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([len(a) for a, _ in found], pa.int64()),
                     pa.array([a.tobytes() for a, _ in found], pa.binary()),
                     pa.array([s.tobytes() for _, s in found], pa.binary())],
                    ["doc_id", "label", "filled", "slots", "shares"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    bagged = stage(
        rows.mapInArrow(bags, f"doc_id {kind}, label int, filled long, slots binary, shares binary"), "bags"
    )
    filled = bagged.agg(F.sum("filled")).first()[0] or 0
    fewer = _draw(F.concat(F.col("doc_id").cast("string"), F.lit("-")))
    bagged = bagged.where(fewer < min(1.0, SAMPLE_SLOTS / max(1, filled)))

    def fit(table):
        order = sorted(zip(*(table.column(c).to_pylist() for c in ("slots", "shares", "label"))))
        model = train(
            [(np.frombuffer(a, np.uint16), np.frombuffer(s, np.float32)) for a, s, _ in order], [c for *_, c in order]
        )
        return pa.table({
            "vectors": pa.array([model.vectors.tobytes()], pa.binary()),
            "weights": pa.array([model.weights.tobytes()], pa.binary()),
            "bias": pa.array([model.bias.tobytes()], pa.binary()),
        })

    fitted = bagged.groupBy(F.lit(0).alias("one")).applyInArrow(fit, "vectors binary, weights binary, bias binary").first()
    if fitted is None:
        return untrained()
    return Model(
        np.frombuffer(bytes(fitted["vectors"]), np.float32).reshape(SLOTS, DIMENSIONS),
        np.frombuffer(bytes(fitted["weights"])).reshape(DIMENSIONS, 2), np.frombuffer(bytes(fitted["bias"])),
    )


def scores(texts: list[str], per_slot: np.ndarray, bias: float) -> np.ndarray:
    """Probability of class 1 of each text."""
    total, features = np.zeros(len(texts)), np.zeros(len(texts))
    for parts, whose in _grouped(texts):
        at, part = slots(parts)
        if len(at):
            total += np.bincount(whose[part], weights=per_slot[at], minlength=len(texts))
            features += np.bincount(whose[part], minlength=len(texts))
    odds = total / np.maximum(features, 1) + bias
    return 1.0 / (1.0 + np.exp(-np.clip(odds, -700, 700)))


def score_documents(
    docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text; one scan."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model.per_slot())
    kind = docs.schema[id].dataType.simpleString()
    frame = docs.select(
        quoted(id).alias("doc_id"), F.coalesce(fold(quoted(id)) == HELD_OUT, F.lit(False)).alias("held_out"),
        text_of(quoted(text)).alias("text"),
    )

    def run(batches):
        for batch in batches:
            found = scores([x.as_py() for x in batch.column(2)], *sent.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return frame.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
