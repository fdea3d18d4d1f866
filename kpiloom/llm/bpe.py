"""Byte-level BPE by a pair occurrence index.

Texts are cut into words by the tokenizer's pattern.  The distinct words of a block
of a partition lie in one symbol array, linked forwards and backwards inside each
word.  An index maps every adjacent pair that has a merge rank to all positions where
it stands.  Active ranks are applied in ascending order; applying one merges all its
positions at once (left to right where they overlap), and only the lists of the
pairs around the merged places change.  Within a word this is the usual rule, lowest
rank first, so ids equal those of the tokenizer library.

Decoding maps ids back to their bytes and reads these as UTF-8.

Memory of a task: one Arrow batch, one block of ``BLOCK_CHARS`` characters with its
symbol arrays, and at most ``CACHED_WORDS`` words carried from block to block.

Defined results: null text counts as empty and has no ids; an added token's string in
a text becomes that token's id; repeated rows are encoded row by row; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import quoted, ship, text_of

#: Fixed value: how byte-level BPE of this family cuts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of text whose new words are merged together.
BLOCK_CHARS = 8_000_000
#: Words whose ids a task remembers between blocks.
CACHED_WORDS = 600_000
#: From this length on words are drawn one at a time instead of as a list.
LONG_TEXT = 2_000_000
NEVER = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(plain)))
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Ids, bytes and merge ranks of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        to_byte = {letter: b for b, letter in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_bytes = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(to_byte[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode("utf-8")
        self.byte_id = np.array([vocab[letter] for letter in letters], dtype=np.int32)
        self.size = len(self.token_bytes)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self.doubled = np.array([a == b for a, b in pairs])
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = np.append(keys[order], np.int64(2**62)), np.append(order, NEVER).astype(np.int32)
        self.words = regex.compile(PATTERN)
        self.special_cut = (
            regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
            if self.special else None
        )

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the words one after another, and the number of ids of each word."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
    symbol = v.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
    ends = np.cumsum(sizes)
    after = np.arange(1, total + 1, dtype=np.int32)
    before = np.arange(-1, total - 1, dtype=np.int32)
    after[ends[sizes > 0] - 1] = -1
    before[(ends - sizes)[sizes > 0]] = -1

    rank = np.full(total, NEVER, dtype=np.int32)
    inner = np.flatnonzero(after >= 0)
    rank[inner] = v.pair_ranks(symbol[inner], symbol[inner + 1])

    scratch = np.zeros(total, dtype=np.int32)
    places: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def index(positions: np.ndarray, ranks: np.ndarray) -> None:
        """Enter positions into the lists of their ranks."""
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        starts = np.flatnonzero(np.concatenate(([True], ranks[1:] != ranks[:-1])))
        stops = [*starts[1:].tolist(), len(ranks)]
        for r, start, stop in zip(ranks[starts].tolist(), starts.tolist(), stops):
            if r in places:
                places[r].append(positions[start:stop])
            else:
                places[r] = [positions[start:stop]]
                heapq.heappush(active, r)

    ranked = inner[rank[inner] != NEVER].astype(np.int32)
    if len(ranked):
        index(ranked, rank[ranked])
    del inner, ranked
    while active:
        r = heapq.heappop(active)
        lists = places.pop(r)
        left = lists[0] if len(lists) == 1 else np.concatenate(lists)
        left = left[rank[left] == r]
        if not len(left):
            continue
        if len(lists) > 1:  # a position may have come back to a pair: keep its last entry
            entry = np.arange(len(left), dtype=np.int32)
            scratch[left] = entry
            left = left[scratch[left] == entry]
        if v.doubled[r] and len(left) > 1:
            left.sort()
            chained = np.concatenate(([False], after[left[:-1]] == left[1:]))
            run_start = np.maximum.accumulate(np.where(chained, 0, np.arange(len(left))))
            left = left[(np.arange(len(left)) - run_start) % 2 == 0]
        right = after[left]
        beyond = after[right]
        symbol[left] = v.merged[r]
        symbol[right] = -1
        rank[right] = NEVER
        after[left] = beyond
        inside = beyond >= 0
        before[beyond[inside]] = left[inside]
        previous = before[left]
        previous = previous[previous >= 0]
        rank[left] = NEVER
        scratch[left] = -1
        previous = previous[scratch[previous] != -1]  # the others are merged ones themselves
        scratch[left] = 0
        changed = np.concatenate((left[inside], previous))
        if not len(changed):
            continue
        ranks = v.pair_ranks(symbol[changed], symbol[after[changed]])
        rank[changed] = ranks
        found = ranks != NEVER
        if found.any():
            index(changed[found], ranks[found])
    alive = symbol >= 0
    counts = np.concatenate(([0], np.cumsum(alive)))
    return symbol[alive], counts[ends] - counts[ends - sizes]


class Numbers(dict):
    """Word -> number in order of first sight; ``new`` lists the words not merged yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class Encoder:
    """Ids of texts, block by block; remembers words within a bound."""

    def __init__(self, path: str):
        self.v = vocabulary(path)
        self._forget()

    def _forget(self) -> None:
        self.number = Numbers()
        self.ids = np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def _drawn(self, text: str):
        if len(text) < LONG_TEXT:
            return self.v.words.findall(text)
        return (m.group() for m in self.v.words.finditer(text))

    def _numbers(self, text: str) -> np.ndarray:
        """Word numbers of a text; added tokens are ``-1 - id``."""

        def plain(part: str) -> np.ndarray:
            return np.fromiter(map(self.number.__getitem__, self._drawn(part)), dtype=np.int64)

        cut = self.v.special_cut
        if cut is None or not any(s in text for s in self.v.special):
            return plain(text)
        parts = cut.split(text)  # plain and added parts by turns
        return np.concatenate([
            np.array([-1 - self.v.special[p]], np.int64) if k % 2 else plain(p) for k, p in enumerate(parts)
        ])

    def _merge(self, new: list[str]) -> None:
        ids, counts = merge_words([w.encode("utf-8") for w in new], self.v)
        starts = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate((self.ids, ids))
        self.first = np.concatenate((self.first, starts))
        self.count = np.concatenate((self.count, counts))

    def _ids(self, numbers: np.ndarray) -> np.ndarray:
        if not len(numbers):
            return np.zeros(0, np.int32)
        added = numbers < 0
        if added.any():
            where = np.flatnonzero(added)
            parts, last = [], 0
            for w in where.tolist():
                parts += [self._ids(numbers[last:w]), np.array([-1 - numbers[w]], np.int32)]
                last = w + 1
            return np.concatenate([*parts, self._ids(numbers[last:])])
        counts = self.count[numbers]
        stops = np.cumsum(counts)
        shift = self.first[numbers] - (stops - counts)
        return self.ids[np.repeat(shift, counts) + np.arange(int(stops[-1]))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of one block of texts."""
        if len(self.number) > CACHED_WORDS:
            self._forget()
        numbers = [self._numbers(t) for t in texts]
        if self.number.new:
            self._merge(self.number.new)
            self.number.new = []
        return [self._ids(n) for n in numbers]


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One per Python worker, so that later tasks start with the words of earlier ones."""
    return Encoder(path)


def decode_ids(ids: np.ndarray, v: Vocabulary) -> str:
    return b"".join(map(v.token_bytes.__getitem__, ids.tolist())).decode("utf-8", errors="replace")


def blocks(texts: pa.ChunkedArray | pa.Array):
    """Row ranges of about ``BLOCK_CHARS`` characters with their texts, null as empty."""
    start, size, held = 0, 0, []
    for k, text in enumerate(texts):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= BLOCK_CHARS:
            yield start, held
            start, size, held = k + 1, 0, []
    if held:
        yield start, held


def _map(docs: DataFrame, id: str, text: str, schema: str, rows) -> DataFrame:
    """``rows(ids of the block, texts)`` gives the columns of a block, after its ids."""
    ship(docs.sparkSession)
    frame = docs.select(quoted(id).alias("doc_id"), text_of(quoted(text)).alias("text"))
    kind = docs.schema[id].dataType.simpleString()

    def run(batches):
        make = rows()
        for batch in batches:
            for start, texts in blocks(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), *[pa.array(c, t) for c, t in make(texts)]],
                    ["doc_id", *[c.split()[0] for c in schema.split(", ")]],
                )

    return frame.mapInArrow(run, f"doc_id {kind}, {schema}")


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text."""

    def rows():
        encoder = encoder_of(path)
        return lambda texts: [(encoder.encode(texts), pa.list_(pa.int32()))]

    return _map(docs, id, text, "ids array<int>", rows)


def decode(tokens: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, text`` of every row's ids; null ids count as none."""
    ship(tokens.sparkSession)
    kind = tokens.schema[id].dataType.simpleString()
    no_ids = F.array().cast("array<int>")
    frame = tokens.select(quoted(id).alias("doc_id"), F.coalesce(quoted(ids), no_ids).alias("ids"))

    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            texts = [decode_ids(np.asarray(x.values), v) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return frame.mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode, decode, digests of both, in one pass."""

    def rows():
        encoder = encoder_of(path)

        def make(texts):
            ids = encoder.encode(texts)
            packed = (np.ascontiguousarray(x, dtype="<u4") for x in ids)
            decoded = (decode_ids(x, encoder.v).encode("utf-8") for x in ids)
            return [
                ([len(x) for x in ids], pa.int64()),
                ([hashlib.sha256(x).hexdigest() for x in packed], pa.string()),
                ([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
            ]

        return make

    return _map(docs, id, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", rows)
