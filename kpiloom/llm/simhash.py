"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits, each set if it is set in over half of the hashes of the
text's word shingles.  Equal fingerprints are one node.  Anchors are the words of a
covering code: the perfect binary Golay code (23 bits, radius 3) on bits 0-22 and
again on bits 23-45.  Each node has one home anchor, the code words within the radius
of its two blocks.  A node that differs from another in at most ``t`` bits lies
within radius plus ``t`` of the other's home, the ``t`` shared by both blocks; so
every node is replicated to all anchors within that reach (about 61, of which those
above its own home suffice, as links have two ends), and each anchor compares its
home nodes with all that came.  Links are found exactly.

Anchors that very many nodes reach, at home there or not, are cut further: the nodes of
such an anchor meet by all but two of eight bytes of the fingerprint, for every choice of
the two, which two fingerprints within two bits must share.  So a meeting place holds at
most ``CROWDED`` nodes, or 65,536 different fingerprints.

A task links the nodes of its anchors and emits a spanning star per linked group, not
all pairs.  Groups are then joined to components by contraction.

Defined results: null text counts as empty; a text without words has fingerprint
zero, linked like any other; null ids count as no id when the smallest is taken;
repeated rows come back as often; an empty table gives an empty table; other columns
are not read.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import lookup, quoted, ship, text_of, word_runs
from kpiloom.llm.components import components
from kpiloom.session import broadcast_if_small, stage

SHINGLE = 3
DISTANCE = 2
SEED = 42
#: Fixed value: generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
BLOCK = 23
RADIUS = 3
#: An anchor that more nodes than this reach is cut further.
CROWDED = 4096
#: Pairs compared in one numpy step.
PAIRS = 1_000_000
HASHES = 1 << 16


# --- fingerprints -------------------------------------------------------------------


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    ones, n, last = np.zeros(64, dtype=np.int64), 0, []

    def add(hashes: list[int]) -> None:
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[:] += bits.sum(axis=0, dtype=np.int64)

    for words in word_runs(text.encode("utf-8").lower()):
        words = last + words
        shingles = map(b" ".join, zip(*[words[k:] for k in range(shingle)]))
        while hashes := [xxhash.xxh64_intdigest(s, seed) for s in itertools.islice(shingles, HASHES)]:
            add(hashes)
            n += len(hashes)
        last = words[-(shingle - 1):] if shingle > 1 else []
    if not n and last:
        add([xxhash.xxh64_intdigest(b" ".join(last), seed)])
        n = 1
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little") if n else 0


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``key`` (a hash of the text) and ``fp`` (the fingerprint as a signed long) of every whole text."""
    ship(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()
    frame = docs.select(quoted(id).alias("doc_id"), _key(text).alias("key"), text_of(quoted(text)).alias("text"))

    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(x.as_py(), shingle) for x in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "key", "fp"]
            )

    return frame.mapInArrow(run, f"doc_id {kind}, key long, fp long")


def _key(text: str) -> Column:
    return F.xxhash64(text_of(quoted(text)))


# --- anchors ------------------------------------------------------------------------


class Cosets:
    """Error patterns of the code by syndrome, lightest first, up to radius plus reach."""

    def __init__(self, reach: int):
        weights = range(RADIUS + reach + 1)
        patterns = np.array(
            [sum(1 << b for b in bits) for w in weights for bits in itertools.combinations(range(BLOCK), w)], np.int64
        )
        self.low = self._remainders(np.arange(1 << 12, dtype=np.int64))
        self.high = self._remainders(np.arange(1 << (BLOCK - 12), dtype=np.int64) << 12)
        syndromes = self.syndrome(patterns)
        order = np.argsort(syndromes, kind="stable")
        self.patterns = patterns[order]
        self.excess = np.maximum(np.bitwise_count(self.patterns).astype(np.int64) - RADIUS, 0)
        self.stops = np.cumsum(np.bincount(syndromes, minlength=1 << 11))
        self.starts = np.concatenate(([0], self.stops[:-1]))

    @staticmethod
    def _remainders(values: np.ndarray) -> np.ndarray:
        values = values.copy()
        for bit in range(BLOCK - 1, 10, -1):
            values ^= np.where(values >> bit & 1, GOLAY << (bit - 11), 0)
        return values

    def syndrome(self, values: np.ndarray) -> np.ndarray:
        return self.low[values & 4095] ^ self.high[values >> 12]

    def home(self, values: np.ndarray) -> np.ndarray:
        """The one code word within the radius."""
        return values ^ self.patterns[self.starts[self.syndrome(values)]]

    def around(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every value each code word in reach: index of the value, code word, bits beyond the radius."""
        s = self.syndrome(values)
        counts = self.stops[s] - self.starts[s]
        at = np.repeat(np.arange(len(values)), counts)
        first = np.cumsum(counts) - counts
        k = np.arange(len(at)) - np.repeat(first, counts) + np.repeat(self.starts[s], counts)
        return at, values[at] ^ self.patterns[k], self.excess[k]


@functools.lru_cache(maxsize=2)
def cosets(reach: int) -> Cosets:
    return Cosets(reach)


def home_anchors(fps: np.ndarray, code: Cosets) -> np.ndarray:
    mask = (1 << BLOCK) - 1
    return code.home(fps & mask) | code.home(fps >> BLOCK & mask) << BLOCK


def reached_anchors(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the fingerprint and anchor, for each anchor in reach that is not below its home."""
    code, mask = cosets(distance), (1 << BLOCK) - 1
    one, two = fps & mask, fps >> BLOCK & mask
    home = code.home(one) | code.home(two) << BLOCK
    at, word, spent = code.around(one)
    at2, word2, spent2 = code.around(two)
    count2 = np.bincount(at2, minlength=len(fps))
    first2 = np.cumsum(count2) - count2
    repeat = count2[at]
    left = np.repeat(np.arange(len(at)), repeat)
    right = np.arange(len(left)) - np.repeat(np.cumsum(repeat) - repeat, repeat) + np.repeat(first2[at], repeat)
    fits = spent[left] + spent2[right] <= distance
    left, right = left[fits], right[fits]
    owner, anchor = at[left], word[left] | word2[right] << BLOCK
    above = anchor >= home[owner]
    return owner[above], anchor[above]


def replicas(nodes: DataFrame, distance: int) -> DataFrame:
    """``anchor, at_home, fp``: every node at its home and at the anchors in reach above it."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                fps = batch.column(0).slice(start, 1024).to_numpy(zero_copy_only=False)
                home = home_anchors(fps, cosets(distance))
                owner, anchor = reached_anchors(fps, distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(anchor == home[owner]), pa.array(fps[owner])],
                    ["anchor", "at_home", "fp"],
                )

    return nodes.select("fp").mapInArrow(run, "anchor long, at_home boolean, fp long")


# --- links --------------------------------------------------------------------------


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least index of each index's group under the links ``a - b``."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        if not len(a):
            break
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def link_groups(key: np.ndarray, at_home: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links of the fingerprints that a comparison at their meeting place joins; keys sorted, home rows first."""
    n = len(key)
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(starts, n))
    homes = np.add.reduceat(at_home.astype(np.int64), starts) if n else sizes
    busy = (homes > 0) & (sizes > 1)
    starts, sizes, homes = starts[busy], sizes[busy], homes[busy]
    # one entry per home row: it meets the rows after it in its group
    first = np.repeat(starts, homes)
    row = first + np.arange(len(first)) - np.repeat(np.cumsum(homes) - homes, homes)
    meets = np.repeat(starts + sizes, homes) - row - 1
    links_a, links_b, low = [], [], 0
    reach = np.cumsum(meets)
    while low < len(row):
        done = reach[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(reach, done + PAIRS, side="right")))
        a = np.repeat(row[low:high], meets[low:high])
        before = np.cumsum(meets[low:high]) - meets[low:high]
        b = a + 1 + np.arange(len(a)) - np.repeat(before, meets[low:high])
        near = np.bitwise_count(fps[a] ^ fps[b]) <= distance
        links_a.append(a[near])
        links_b.append(b[near])
        if sum(map(len, links_a)) > PAIRS:
            root = _spanning(np.concatenate(links_a), np.concatenate(links_b), n)
            member = np.flatnonzero(root != np.arange(n))
            links_a, links_b = [member], [root[member]]
        low = high
    if not links_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    root = _spanning(np.concatenate(links_a), np.concatenate(links_b), n)
    member = np.flatnonzero(root != np.arange(n))
    return fps[member].view(np.int64), fps[root[member]].view(np.int64)


def _bytes_kept() -> list[int]:
    """For every two of eight bytes: the mask of the other six."""
    out = []
    for two in itertools.combinations(range(8), 2):
        mask = sum(0xFF << (8 * b) for b in range(8) if b not in two)
        out.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return out


def _meet(rows: DataFrame, distance: int) -> DataFrame:
    """Links among ``key, at_home, fp``, dealt by key and streamed in key order."""

    def linked(part: pa.Table):
        fps = part.column("fp").to_numpy().view(np.uint64)
        a, b = link_groups(part.column("key").to_numpy(), part.column("at_home").to_numpy(), fps, distance)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches):
        held: list[pa.RecordBatch] = []  # rows of one key, or of several and the last of them open
        for batch in batches:
            if not batch.num_rows:
                continue
            first, last = batch.column(0)[0].as_py(), batch.column(0)[-1].as_py()
            if held and first == last == held[-1].column(0)[-1].as_py():
                held.append(batch)  # still the same key: nothing is copied
                continue
            table = pa.Table.from_batches([*held, batch])
            cut = int(np.searchsorted(table.column("key").to_numpy(), last))
            if cut:
                yield linked(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield linked(pa.Table.from_batches(held))

    dealt = rows.repartition("key").sortWithinPartitions("key", F.col("at_home").desc(), "fp")
    return dealt.mapInArrow(run, "a long, b long")


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: links that span the groups of nodes within ``distance`` bits; ``nodes`` is a written table."""
    if not 0 <= distance <= 2:
        raise ValueError("anchors and their cuts are laid out for a distance of at most 2 bits")
    ship(nodes.sparkSession)
    rows = replicas(nodes, distance)
    crowds = stage(
        rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("at_home").alias("home"))
        .where(F.col("home") & (F.col("n") > CROWDED)).select("anchor"),
        "crowds",
    )
    if not crowds.head(1):
        return _meet(rows.select(F.col("anchor").alias("key"), "at_home", "fp"), distance)
    marked = rows.join(broadcast_if_small(crowds.withColumn("crowded", F.lit(True))), "anchor", "left")
    masks = F.array(*[F.lit(m).cast("long") for m in _bytes_kept()])
    places = F.when(
        F.col("crowded"),
        F.transform(masks, lambda m, i: F.xxhash64(F.col("anchor"), i, F.col("fp").bitwiseAND(m))),
    ).otherwise(F.array("anchor"))
    return _meet(marked.select(F.explode(places).alias("key"), "at_home", "fp"), distance)


def _rooted(rows: DataFrame, distance: int) -> DataFrame:
    """``fp, least, root`` of every fingerprint of a written table: its least id, and a node that names its component."""
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes, distance))
    return stage(
        nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )


def groups(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, fp, component_id`` per row; the component is named by the smallest id reachable."""
    rows = stage(fingerprints(docs, shingle, id, text), "fingerprints")
    rooted = _rooted(rows, distance)
    named = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    placed = stage(lookup(rooted.select("fp", "root"), named, "root").select("fp", "component_id"), "placed")
    return lookup(rows, placed, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of ``docs`` of each component: that with the smallest id, null last, then the least hash of the text.

    Of rows that agree in id and text, any one stays.
    """
    rows = stage(fingerprints(docs, shingle, id, text), "fingerprints")
    found = lookup(rows, _rooted(rows, distance).select("fp", "root"), "fp", "inner")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "key")).alias("least")
    # nulls inside a struct are equal, so a null id finds its row
    keepers = stage(
        found.groupBy("root").agg(least).select(F.struct("least.doc_id", "least.key").alias("keeper")), "keepers"
    )
    own, mark = (max([name, *docs.columns], key=len) + end for name, end in (("keeper", "_"), ("mark", "__")))
    placed = docs.withColumn(own, F.struct(quoted(id).alias("doc_id"), _key(text).alias("key")))
    kept = placed.join(keepers.withColumnRenamed("keeper", mark), F.col(f"`{own}`") == F.col(f"`{mark}`"), "left_semi")
    twice = stage(
        rows.groupBy(F.struct("doc_id", "key").alias(mark)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(mark),
        "repeated-rows",
    )
    if twice.head(1):  # only these rows are looked at again
        same = F.col(f"`{own}`") == F.col(f"`{mark}`")
        once = kept.join(twice, same, "left_anti")
        kept = once.unionByName(kept.join(twice, same, "left_semi").dropDuplicates([own]))
    return kept.drop(own)
