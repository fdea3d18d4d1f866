"""Best-fit packing of token pieces into sequences by hierarchical residual packing.

Round one deals the pieces evenly over tasks of a bounded number of items; each task
packs best-fit decreasing and emits the bins that are nearly full.  Bins with room
left go to the next round as items of their own, met by those of other tasks, in a
tree of fewer and fewer tasks.  It ends when one task has seen all that was left, or
when a round merges next to nothing; whatever is left then is emitted as it is.  No
task ever holds more than ``ITEMS_PER_TASK`` items (evenly dealt), however many
underfull bins there are.

Every round is a written table, so a lost executor repeats one round's task at most.

Defined results: null text counts as empty (its only id is the end mark); repeated
rows are pieces of their own; an empty table gives an empty table; other columns are
not read.  Ties between items of one size go by document and piece.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.llm.bpe import PATTERN, encoder_of, vocabulary
from kpiloom.llm.common import quoted, ship, text_of
from kpiloom.session import stage

CAPACITY = 1024
END_ID = 2
ITEMS_PER_TASK = 50_000
#: Tasks of a round whose leftovers meet in one task of the next.
FAN_IN = 4
#: A bin is nearly full from this share of the capacity on.
NEARLY_FULL = 0.995
#: A round that merges less than this share of its items is the last.
LEAST_GAIN = 0.01


@functools.lru_cache(maxsize=1)
def fast_encoding(path: str) -> tiktoken.Encoding:
    """The tokenizer file as ranks; its ids must follow the order of its merges."""
    v = vocabulary(path)
    special = set(v.special.values())
    ranks = {b: i for i, b in enumerate(v.token_bytes) if i not in special}
    if len(v.merged) and (np.diff(v.merged) <= 0).any():
        raise ValueError("ids do not follow the order of the merges; use bpe.encode")
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=v.special)


def ids_of(text: str, encoding: tiktoken.Encoding, path: str) -> np.ndarray:
    """Ids of a text; the fast encoder's pattern engine gives up on runs of about a million blanks."""
    try:
        return np.asarray(encoding.encode_to_numpy(text, allowed_special="all"), dtype="<u4")
    except ValueError:
        return encoder_of(path).encode([text])[0].astype("<u4")


def piece_bounds(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids: only the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n else []


def token_pieces(
    docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, ids]`` of every whole text, one scan."""
    ship(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()
    frame = docs.select(quoted(id).alias("doc_id"), text_of(quoted(text)).alias("text"))

    def run(batches):
        encoding = fast_encoding(path)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, x in enumerate(batch.column(1)):
                tokens = np.concatenate((ids_of(x.as_py(), encoding, path), end))
                for p, (s, n) in enumerate(piece_bounds(len(tokens), capacity)):
                    part = tokens[s : s + n]
                    row.append(k)
                    piece.append(p)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        ids.append(part.astype(np.int32))
            columns = [
                batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    more = ", ids array<int>" if with_ids else ""
    return frame.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long{more}")


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each item; items in falling size, each into the fullest bin that takes it."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms = 0  # bit r: some bin has r left
    bins, made = [], 0
    for size in sizes:
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, made
            made += 1
        room -= size
        if room:
            open_bins[room].append(b)
            rooms |= 1 << room
        bins.append(b)
    return bins


def _round(items: DataFrame, tasks: int, capacity: int, number: int) -> DataFrame:
    """One task packs its items; rows are bins with the parts of their items in order."""
    full = int(capacity * NEARLY_FULL)
    frame = items.repartition(tasks).select(
        "size", F.col("parts")[0]["doc_id"].alias("lead"), F.col("parts")[0]["piece"].alias("lead_piece"), "parts"
    )
    schema = T.StructType([
        T.StructField("done", T.BooleanType()), T.StructField("size", T.LongType()),
        T.StructField("bin", T.LongType()), T.StructField("parts", items.schema["parts"].dataType),
        T.StructField("offsets", T.ArrayType(T.LongType())),
    ])

    def run(batches):
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        order = pc.sort_indices(
            table, sort_keys=[("size", "descending"), ("lead", "ascending"), ("lead_piece", "ascending")]
        )
        table = table.take(order).combine_chunks()
        sizes = table.column("size").to_numpy()
        bins = np.array(best_fit(sizes.tolist(), capacity), dtype=np.int64)
        by_bin = np.argsort(bins, kind="stable")
        parts = table.column("parts").combine_chunks().take(pa.array(by_bin))
        parts = parts.combine_chunks() if isinstance(parts, pa.ChunkedArray) else parts
        counts = np.bincount(bins, weights=pc.list_value_length(table.column("parts")).to_numpy()).astype(np.int64)
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        inside = parts.flatten()
        lengths = pc.struct_field(inside, "length").to_numpy()
        before = np.cumsum(lengths) - lengths
        before -= np.repeat(before[offsets[:-1]], counts)
        whole = pa.ListArray.from_arrays(pa.array(offsets), inside)
        places = pa.ListArray.from_arrays(pa.array(offsets), pa.array(before))
        filled = np.bincount(bins, weights=sizes).astype(np.int64)
        first = ((number + 1) << 55) + (TaskContext.get().partitionId() << 32)
        out = pa.RecordBatch.from_arrays(
            [pa.array(filled >= full), pa.array(filled), pa.array(first + np.arange(len(filled))), whole, places],
            ["done", "size", "bin", "parts", "offsets"],
        )
        for at in range(0, out.num_rows, 4096):
            yield out.slice(at, 4096)

    return frame.mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """``pieces`` (a written table: doc_id, piece, length, ...) with ``sequence_id`` and ``offset``.

    Lengths must lie between 1 and ``capacity``.  Pieces that fill a sequence alone
    never move; the others are packed in rounds.
    """
    names = pieces.columns
    alone = pieces.where(F.col("length") == capacity).select(
        *names, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    items = pieces.where(F.col("length") < capacity).select(
        F.col("length").alias("size"), F.array(F.struct(*names)).alias("parts")
    )
    done, number = [], 0
    count = items.count()
    tasks = max(1, -(-count // items_per_task))
    while count:
        packed = stage(_round(items, tasks, capacity, number), f"packing-{number}")
        rest = packed.where(~F.col("done"))
        left, made = rest.count(), packed.count()
        last = tasks == 1 or made > (1 - LEAST_GAIN) * count and number > 0 or not left
        done.append(packed if last else packed.where("done"))
        if last:
            break
        items, count, number = rest.select("size", "parts"), left, number + 1
        tasks = max(-(-tasks // FAN_IN), -(-left // items_per_task))
    placed = alone
    for bins in done:
        placed = placed.unionByName(
            bins.select("bin", F.explode(F.arrays_zip("parts", "offsets")).alias("_at")).select(
                *[F.col("_at")["parts"][c].alias(c) for c in names],
                F.col("bin").alias("sequence_id"),
                F.col("_at")["offsets"].alias("offset"),
            )
        )
    return placed


def pack_documents(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of all documents in as few sequences as the rounds find; one row per piece."""
    return pack(stage(token_pieces(docs, path, id, text), "pieces"))


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from pieces with ids and their places; doc ids must be unique."""
    keyed = placed.select("doc_id", "piece", "sequence_id", "offset")
    parts = pieces.select("doc_id", "piece", "ids").join(keyed, ["doc_id", "piece"])
    return parts.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids")
    )
