"""Best-fit packing of token pieces into sequences of a fixed capacity, by a tree of rounds.

Partitions pack their own items best-fit, longest first. Bins that are nearly full
are final. Underfull bins become items of the next round, which groups them anew and
packs them best-fit again; rounds go on with fewer groups until one group has held
them all, or a round has merged almost nothing. A bin keeps its items in order, so a
merged bin only shifts its items.

Only lengths and small columns move between rounds, never tokens. A group holds a
bounded number of items, whatever the input's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm import arrow, store, units

CAPACITY = 2048
# A bin with at most so many free places is final.
SLACK = 8
# Items packed together: in a partition's window (as many, or as many bytes), and in a
# group of a later round.
WINDOW = 1 << 16
WINDOW_BYTES = 1 << 25
GROUP = 1 << 18

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])


class Bins:
    """Open bins by free space; the fullest one that an item fits into is found by one bit search."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0
        self.count = 0

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) of an item of ``length``."""
        fits = self.mask >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            bins = self.by_space[space]
            number = bins.pop()
            if not bins:
                self.mask &= ~(1 << space)
        else:
            space, number = self.capacity, self.count
            self.count += 1
        left = space - length
        if left:
            self.by_space[left].append(number)
            self.mask |= 1 << left
        return number, self.capacity - space


def best_fit(lengths: np.ndarray, capacity: int, bins: Bins | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, packed longest first."""
    bins = bins or Bins(capacity)
    at = np.empty((2, len(lengths)), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        at[:, i] = bins.put(int(lengths[i]))
    return at[0], at[1]


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Token ids of every whole text with ``end_id`` after them, cut at ``capacity``.

    One row per piece: doc_id, piece (from 0), start (the document's ids before it),
    length, ids (little-endian unsigned 32-bit). A null or empty text is the end id
    alone. Rows that share an id are cut each for itself.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = units.encoder(vocabulary, keeps_spaces=False)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in PIECES.names}
            size = 0
            for name, ids in zip(batch.column(0), encode(arrow.texts_of(batch.column(1))), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    for column, value in zip(PIECES.names, (name.as_py(), k, at // 4, len(cut) // 4, cut), strict=True):
                        out[column].append(value)
                    size += len(cut)
                if size >= 1 << 22:
                    yield _batch(out)
                    out, size = {name: [] for name in PIECES.names}, 0
            yield _batch(out)

    arrow.small_batches(docs.sparkSession)
    read = docs.select(arrow.column(doc_id).cast("long").alias("doc_id"), arrow.column(text).alias("text"))
    return read.mapInArrow(arrow.tidy(run), PIECES)


def write_pieces(pieces: DataFrame) -> DataFrame:
    """Write pieces below the shared folder, in small row groups, as a writer holds one, and open them."""
    return store.written(pieces, "pieces", **{"parquet.block.size": str(1 << 24)})


def _batch(out: dict[str, list]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(out[name], kind) for name, kind in zip(PIECES.names, types, strict=True)], names=PIECES.names
    )


def pack_locally(items: DataFrame, capacity: int, slack: int = SLACK, length: str = "length") -> DataFrame:
    """Append ``bin`` and ``place`` (the item's offset in its bin) to items of each partition.

    A partition is packed in windows; each starts with new bins, so memory is bounded
    by a window. A bin's number holds its partition, so it is unique in the result.
    """
    rest = arrow.without(items, ["bin", "place"])
    schema = T.StructType(
        [items.schema[name] for name in rest] + [T.StructField("bin", T.LongType()), T.StructField("place", T.LongType())]
    )
    at = rest.index(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 36
        held, count, size = [], 0, 0

        def pack() -> Iterator[pa.RecordBatch]:
            nonlocal first
            window = pa.Table.from_batches(held)
            lengths = window.column(at).to_numpy()
            bins = Bins(capacity)
            number, place = best_fit(lengths, capacity, bins)
            window = window.append_column("bin", pa.array(number + first)).append_column("place", pa.array(place))
            first += bins.count
            yield from window.combine_chunks().to_batches(max_chunksize=1 << 12)

        for batch in batches:
            held.append(batch)
            count, size = count + batch.num_rows, size + batch.nbytes
            if count >= WINDOW or size >= WINDOW_BYTES:
                yield from pack()
                held, count, size = [], 0, 0
        if count:
            yield from pack()

    return items.select(*(arrow.column(name) for name in rest)).mapInArrow(arrow.tidy(run), schema)


def _round(open_bins: DataFrame, groups: int, turn: int, capacity: int) -> DataFrame:
    """Pack bins (bin, fill) as items: (bin, into, shift, fill)."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bin", ignore_index=True)
        number, shift = best_fit(group["fill"].to_numpy(), capacity)
        # The bin whose items come first names the merged bin.
        root = np.empty(number.max() + 1, np.int64)
        root[number[shift == 0]] = group["bin"].to_numpy()[shift == 0]
        return pd.DataFrame({"bin": group["bin"], "into": root[number], "shift": shift, "fill": group["fill"]})

    salted = open_bins.select(F.pmod(F.xxhash64("bin", F.lit(turn)), F.lit(groups)).alias("group"), "bin", "fill")
    return salted.groupBy("group").applyInPandas(pack, "bin long, into long, shift long, fill long")


def pack(items: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, length: str = "length", group: int = GROUP) -> DataFrame:
    """Place every item of length 1 to ``capacity``: append ``sequence_id`` and ``offset``.

    Offsets are gapless from 0 in each sequence. Other columns are kept; columns
    named ``sequence_id``, ``offset``, ``bin`` or ``place`` give way. Items that are
    equal in all columns are still placed each for itself. An empty table gives none.
    """
    names = arrow.without(items, ["sequence_id", "offset", "bin", "place"])
    plain = [f"c{i}" for i in range(len(names))]
    size = plain[names.index(length)]
    items = items.select(*(arrow.column(name).alias(short) for name, short in zip(names, plain, strict=True)))
    placed = store.written(pack_locally(items, capacity, slack, size), "placed")
    fills = placed.groupBy("bin").agg(F.sum(size).alias("fill"))
    open_bins = store.written(fills.where(F.col("fill") < capacity - slack), "open-bins")
    moves = None
    n, turn = open_bins.count(), 0
    while n > 1:
        groups = math.ceil(n / group)
        merged = store.written(_round(open_bins, groups, turn, capacity), "round")
        step = merged.select(F.col("bin").alias("from"), "into", F.col("shift").alias("by"))
        if moves is None:
            moves = step.select(F.col("from").alias("bin"), "into", F.col("by").alias("shift"))
        else:
            onward = moves.join(step, moves["into"] == step["from"], "left").select(
                moves["bin"], F.coalesce(step["into"], moves["into"]).alias("into"),
                (moves["shift"] + F.coalesce("by", F.lit(0))).alias("shift"),
            )
            moves = store.written(onward, "moves")
        fills = merged.groupBy(F.col("into").alias("bin")).agg(F.sum("fill").alias("fill"))
        open_bins = store.written(fills.where(F.col("fill") < capacity - slack), "open-bins")
        before, n, turn = n, open_bins.count(), turn + 1
        if groups == 1 or n > 0.99 * before:
            break
    if moves is None:
        return placed.toDF(*names, "sequence_id", "offset")
    moved = moves.where(F.col("into") != F.col("bin")).withColumnRenamed("bin", "moved_bin")
    joined = placed.join(moved, placed["bin"] == moved["moved_bin"], "left")
    return joined.select(
        *plain,
        F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("place") + F.coalesce("shift", F.lit(0))).alias("offset"),
    ).toDF(*names, "sequence_id", "offset")
