"""Token ids in a binary chunk format of shuffled planes.

File format. Ids of documents in ascending document order are unsigned 32-bit
integers. A chunk holds whole documents; its ids are cut into blocks of a fixed
number of ids, the last one shorter. Each block is transposed: byte planes (byte k
of every id together) or bit planes (bit k of every id together, eight ids to a
byte). Each plane is compressed by itself with zstandard; planes of zeros take no
bytes. A chunk is one row of a Parquet table written by Spark, so whole shards
appear or none do, on any store Spark writes:

    shard, chunk     place of the chunk; shards are in ascending document order
    first            ids of the shard before the chunk
    n_ids, block     ids of the chunk, ids of a block
    bits             whether planes are bit planes
    doc_ids, n_tokens  the documents of the chunk, in order, and their ids
    sizes            compressed bytes of each plane, block after block
    payload          the planes

``shard, chunk, first, n_ids, sizes`` are the chunk index: reading them alone
locates any id, block or plane.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm import arrow, store, units

BLOCK = 1 << 16
CHUNK = 1 << 18
LEVEL = 1

CHUNKS = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("chunk", T.IntegerType()),
    T.StructField("first", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("block", T.IntegerType()), T.StructField("bits", T.BooleanType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("n_tokens", T.ArrayType(T.LongType())),
    T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("payload", T.BinaryType()),
])

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("shard", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType()),
])


def planes_of(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of one block, lowest first."""
    table = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if not bits:
        return [plane.tobytes() for plane in np.ascontiguousarray(table)]
    split = np.unpackbits(np.ascontiguousarray(table)[:, None, :], axis=1, bitorder="little")
    return [plane.tobytes() for plane in np.packbits(split.reshape(32, -1), axis=1, bitorder="little")]


def ids_of(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    """The block whose planes these are; an empty plane is all zeros."""
    width = (n + 7) // 8 if bits else n
    table = np.zeros((len(planes), width), np.uint8)
    for row, plane in zip(table, planes, strict=True):
        if plane:
            row[:] = np.frombuffer(plane, np.uint8)
    if bits:
        split = np.unpackbits(table, axis=1, count=n, bitorder="little").reshape(4, 8, n)
        table = np.packbits(split, axis=1, bitorder="little").reshape(4, n)
    return np.ascontiguousarray(table.T).reshape(-1).view("<u4")


def pack_ids(ids: np.ndarray, block: int = BLOCK, bits: bool = False, level: int = LEVEL) -> tuple[list[int], bytes]:
    """(sizes, payload) of a chunk."""
    press = zstandard.ZstdCompressor(level=level).compress
    parts = [
        press(plane) if plane.count(0) < len(plane) else b""
        for at in range(0, len(ids), block)
        for plane in planes_of(ids[at : at + block], bits)
    ]
    return [len(part) for part in parts], b"".join(parts)


def unpack_ids(sizes, payload: bytes, n_ids: int, block: int, bits: bool) -> np.ndarray:
    """The ids of a chunk."""
    unpress, ends, n_planes = zstandard.ZstdDecompressor().decompress, np.cumsum(sizes), 32 if bits else 4
    out, part = [], 0
    view = memoryview(payload)
    for at in range(0, n_ids, block):
        planes = []
        for k in range(part, part + n_planes):
            planes.append(unpress(view[ends[k] - sizes[k] : ends[k]]) if sizes[k] else b"")
        out.append(ids_of(planes, min(block, n_ids - at), bits))
        part += n_planes
    return np.concatenate(out) if out else np.empty(0, "<u4")


def encode_chunks(
    docs: DataFrame, vocabulary: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text",
    block: int = BLOCK, chunk: int = CHUNK, bits: bool = False,
) -> DataFrame:
    """Chunks of all documents, shards in ascending document order.

    A null text is empty and has only ``end_id``. Documents without an id come
    first; rows that share an id are ordered by their text's hash. A document longer
    than a chunk makes a chunk of its own. Other columns are not stored.
    """
    arrow.small_batches(docs.sparkSession)
    rows = docs.select(arrow.column(doc_id).cast("long").alias("doc_id"), arrow.column(text).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = units.encoder(vocabulary, keeps_spaces=True)
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        names, lengths, parts, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            sizes, payload = pack_ids(ids, block, bits)
            row = [shard, number, first, len(ids), block, bits, names, lengths, sizes, payload]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(),
                     pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], kind) for x, kind in zip(row, types, strict=True)], names=CHUNKS.names
            )

        for batch in batches:
            for name, ids in zip(batch.column(0), encode(arrow.texts_of(batch.column(1))), strict=True):
                ids += end
                names.append(name.as_py())
                lengths.append(len(ids) // 4)
                parts.append(ids)
                size += len(ids) // 4
                if size >= chunk:
                    yield close()
                    number, first = number + 1, first + size
                    names, lengths, parts, size = [], [], [], 0
        if names:
            yield close()

    return rows.mapInArrow(arrow.tidy(run), CHUNKS)


def write_chunks(chunks: DataFrame, name: str = "ids") -> DataFrame:
    """Write the chunk table below the shared folder and open it. Payloads are compressed already."""
    return store.written(chunks, name, compression="none")


def shard_starts(chunks: DataFrame) -> DataFrame:
    """(shard, before): ids of all earlier shards, from the chunk index alone.

    One row for each task that wrote, so the window and a broadcast of it stay small.
    """
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def decode_chunks(chunks: DataFrame) -> DataFrame:
    """Every document of a chunk table: doc_id, start (ids before it), ids (little-endian unsigned 32-bit)."""
    read = ["shard", "first", "n_ids", "block", "bits", "doc_ids", "n_tokens", "sizes", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i] for k, name in enumerate(read)}
                sizes = row["sizes"].values.to_numpy(zero_copy_only=False)
                body = row["payload"].as_buffer()
                n, block, bits = (row[name].as_py() for name in ("n_ids", "block", "bits"))
                ids = unpack_ids(sizes, body, n, block, bits)
                lengths = row["n_tokens"].values.to_numpy(zero_copy_only=False)
                ends = np.cumsum(lengths)
                offsets = pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        row["doc_ids"].values,
                        pa.array(np.full(len(ends), row["shard"].as_py(), np.int32)),
                        pa.array(ends - lengths + row["first"].as_py()),
                        pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets, pa.py_buffer(ids.tobytes())]),
                    ],
                    names=DOCUMENTS.names,
                )

    found = chunks.select(*read).mapInArrow(arrow.tidy(run), DOCUMENTS)
    starts = shard_starts(chunks)
    return found.join(F.broadcast(starts), "shard").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "ids"
    )


