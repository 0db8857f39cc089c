"""Helpers to run numpy code over the Arrow batches of a Spark task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 1 << 20

# Bytes of the Arrow batches that Spark hands to a task's Python code.
BATCH_BYTES = 1 << 23

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand rows over in small batches, whose memory is held on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def release() -> None:
    """Give memory that a task has freed back to the system, as Python workers live on."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def tidy(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over a task's batches that releases freed memory when the task ends."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            release()

    return run


def column(name: str):
    """A column by its exact name, which may hold dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` that clash with none of ``names``; Spark ignores case."""
    taken = {name.lower() for name in names}
    return [name for name in df.columns if name.lower() not in taken]


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so; Spark ignores case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts_of(array: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts with 64-bit offsets; a null counts as an empty text."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return pc.fill_null(array.cast(pa.large_string()), "")


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of texts with 64-bit offsets, at least one."""
    _, offsets_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offsets_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.empty(0, np.uint8), offsets


def blocks(texts: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split texts into (first, last, bytes, offsets) of about ``max_bytes``.

    A block holds whole texts, at least one, so only a longer text makes a larger
    block. Offsets count from the block's first byte.
    """
    n = len(texts)
    if not n:
        return
    data, offsets = bytes_of(texts)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def add_columns(
    df: DataFrame,
    needed: list[str],
    fields: T.StructType,
    make: Callable[[], Callable[..., list]],
    keep: bool = False,
) -> DataFrame:
    """Append columns worked out from the ``needed`` ones, batch by batch.

    ``make`` runs once in each task and returns the function from the needed Arrow
    columns to the new ones. Columns of ``df`` that clash with a new one give way.
    With ``keep`` the function returns one boolean mask instead and the rows it
    rejects are left out.
    """
    small_batches(df.sparkSession)
    rest = without(df, [] if keep else fields.names)
    read = list(dict.fromkeys([*rest, *needed]))
    names = rest if keep else rest + fields.names
    # Plain names for the pass through Python, which takes none with dots.
    plain = [f"c{i}" for i in range(len(names))]
    kinds = [df.schema[name].dataType for name in rest] + ([] if keep else [field.dataType for field in fields])
    schema = T.StructType([T.StructField(name, kind) for name, kind in zip(plain, kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            found = compute(*(batch.column(read.index(name)) for name in needed))
            if keep:
                yield batch.select(list(range(len(rest)))).filter(pa.array(found)).rename_columns(plain)
                continue
            old = [batch.column(i) for i in range(len(rest))]
            new = [x if isinstance(x, pa.Array) else pa.array(x) for x in found]
            yield pa.RecordBatch.from_arrays(old + new, names=plain)

    inputs = df.select(*(column(name).alias(f"c{i}") for i, name in enumerate(read)))
    return inputs.mapInArrow(tidy(run), schema).toDF(*names)
