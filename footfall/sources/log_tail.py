"""The raw log followed as it grows, as a streaming source.

A stream's position is the number of bytes told of each file of a folder, which Spark
keeps in the checkpoint. Only whole lines are told: one that has no end yet waits for it.
What came since is cut into ranges of bytes that tasks read; a line belongs to the range
it begins in. A batch that is run again after a failure reads the same ranges again.

A file may grow and new ones may appear. One that has become shorter than what was told of
it stops the stream; names of removed files must not be used again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from footfall.functions.text import RAW_LOG_MARK, message_of
from footfall.schemas import RAW_LOG

NAME = "log_tail"
# Bytes of a range that one task reads, of a block read at once, and of a batch handed to Spark.
SPLIT_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20
ROWS = pa.schema([("value", pa.string()), ("file", pa.string()), ("at", pa.int64())])


class Line(NamedTuple):
    at: int
    body: bytes


class Span(InputPartition):
    """Lines of a file that begin in [first, last); what lies from ``start`` to ``stop`` is whole lines."""

    def __init__(self, file: str, start: int, first: int, last: int, stop: int):
        super().__init__(file)
        self.file, self.start, self.first, self.last, self.stop = file, start, first, last, stop


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def whole_lines(body: BinaryIO, size: int) -> int:
    """Bytes up to the end of the last whole line."""
    end = size
    while end:
        first = max(0, end - BLOCK_BYTES)
        body.seek(first)
        found = body.read(end - first).rfind(b"\n")
        if found >= 0:
            return first + found + 1
        end = first
    return 0


def lines(body: BinaryIO, span: Span) -> Iterator[Line]:
    """The lines of a span, without their ends."""
    inside = span.first > span.start
    # Inside a file's range the first line begins after the next end of one.
    at = span.first - 1 if inside else span.first
    begin, held = (None if inside else at), []
    body.seek(at)
    while at < span.stop:
        block = body.read(min(BLOCK_BYTES, span.stop - at))
        if not block:
            raise EOFError(f"{span.file} has become shorter than {span.stop} bytes")
        *ended, rest = block.split(b"\n")
        for piece in ended:
            at += len(piece) + 1
            if begin is not None:
                yield Line(begin, b"".join([*held, piece]).removesuffix(b"\r"))
            begin, held = at, []
            if begin >= span.last:
                return
        at += len(rest)
        if begin is not None:
            held.append(rest)


def spans(start: dict[str, int], end: dict[str, int], split: int) -> list[Span]:
    """The ranges between two positions."""
    found = []
    for name, stop in sorted(end.items()):
        told = start.get(name, 0)
        if stop < told:
            raise ValueError(f"{name} has become shorter: {told} bytes were read, {stop} are left")
        found += [Span(name, told, first, min(first + split, stop), stop) for first in range(told, stop, split)]
    return found


class _Tail(DataSourceStreamReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split
        self._known: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        files, root = _folder(self.path)
        found = {}
        for info in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.type != fs.FileType.File or info.base_name[0] in "._":
                continue
            size, end = self._known.get(info.base_name, (-1, 0))
            if size != info.size:
                with files.open_input_file(info.path) as body:
                    end = whole_lines(body, info.size)
                self._known[info.base_name] = info.size, end
            found[info.base_name] = end
        return found

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return spans(start, end, self.split)

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        files, root = _folder(self.path)
        with files.open_input_file(f"{root}/{partition.file}") as body:
            held, size = [], 0
            for line in lines(body, partition):
                held.append(line)
                size += len(line.body) + 64
                if size > BLOCK_BYTES:
                    yield _batch(partition.file, held)
                    held, size = [], 0
            if held:
                yield _batch(partition.file, held)


def _batch(file: str, held: list[Line]) -> pa.RecordBatch:
    texts = [line.body.decode("utf-8", "replace") for line in held]
    return pa.RecordBatch.from_arrays(
        [pa.array(texts, pa.string()), pa.array([file] * len(held)), pa.array([line.at for line in held], pa.int64())],
        schema=ROWS,
    )


class LogTail(DataSource):
    """``format("log_tail")``: lines (value) of the files of ``path`` with their file and place."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string, file string, at bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Tail(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


def tail_lines(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines of a growing log as a stream: ``value``, ``file``, ``at``."""
    spark.dataSource.register(LogTail)
    return spark.readStream.format(NAME).option("splitBytes", str(split_bytes)).load(path)


def tail_messages(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A growing raw log as a stream of messages, with the columns of ``messages.read_stream``.

    Within a file the place of a line orders it; files are told apart by a number of their
    name. A field that a line lacks is empty, so the message is rejected with its text.
    """
    log = tail_lines(spark, path, split_bytes)
    fields = F.split("value", RAW_LOG_MARK, -1)
    named = {name: F.coalesce(F.get(fields, F.lit(i)), F.lit("")) for i, name in enumerate(RAW_LOG.names)}
    return log.select(
        message_of(named["user_id"], named["behavior"], named["article_id"], named["behavior_time"]).alias("value"),
        F.lit(None).cast("string").alias("topic"),
        F.lit(None).cast("timestamp").alias("sent_at"),
        F.pmod(F.crc32(F.col("file").cast("binary")), F.lit(2**31 - 1)).cast("int").alias("part"),
        F.col("at").alias("pos"),
    )
