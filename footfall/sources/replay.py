"""Replay of a whole log in the order of time, slice after slice.

A topic keeps the order of one key only, and one task can't send everything. So the log
is numbered in order of time and stored in slices of so many rows; a slice is sent when
the one before it is done, by all tasks, each user's rows by one of them in order. Small
slices can be sent several in a job, by one task, in the same order. What
arrives from one slice is older than all of the next. A mark is set when a slice is done,
so a replay that was stopped goes on with the first slice without one; that slice (or
those of its job) may have been sent in part, and the store resolves what comes twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.operators.positions import store_positions
from footfall.sources.raw_log import EVENT_ORDER, to_messages, to_messages_in_turn
from footfall.sources.tables import _folder, stored_parquet


class Slices(NamedTuple):
    """A log stored in slices."""

    path: str
    schema: T.StructType


def store_slices(events: DataFrame, path: str, slice_rows: int = 1_000_000) -> Slices:
    """Number events in order of time and store them in slices of ``slice_rows``.

    Rows without a readable time come first, as null does.
    """
    order = [name for name in (*EVENT_ORDER, "behavior_time", "seq") if name in events.columns]
    return Slices(path, store_positions(events, order, f"{path}/rows", slice_rows))


def _mark(slices: Slices, number: int) -> str:
    return f"{slices.path}/sent/{number}"


def _sent(spark: SparkSession, slices: Slices) -> set[int]:
    """The slices that are done."""
    folder, files = _folder(spark, f"{slices.path}/sent")
    return {int(s.getPath().getName()) for s in files.listStatus(folder)} if files.exists(folder) else set()


def _in_groups(left: list[Row], rows: int) -> Iterator[list[Row]]:
    """Slices that follow each other, at most ``rows`` rows together, or one."""
    group, size = [], 0
    for row in left:
        if group and size + row["rows"] > rows:
            yield group
            group, size = [], 0
        group.append(row)
        size += row["rows"]
    if group:
        yield group


def send_slices(
    spark: SparkSession, slices: Slices, publish: Callable[[DataFrame, int], None],
    speed: float | None = None, most: int | None = None, together: int | None = None,
) -> int:
    """Send the slices that are not yet done, in order, and return how many were sent.

    ``publish`` gets a slice's messages and its number. With ``speed`` a slice waits until
    as much time has gone by since the first one of this call as lies between their first
    events, divided by ``speed``. ``most`` stops after so many slices.

    A job for each slice takes longer than the sending where slices are small. With
    ``together``, ``publish`` is called once for slices that follow each other, of so many
    rows at most (or one slice, as always with ``speed``), with the number of the first. It
    gets their messages with the columns ``slice`` and ``position``, in that order, from one
    task, so no message comes before those of the slice before. They are marked when all
    are done.
    """
    stored = stored_parquet(spark, f"{slices.path}/rows", slices.schema)
    # One row per slice, with the time of its first event in seconds.
    second = F.min("ts").cast("timestamp").cast("double")
    starts = stored.groupBy("range").agg(second.alias("start"), F.count("*").alias("rows")).orderBy("range").collect()
    done = _sent(spark, slices)
    left = [row for row in starts if row["range"] not in done][:most]
    begun, origin = time.monotonic(), None
    for group in _in_groups(left, 0 if speed or not together else together):
        first, last = group[0]["range"], group[-1]["range"]
        if speed and group[0]["start"] is not None:
            origin = group[0]["start"] if origin is None else origin
            time.sleep(max(0.0, (group[0]["start"] - origin) / speed - (time.monotonic() - begun)))
        rows = stored.where(F.col("range").between(first, last))
        if together:
            publish(to_messages_in_turn(rows.withColumnRenamed("range", "slice"), "slice", "position"), first)
        else:
            publish(to_messages(rows), first)
        for row in group:
            folder, files = _folder(spark, _mark(slices, row["range"]))
            files.mkdirs(folder)
    return len(left)
