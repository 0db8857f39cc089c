"""Stored behaviour: key ranges, last write per key, wide rows and their cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.timeparts import day_of

EVENT_KEY = ("ts", "user_id", "article_id")

# Rows over which the cells of one time and user are spread. A store keeps one number for
# good, as a row's place depends on it.
PARTS = 16


def latest_behavior(
    events: DataFrame,
    order_by: Sequence[str] = ("seq",),
    keys: Sequence[str] = EVENT_KEY,
) -> DataFrame:
    """Last write per key: the behaviour with the greatest ``order_by`` values.

    Equal ``order_by`` values fall to the greater behaviour, so the result is always
    the same. The rows are clustered by key first: an aggregation of structs sorts its
    input, and so does so once, after the only shuffle, instead of before it as well.
    """
    return latest_writes(events, order_by, keys).select(*keys, "behavior")


def latest_writes(
    events: DataFrame, order_by: Sequence[str], keys: Sequence[str] = EVENT_KEY
) -> DataFrame:
    """Last write per key with its place in the order of writing."""
    last = events.repartition(*keys).groupBy(*keys).agg(
        F.max(F.struct(*order_by, "behavior")).alias("last")
    )
    return last.select(*keys, "last.*")


def key_range(events: DataFrame, start: tuple, stop: tuple) -> DataFrame:
    """Events with ``start <= (ts, user_id) < stop``; equal ends ask for that key.

    Keys are compared as (time, user), not as text. The plain bounds on ``ts``
    (and on ``day``, if the table is stored by day) let the scan skip files and
    row groups.
    """
    ts, user = F.col("ts"), F.col("user_id")
    ts_type, user_type = events.schema["ts"].dataType, events.schema["user_id"].dataType

    def end(key: tuple) -> tuple[Column, Column]:
        return F.lit(str(key[0])).cast(ts_type), F.lit(str(key[1])).cast(user_type)

    (low_ts, low_user), (high_ts, high_user) = end(start), end(stop)
    if tuple(map(str, start)) == tuple(map(str, stop)):
        wanted = (ts == low_ts) & (user == low_user)
    else:
        wanted = (
            (ts >= low_ts)
            & (ts <= high_ts)
            & ((ts > low_ts) | (user >= low_user))
            & ((ts < high_ts) | (user < high_user))
        )
    if "day" in events.columns:
        wanted = F.col("day").between(day_of(low_ts), day_of(high_ts)) & wanted
    return events.filter(wanted)


def part_of(article_id: Column, parts: int = PARTS) -> Column:
    """The row, 0 to ``parts`` - 1, that holds an article's cell, from its id alone."""
    return F.conv(F.substring(F.md5(article_id.cast("string")), 1, 4), 16, 10).cast("int") % parts


def collapse_cells(latest: DataFrame, parts: int = PARTS) -> DataFrame:
    """Wide rows: the cells (article -> behaviour) of one time, user and ``part``.

    ``latest`` holds one row per time, user and article (``latest_behavior``). The part
    of a cell depends on nothing but its article, so rows keep their keys as more cells
    arrive, and a time and user with very many cells is gathered by several tasks.
    """
    cells = F.map_from_entries(F.collect_list(F.struct("article_id", "behavior")))
    spread = latest.withColumn("part", part_of(F.col("article_id"), parts))
    return spread.groupBy("ts", "user_id", "part").agg(cells.alias("cells"))


def explode_cells(wide: DataFrame) -> DataFrame:
    """One row per cell of every wide row."""
    return wide.select("ts", "user_id", F.explode("cells").alias("article_id", "behavior"))
