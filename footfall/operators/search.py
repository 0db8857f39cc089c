"""Search over the daily article fact: filters, percent of total, pages, timeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.text import LABELS, behavior_label, format_percent, line
from footfall.functions.timeparts import day_key
from footfall.session import ensure_checkpoint_dir

def search_facts(
    article_day: DataFrame,
    start: str,
    end: str,
    domain: str,
    behavior: str | None = None,
    article_id: str | int | None = None,
) -> DataFrame:
    """Rows of one domain from ``start`` to ``end`` (days, both included).

    ``behavior`` and ``article_id`` narrow the result when given; empty text
    counts as not given.
    """
    _require(start=start, end=end, domain=domain)
    wanted = F.col("day").between(_day(start), _day(end)) & (F.col("domain") == domain)
    if behavior not in (None, ""):
        wanted &= F.col("behavior") == behavior
    if article_id not in (None, ""):
        wanted &= F.col("article_id") == article_id
    return article_day.filter(wanted)


def in_result_order(df: DataFrame) -> DataFrame:
    """Ascending by day and count, then by the remaining keys.

    The added keys give a total order and let the sort split a day and count
    that very many rows share.
    """
    return df.orderBy("day", "num", "article_id", "behavior")


def table_view(
    article_day: DataFrame, start: str, end: str, domain: str, behavior: str
) -> DataFrame:
    """Search by behaviour, with percent of total; all inputs are needed."""
    _require(start=start, end=end, domain=domain, behavior=behavior)
    return in_result_order(
        with_percent(search_facts(article_day, start, end, domain, behavior=behavior))
    )


def chart_view(
    article_day: DataFrame, start: str, end: str, domain: str, article_id: str | int
) -> DataFrame:
    """Search by article, with percent of total; all inputs are needed."""
    _require(start=start, end=end, domain=domain, article_id=article_id)
    return in_result_order(
        with_percent(search_facts(article_day, start, end, domain, article_id=article_id))
    )


def grand_total(df: DataFrame) -> DataFrame:
    """One row with the sum of ``num``; nulls are skipped."""
    return df.agg(F.sum("num").alias("total"))


def with_percent(df: DataFrame) -> DataFrame:
    """Add ``percent`` (number) and ``percent_text`` of each row's share of all rows.

    The total is a scalar subquery: a two-step sum, not a window over one task.
    Rows with a null ``num`` get null.
    """
    total = grand_total(df).scalar()
    num = F.col("num")
    share = F.try_divide(F.lit(100).cast("double") * num.cast("double"), total.cast("double"))
    return df.select(
        "*", share.alias("percent"), format_percent(num, total).alias("percent_text")
    )


def result_rows(df: DataFrame) -> DataFrame:
    """A search result with percent as all-text rows; days as ``yyyyMMdd``."""
    return df.select(
        day_key(F.col("day"), compact=True).alias("time"),
        F.col("article_id").cast("string"),
        F.col("domain").cast("string"),
        F.col("behavior").cast("string"),
        F.col("percent_text").alias("percent"),
        F.col("num").cast("string"),
    )


def table_lines(rows: DataFrame) -> DataFrame:
    """Result rows as ``time,domain,article,behavior,num,percent`` lines."""
    names = ("time", "domain", "article_id", "behavior", "num", "percent")
    return rows.select(line(*map(F.col, names)).alias("line"))


def chart_lines(rows: DataFrame) -> DataFrame:
    """Result rows as ``time,behavior,num`` lines."""
    return rows.select(line(F.col("time"), F.col("behavior"), F.col("num")).alias("line"))


def active_days(df: DataFrame) -> DataFrame:
    """The distinct days of a result, ascending: the time axis of its chart."""
    return df.select("day").distinct().orderBy("day")


def behavior_timeline(
    article_day: DataFrame,
    start: str,
    end: str,
    domain: str,
    article_id: str | int | None = None,
) -> DataFrame:
    """Per day the counts of publish, browse and comment, and their sum.

    A day that lacks a behaviour has 0 there. The three columns are conditional
    sums, so the whole pivot is one aggregation.
    """
    found = search_facts(article_day, start, end, domain, article_id=article_id)
    label = behavior_label(F.col("behavior"))
    series = [
        F.coalesce(F.sum(F.when(label == name, F.col("num"))), F.lit(0)).alias(name)
        for name in LABELS
    ]
    timeline = found.groupBy("day").agg(*series)
    stacked = reduce(lambda a, b: a + b, map(F.col, LABELS))
    return timeline.withColumn("stacked", stacked).orderBy("day")


def page(
    df: DataFrame, order_by: Sequence[str | Column], number: int = 0, size: int = 10
) -> DataFrame:
    """Page ``number`` (from 0) of ``df`` sorted by ``order_by``.

    ``order_by`` should end in a unique key, so that pages do not overlap. A page is a
    top-k of all rows up to its end, so its cost grows with its depth: to read on, use
    ``page_after``; to jump about in a result, number it once and use ``page_at``.
    """
    if number < 0 or size < 1:
        raise ValueError("number must be at least 0 and size at least 1")
    return df.orderBy(*order_by).offset(number * size).limit(size)


def page_at(numbered: DataFrame, number: int = 0, size: int = 10) -> DataFrame:
    """Page ``number`` (from 0) of a result that ``with_positions`` has numbered."""
    if number < 0 or size < 1:
        raise ValueError("number must be at least 0 and size at least 1")
    position = F.col("position")
    found = numbered.filter((position >= number * size) & (position < (number + 1) * size))
    return found.orderBy("position").drop("position")


def follows(order_by: Sequence[str], last: Mapping[str, object]) -> Column:
    """Whether a row comes after the row ``last`` (values or columns), ascending by ``order_by``, nulls first."""
    # Built from the last column outwards: greater in this column, or equal
    # here and greater in those that follow.
    beyond = F.lit(False)
    for name in reversed(order_by):
        value, mark = F.col(name), F.lit(last[name])
        greater = F.coalesce(value > mark, value.isNotNull() & mark.isNull())
        beyond = greater | (value.eqNullSafe(mark) & beyond)
    return beyond


def page_after(
    df: DataFrame, order_by: Sequence[str], last: Mapping[str, object] | None, size: int = 10
) -> DataFrame:
    """The ``size`` rows that follow the row ``last``, ascending by ``order_by``.

    Walking on from the last row seen costs the same at any depth. Nulls come first
    in every column, as in an ascending sort, so the walk passes every row of a page.
    """
    rest = df if last is None else df.filter(follows(order_by, last))
    return rest.orderBy(*order_by).limit(size)


def with_positions(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Add the 0-based ``position`` of each row in the order ``order_by``.

    The rows are sorted over all executors and kept in the checkpoint folder;
    the rows before a partition are then counted from one number per partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # The generated id counts rows within a partition in its lower 33 bits.
    row_bits = F.lit((1 << 33) - 1)
    placed = (
        df.orderBy(*order_by)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(row_bits).alias("_row"),
        )
        .checkpoint()
    )
    # One row per sort partition: bounded by spark.sql.shuffle.partitions.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_count"))
        .select("_part", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn("position", F.col("_start") + F.col("_row"))
        .drop("_part", "_row", "_start")
    )


def _day(text: str) -> Column:
    """Day of ``yyyy-MM-dd`` or ``yyyyMMdd``."""
    digits = str(text).replace("-", "")
    return F.lit(f"{digits[:4]}-{digits[4:6]}-{digits[6:]}").cast("date")


def _require(**inputs: object) -> None:
    empty = [name for name, value in inputs.items() if value in (None, "")]
    if empty:
        raise ValueError(f"input can't be empty: {', '.join(empty)}")
