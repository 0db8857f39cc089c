"""The raw behaviour log and its replay as messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.text import RAW_LOG_MARK, log_line, message_fields, message_of
from footfall.functions.timeparts import parse_time, time_text
from footfall.schemas import RAW_LOG

EVENT_ORDER = ("ts", "user_id", "article_id", "behavior")


def read_behavior_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines as text fields; a field a line lacks is null, extra ones are dropped.

    Lines are split as they stand: quotes have no meaning in this log.
    """
    fields = F.split("value", RAW_LOG_MARK, -1)
    return spark.read.text(path).select(
        *(F.get(fields, F.lit(i)).alias(name) for i, name in enumerate(RAW_LOG.names))
    )


def _time(df: DataFrame) -> Column:
    """The text of the time: as the log has it, if ``df`` still holds that, else that of ``ts``."""
    return F.col("behavior_time") if "behavior_time" in df.columns else time_text(F.col("ts"))


def log_lines(events: DataFrame) -> DataFrame:
    """Events as lines of the raw log."""
    line = log_line(F.col("user_id"), F.col("behavior"), F.col("article_id"), _time(events))
    return events.select(line.alias("value"))


def log_events(log: DataFrame) -> DataFrame:
    """Log rows with their time parsed; ``behavior_time`` keeps its text."""
    return log.select(
        parse_time(F.col("behavior_time")).alias("ts"),
        "user_id", "article_id", "behavior", "behavior_time",
    )


def to_messages(events: DataFrame) -> DataFrame:
    """Events as messages, keyed by user and in time order for each user.

    A topic keeps the order of one key only, so that is the order made here: a user's
    events are sent by one task, in order. The text of a log's time is sent unchanged,
    also if it can't be read. Events without a user need no order and go to all tasks.
    """
    order = [name for name in (*EVENT_ORDER, "seq") if name in events.columns]
    spread = F.when(F.col("user_id").isNull(), F.xxhash64(*events.columns))
    sent = events.repartition("user_id", spread).sortWithinPartitions("user_id", *order)
    return sent.select(*_message(events))


def to_messages_in_turn(events: DataFrame, *order: str) -> DataFrame:
    """A bounded number of events as messages that one task sends in ``order``, with those columns."""
    return events.coalesce(1).sortWithinPartitions(*order).select(*_message(events), *order)


def _message(events: DataFrame) -> list[Column]:
    value = message_of(F.col("user_id"), F.col("behavior"), F.col("article_id"), _time(events))
    return [F.col("user_id").cast("string").alias("key"), value.alias("value")]


def parse_messages(messages: DataFrame, *carried: str) -> DataFrame:
    """Messages as events, with ``carried`` columns kept and ``status`` added.

    A message without a readable time, a user or an article is ``rejected`` and
    keeps its text in ``value``; fields beyond the fourth are ignored.
    """
    fields = message_fields(F.col("value"))
    parsed = messages.select(
        *(column.alias(name) for name, column in fields.items()), *carried, "value"
    )
    whole = (
        F.col("ts").isNotNull()
        & (F.coalesce("user_id", F.lit("")) != "")
        & (F.coalesce("article_id", F.lit("")) != "")
    )
    return parsed.select(
        *fields,
        *carried,
        F.when(~whole, F.col("value")).alias("value"),
        F.when(whole, F.lit("ok")).otherwise(F.lit("rejected")).alias("status"),
    )
