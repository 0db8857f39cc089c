"""Message topics: publish, subscribe, print."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def topic_list(topics: str) -> str:
    """A comma-separated topic list without blanks and repeats."""
    return ",".join(sorted({name.strip() for name in topics.split(",") if name.strip()}))


def kafka_options(servers: str, topics: str, **options: str) -> dict[str, str]:
    """Options to subscribe to ``topics`` from their earliest offset."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic_list(topics),
        "startingOffsets": "earliest",
    } | options


def publish(
    messages: DataFrame, topic: str | None = None, servers: str | None = None,
    fmt: str = "kafka", by: Sequence[str] = (), **options: str,
) -> None:
    """Write ``value`` (and ``key``, if there is one) to a topic, from the executors.

    Any other batch format can stand in for the topic, such as ``text`` with a
    ``path`` option; its files lie in folders by the columns ``by``.
    """
    columns = [name for name in ("key", "value") if name in messages.columns]
    if fmt == "kafka":
        options = {"kafka.bootstrap.servers": servers, "topic": topic} | options
        by = ()
    else:
        columns = ["value"]
    writer = messages.select(*columns, *by).write.format(fmt).options(**options).mode("append")
    (writer.partitionBy(*by) if by else writer).save()


def read_stream(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """Message values as a stream, with what the source tells of their order.

    Columns: ``value``, ``topic``, ``sent_at``, ``part``, ``pos``. A source
    other than Kafka knows only ``value``; the others are null.
    """
    stream = spark.readStream.format(fmt).options(**options).load()
    known = {
        "topic": ("topic", "string"),
        "sent_at": ("timestamp", "timestamp"),
        "part": ("partition", "int"),
        "pos": ("offset", "bigint"),
    }
    return stream.select(
        F.col("value").cast("string"),
        *(
            (F.col(source) if fmt == "kafka" else F.lit(None)).cast(kind).alias(name)
            for name, (source, kind) in known.items()
        ),
    )


def console_tap(stream: DataFrame, rows: int = 20) -> DataStreamWriter:
    """Writer that prints topic and text of the messages; the caller starts it."""
    return (
        stream.select("topic", "value")
        .writeStream.format("console")
        .option("truncate", "false")
        .option("numRows", rows)
    )
