"""Hourly facts kept up to date by a stream of messages.

Every batch is stored first. Then the days it touched are worked out anew from all
their stored events, so late events count, repeated ones do not, and the facts equal
those of the batch job at any time. The article dimension is read afresh for each
batch; days that hold events of articles it did not know are noted, and are worked out
again once it knows one of them. The store may be compacted between batches: the
compacted days it has noted are read beside its batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from footfall.plans import jobs
from footfall.schemas import UNMATCHED
from footfall.sources.raw_log import parse_messages
from footfall.functions.timeparts import day_of
from footfall.sources.tables import overwrite_days, stored_parquet, written
from footfall.streaming import ingest


def keep_facts(
    stream: DataFrame, store: str, facts: str, checkpoint: str, articles: Callable[[], DataFrame],
    compacted: str | None = None,
) -> DataStreamWriter:
    """Writer that stores every batch and brings the hourly facts below ``facts`` up to date.

    ``articles`` reads the dimension. A batch that is run again gives the same facts.
    ``compacted`` holds compacted days, besides the folders that the store has noted.
    """
    spark = stream.sparkSession
    run = ingest.run_of(spark, store, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        ingest.write_batch(batch, batch_id, store, run=run)
        accepted = parse_messages(batch).filter(F.col("status") == "ok")
        days = accepted.select(day_of(F.col("ts")).alias("day"))
        update_facts(spark, store, facts, days, articles(), compacted)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    )


def update_facts(
    spark: SparkSession, store: str, facts: str, days: DataFrame, articles: DataFrame, compacted: str | None = None
) -> None:
    """Work out the facts of some days (column ``day``), and of those that wait for an article."""
    articles = written(articles, "articles")
    known = articles.select(F.col("article_id").cast("string").alias("article_id"))
    waiting = stored_parquet(spark, f"{facts}/unmatched", UNMATCHED)
    waiting = waiting.join(known, "article_id", "left_semi").select("day")
    touched = [row["day"] for row in days.unionByName(waiting).distinct().collect()]  # a date each
    if not touched:
        return
    chosen = F.col("day").isin(touched)
    folders = ingest.compacted_folders(spark, store, compacted)
    events = written(ingest.read_events(spark, store, days=chosen, compacted=folders), "events")
    jobs.hourly_facts(events, articles, facts, chosen)
    unknown = events.join(known, "article_id", "left_anti").select("article_id", "day").distinct()
    overwrite_days(unknown, f"{facts}/unmatched", chosen)
