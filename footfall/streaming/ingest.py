"""Micro-batch ingest of messages into a store of events.

Store layout: ``<path>/day=<day>/status=<ok|rejected>/run=<r>/batch_id=<n>/``, so a
reader of some days lists only those. A batch is one job that replaces its own folders
when it is run again, so a retried batch leaves no doubles. ``run`` numbers the streams
that wrote to the store: a stream with a new checkpoint gets a new number, as its
batches count from 0 again. Reading resolves several writes of one key to the last.

``compact_days`` resolves days once and retires the batches it has read; readers put
the compacted days and the batches since then together. The store notes below
``_compacted`` which folders hold its compacted days, so ``compacted_folders`` tells a
job all of them, whether it was given them or not.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from footfall.functions.timeparts import day_of
from footfall.operators.cells import EVENT_KEY, latest_writes
from footfall.schemas import COMPACTED, INGESTED
from footfall.sources.raw_log import parse_messages
from footfall.sources.tables import (
    drop_folders, folder_exists, overwrite_days, qualified, repartition_for_sink, stored_parquet, written,
)

WRITE_ORDER = ("run", "batch_id", "sent_at", "part", "pos")
_STORED_BY = ("day", "status", "run", "batch_id")
_DAY_KEY = ("day", *EVENT_KEY)
_RUN = T.StructType([INGESTED["run"]])
_FOLDER = T.StructType([T.StructField("folder", T.StringType())])


def write_batch(
    batch: DataFrame, batch_id: int, path: str, writers: int | None = None, run: int = 0
) -> None:
    """Store one batch of messages under its stream's and its own number.

    Rows are rebalanced by day and status, so a batch over many days writes few files
    and a day that most of it belongs to is split.
    """
    # Sources without offsets: the row's place in the batch stands in for one.
    placed = batch.withColumn("pos", F.coalesce(F.col("pos"), F.monotonically_increasing_id()))
    parsed = parse_messages(placed, "sent_at", "part", "pos")
    stored = parsed.withColumns(
        {"day": day_of(F.col("ts")), "run": F.lit(run).cast("bigint"), "batch_id": F.lit(batch_id).cast("bigint")}
    )
    stored = repartition_for_sink(stored, writers) if writers else stored.hint("rebalance", F.col("day"), F.col("status"))
    (
        stored.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_STORED_BY)
        .parquet(path)
    )


def run_of(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The number of the stream that ``checkpoint`` belongs to, kept in that folder.

    A checkpoint without one is a new stream's: its number is greater than all in the
    store, so its writes come after theirs.
    """
    mark = f"{checkpoint.rstrip('/')}/store-run"
    kept = stored_parquet(spark, mark, _RUN).first()
    if kept:
        return kept["run"]
    latest = read_ingested(spark, path).agg(F.max("run")).first()[0]
    run = max(int(time.time() * 1000), (latest or 0) + 1)
    spark.createDataFrame([(run,)], _RUN).coalesce(1).write.parquet(mark)
    return run


def ingest(
    stream: DataFrame, path: str, checkpoint: str, writers: int | None = None
) -> DataStreamWriter:
    """Writer that stores every batch of ``stream``."""
    run = run_of(stream.sparkSession, path, checkpoint)
    return (
        stream.writeStream.queryName("ingest")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, path, writers, run))
    )


def start_ingest(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    writers: int | None = None,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Start storing batches at the interval ``every``."""
    return ingest(stream, path, checkpoint, writers).trigger(processingTime=every).start()


def drain(writer: DataStreamWriter) -> None:
    """Handle what the source holds now, in as many batches as it takes, and end."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    """All stored messages that are not retired, accepted and rejected."""
    return stored_parquet(spark, path, INGESTED)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Texts of the messages that could not be read."""
    return read_ingested(spark, path).filter(F.col("status") == "rejected").select(
        "batch_id", "value"
    )


def between(first_day: str | None, last_day: str | None) -> Column:
    """Condition on ``day``: from the first to the last one, each open if not given."""
    wanted = F.lit(True)
    if first_day:
        wanted = wanted & (F.col("day") >= F.lit(first_day).cast("date"))
    if last_day:
        wanted = wanted & (F.col("day") <= F.lit(last_day).cast("date"))
    return wanted


def compacted_folders(spark: SparkSession, path: str, given: str | None = None) -> list[str]:
    """The folders that hold compacted days of a store: those it has noted, and a given one."""
    noted = {row["folder"] for row in stored_parquet(spark, f"{path}/_compacted", _FOLDER).distinct().collect()}
    gone = sorted(folder for folder in noted if not folder_exists(spark, folder))
    if gone:
        raise FileNotFoundError(f"compacted days of {path} are missing: {', '.join(gone)}")
    return sorted(noted | ({qualified(spark, given)} if given else set()))


def _note_compacted(spark: SparkSession, path: str, target: str) -> None:
    """Note in a store that ``target`` holds compacted days of it."""
    folder = qualified(spark, target)
    if folder not in compacted_folders(spark, path):
        spark.createDataFrame([(folder,)], _FOLDER).coalesce(1).write.mode("append").parquet(f"{path}/_compacted")


def _resolved(spark: SparkSession, path: str, compacted: str | Sequence[str] | None, days: Column) -> DataFrame:
    """Last write per time, user and article with its place in the order of writing."""
    columns = [*_DAY_KEY, *WRITE_ORDER, "behavior"]
    stored = read_ingested(spark, path).filter((F.col("status") == "ok") & days).select(*columns)
    for folder in [compacted] if isinstance(compacted, str) else compacted or ():
        stored = stored.unionByName(stored_parquet(spark, folder, COMPACTED).filter(days).select(*columns))
    return latest_writes(stored, WRITE_ORDER, _DAY_KEY)


def read_events(
    spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None,
    compacted: str | Sequence[str] | None = None, days: Column | None = None,
) -> DataFrame:
    """Last write per time, user and article, of all days, a span of them or a condition on ``day``.

    Without ``compacted`` (one folder or several) these are the batches not yet retired.
    """
    wanted = between(first_day, last_day) if days is None else days
    return _resolved(spark, path, compacted, wanted).select(*_DAY_KEY, "behavior")


def compact_days(
    spark: SparkSession, path: str, target: str,
    first_day: str | None = None, last_day: str | None = None, retire: bool = True,
) -> None:
    """Resolve the days that have new batches into ``target``, one folder per day.

    The batches read are retired only after ``target`` is written. If that fails half
    way, readers see both, which resolve to the same events.
    """
    span = between(first_day, last_day)
    fresh = read_ingested(spark, path).filter((F.col("status") == "ok") & span)
    # One row per stored batch and day, from the folder names alone.
    batches = fresh.select("day", "run", "batch_id").distinct().collect()
    days = F.col("day").isin({row["day"] for row in batches})
    resolved = written(_resolved(spark, path, target, days & span), "compact")
    overwrite_days(resolved, target)
    if batches:
        _note_compacted(spark, path, target)
    if retire:
        drop_folders(spark, [
            f"{path}/day={row['day']}/status=ok/run={row['run']}/batch_id={row['batch_id']}" for row in batches
        ])
