"""Hourly facts kept up to date by signed changes.

A batch is compared with the last writes stored under its own keys. A key that is new
counts one more; one that is written again with another behaviour counts one less for
what it had and one more for what it has now. The changes are summed by hour and
published in one commit with the batch itself, so facts and events never differ, and a
batch that is run again adds nothing. Work grows with the batch and the buckets its keys
lie in, not with the days it touches.

Events of articles that the dimension does not know are noted by day. Once it does, those
articles' stored events of these days count. An article's domain is taken to stay as it is.

Facts are read as sums of changes; ``compact`` folds them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from footfall.functions.timeparts import hour_of
from footfall.operators.cells import EVENT_KEY
from footfall.schemas import ARTICLE_HOUR, COUNT, DAY, TEXT, USER_HOUR
from footfall.streaming.versions import (
    BUCKETS, EVENTS_TABLE, STORED, WRITE_ORDER, Snapshot, Versions, latest,
)

# Sums of changes of all kinds in one table, so that a batch writes it once. A kind leaves
# the columns null that it has no use for. ``waiting`` counts the articles (1 or 0) that
# have stored events of a day and were not known.
CHANGES = T.StructType([
    T.StructField("kind", TEXT), *ARTICLE_HOUR[:-1], USER_HOUR["user_id"], T.StructField("num", COUNT),
    T.StructField("day", DAY),
])
KEYS = [name for name in CHANGES.names if name != "num"]
FACTS = {"article_hour": ARTICLE_HOUR, "user_hour": USER_HOUR}


def changes(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Cells that a batch takes away (``num`` -1) and puts in place (1), given stored writes.

    Both hold rows of the store. The stored side keeps its buckets; only the batch moves.
    """
    key = ["day", "slot", *EVENT_KEY]
    order = F.struct(*WRITE_ORDER)
    old = latest(stored).select(*key, order.alias("old_order"), F.col("behavior").alias("old"), F.lit(True).alias("known"))
    new = latest(batch).select(*key, order.alias("order"), "behavior")
    both = new.join(old, key, "left")
    first = F.col("known").isNull()
    other = (F.col("order") > F.col("old_order")) & ~F.col("behavior").eqNullSafe(F.col("old"))
    cell = [F.struct(F.col("behavior").alias("behavior"), F.lit(1).cast("long").alias("num"))]
    gone = [F.struct(F.col("old").alias("behavior"), F.lit(-1).cast("long").alias("num"))]
    both = both.where(first | other)
    signed = F.explode(F.when(first, F.array(*cell)).otherwise(F.array(*cell, *gone))).alias("cell")
    return both.select("day", *EVENT_KEY, signed).select("day", *EVENT_KEY, "cell.*")


def _kind(df: DataFrame, kind: str) -> DataFrame:
    """Rows of one kind with all columns of ``CHANGES``."""
    given = {"kind": F.lit(kind)} | {name: F.col(name) for name in df.columns}
    return df.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CHANGES))


def summed(changed: DataFrame, articles: DataFrame) -> DataFrame:
    """Changes of both hourly facts, those of known articles."""
    located = changed.join(articles.select("article_id", "domain"), "article_id")
    located = located.withColumn("hour", hour_of(F.col("ts"))).select("day", "hour", "article_id", "user_id", "domain", "behavior", "num")
    rows = _kind(located.drop("user_id"), "article_hour").unionByName(_kind(located.drop("article_id", "behavior"), "user_hour"))
    return rows.groupBy(*KEYS).agg(F.sum("num").alias("num")).where("num <> 0").select(*CHANGES.names)


class Followed:
    """A store with its hourly facts."""

    def __init__(self, spark: SparkSession, path: str, articles: Callable[[], DataFrame], buckets: int = BUCKETS):
        self.spark, self.articles = spark, articles
        self.versions = Versions(spark, path, buckets)
        # Batches have session tables of their own, dropped after each of them.
        self._work = Versions(spark, path, buckets)

    def apply(self, batch: DataFrame, batch_id: int, checkpoint: str) -> None:
        """Store one batch of messages of the stream of ``checkpoint`` with what it changes."""
        run, last = self._work.stream(checkpoint)
        if last >= batch_id:
            return  # a repeat of a published batch
        added, days, slots = self._work.stage(batch, batch_id, run)
        # What was written is the batch from here on: it lies in the store's buckets.
        mine = self._work.rows(Snapshot(0, frozenset(added), {}), EVENTS_TABLE, STORED)
        while True:
            now = self._work.snapshot()
            changed = self._changed(now, mine, days, slots)
            if self._work.publish(now, added + changed, stream=(checkpoint, run, batch_id)):
                self._work.forget()
                return

    def _changed(self, now: Snapshot, batch: DataFrame, days: list, slots: list[int]) -> list:
        """Write what a batch and newly known articles change, against one snapshot."""
        stored = self._work.events(now, days).where(F.col("slot").isin(slots))
        # Kept in memory only as what it is worked out from does not change.
        changed = changes(batch, stored).persist()
        waiting = self.waiting(now).persist()
        # Only the articles that this batch asks for.
        asked = changed.select("article_id").unionByName(waiting.select("article_id")).distinct()
        dimension = self.articles().select(F.col("article_id").cast("string").alias("article_id"), "domain")
        known = dimension.join(asked, "article_id", "left_semi").persist()
        due = waiting.join(known, "article_id", "left_semi")
        due_days = due.agg(F.collect_set("day")).first()[0]
        counted = changed
        if due_days:
            late = latest(self._work.events(now, due_days)).join(due, ["article_id", "day"], "left_semi")
            late = late.select("day", *EVENT_KEY, "behavior", F.lit(1).cast("long").alias("num"))
            counted = changed.unionByName(late)
        unknown = changed.select("article_id", "day").distinct().join(known, "article_id", "left_anti")
        fresh = unknown.join(waiting, ["article_id", "day"], "left_anti")
        notes = fresh.withColumn("num", F.lit(1)).unionByName(due.withColumn("num", F.lit(-1)))
        rows = summed(counted, known).unionByName(_kind(notes, "waiting"))
        written = self._work.write(rows, "changes", {str(day) for day in (*days, *due_days)})
        for frame in (changed, waiting, known):
            frame.unpersist()
        return [entry for entry in written if self._work.has(entry)]

    def waiting(self, now: Snapshot) -> DataFrame:
        """(article_id, day): articles with stored events that the dimension did not know."""
        notes = self.versions.rows(now, "changes", CHANGES).where("kind = 'waiting'")
        return notes.groupBy("article_id", "day").agg(F.sum("num").alias("num")).where("num > 0").drop("num")

    def writer(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        """Writer that stores every batch of a stream and what it changes."""
        def write(batch: DataFrame, batch_id: int) -> None:
            self.apply(batch, batch_id, checkpoint)

        return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)

    def fact(self, name: str, snapshot: Snapshot | None = None) -> DataFrame:
        """An hourly fact, as the sum of its changes, with its day."""
        rows = self.versions.rows(snapshot or self.versions.snapshot(), "changes", CHANGES).where(F.col("kind") == name)
        keys = [*FACTS[name].names[:-1], "day"]
        return rows.groupBy(*keys).agg(F.sum("num").alias("num")).where("num <> 0").select(*FACTS[name].names, "day")

    def events(self, snapshot: Snapshot | None = None) -> DataFrame:
        return latest(self.versions.events(snapshot)).select("day", *EVENT_KEY, "behavior")

    def compact(self) -> Snapshot:
        """Resolve events and fold changes of days that lie in several commits."""
        return self.versions.compact({"changes": (CHANGES, KEYS)})
