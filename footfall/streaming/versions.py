"""A store whose content is what its commit log says.

Data lie below ``<path>/data/<table>/day=<day>/commit=<id>``, in files that are never
changed. ``<path>/log/<number>.json`` is one small commit: the folders it adds and those
it takes away, of one or several tables, so a reader sees all of a batch or nothing of
it. A commit is published by renaming a file to the next free number, which fails if
another one took it; the file system must do that in one step. Every ``WHOLE_EVERY``
commits the whole list is written beside the log, so a reader opens few files.

A reader keeps the folders that it was opened with. Compaction adds new folders and takes
the old ones from the log, but not from the disk: ``vacuum`` removes what no kept version
has. Events are stored in buckets of a hash of user and hour, sorted by key, with Bloom
filters on user and article; a hot user's day is spread over its hours. A snapshot of
them is a table of the session with just its folders as partitions, so that Spark reads
only the buckets that a key can lie in, and resolves last writes without a shuffle.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.timeparts import day_of, hour_of
from footfall.operators.cells import EVENT_KEY
from footfall.schemas import COUNT, DAY, TEXT, TIME
from footfall.sources.raw_log import parse_messages
from footfall.sources.tables import _folder, drop_folders, folder_exists, qualified

WHOLE_EVERY = 50
# Values of the bucketing column: the slots that a batch touches are a list of bounded length.
SLOTS = 256
BUCKETS = 16
# Rows that a bucket should hold: one task resolves or writes a bucket's rows of all days it is given.
BUCKET_ROWS = 500_000
EVENTS_TABLE = "events"
# Filters as large as a row group's values ask for: from 1 MiB down by halves, 12 times.
BLOOM = {
    "enabled#user_id": "true", "enabled#article_id": "true", "adaptive.enabled": "true", "candidates.number": "12",
}

# An event with the place of its write. ``slot`` decides its bucket.
STORED = T.StructType([
    T.StructField("slot", T.IntegerType()), T.StructField("ts", TIME), T.StructField("user_id", TEXT),
    T.StructField("article_id", TEXT), T.StructField("run", COUNT), T.StructField("batch_id", COUNT),
    T.StructField("sent_at", T.TimestampType()), T.StructField("part", T.IntegerType()),
    T.StructField("pos", COUNT), T.StructField("behavior", TEXT), T.StructField("day", DAY),
])
REJECTS = T.StructType([T.StructField("batch_id", COUNT), T.StructField("value", TEXT), T.StructField("day", DAY)])
# Rejected messages have no day of their own.
NO_DAY = "1970-01-01"
WRITE_ORDER = ("run", "batch_id", "sent_at", "part", "pos")


class Entry(NamedTuple):
    """One folder of the store."""

    table: str
    day: str
    commit: str


class Snapshot(NamedTuple):
    version: int
    entries: frozenset[Entry]
    runs: dict[str, list[int]]  # of each stream: its number and its last batch


class StoreChanged(RuntimeError):
    """Another commit took away what this one read."""


def slot_of(user_id: Column, ts: Column) -> Column:
    """The slot of a user's events of one hour."""
    return F.pmod(F.xxhash64(user_id.cast("string"), hour_of(ts)), F.lit(SLOTS)).cast("int")


def buckets_for(rows: int, least: int = 4) -> int:
    """Buckets for a store of about ``rows`` writes, so that no task's share grows with the store.

    More buckets than slots would stay empty. A store keeps the number it was made with.
    """
    return max(least, min(SLOTS, -(-rows // BUCKET_ROWS)))


def latest(stored: DataFrame) -> DataFrame:
    """Last write of each key. Keys lie within a slot, so a bucketed scan is not shuffled."""
    keys = ["day", "slot", *EVENT_KEY]
    last = stored.groupBy(*keys).agg(F.max(F.struct(*WRITE_ORDER, "behavior")).alias("last"))
    return last.select(*keys, "last.*")


class Versions:
    """The commit log of a store and the tables it names."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, qualified(spark, path).rstrip("/"), buckets
        self._tables: list[str] = []

    # --- the log ---------------------------------------------------------------

    def _read(self, name: str) -> dict:
        file, files = _folder(self.spark, f"{self.path}/log/{name}")
        stream = files.open(file)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, name: str, content: dict) -> bool:
        """Publish one file of the log; false if there is one of this name."""
        jvm = self.spark._jvm
        kinds = jvm.org.apache.hadoop.fs.Options.Rename
        temporary, files = _folder(self.spark, f"{self.path}/log/.{uuid.uuid4().hex}")
        stream = files.create(temporary)
        stream.write(bytearray(json.dumps(content), "utf-8"))
        stream.close()
        target, _ = _folder(self.spark, f"{self.path}/log/{name}")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration())
        never = self.spark.sparkContext._gateway.new_array(kinds, 1)
        never[0] = kinds.NONE
        try:
            context.rename(temporary, target, never)
        except Exception as error:
            files.delete(temporary, False)
            if files.exists(target):
                return False
            raise error
        return True

    def _names(self) -> tuple[list[int], list[int]]:
        """Numbers of the commits, and of those with a whole list."""
        folder, files = _folder(self.spark, f"{self.path}/log")
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        found = [re.fullmatch(r"(\d{20})(\.whole)?\.json", name) for name in names]
        commits = sorted(int(m[1]) for m in found if m and not m[2])
        return commits, sorted(int(m[1]) for m in found if m and m[2])

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The store as it is, or as it was at a version that has not been vacuumed."""
        commits, wholes = self._names()
        last = commits[-1] if commits else 0
        if version is not None and version > last:
            raise ValueError(f"no version {version} of {self.path}")
        version = last if version is None else version
        start = max((n for n in wholes if n <= version), default=0)
        known = self._read(f"{start:020d}.whole.json") if start else {"entries": [], "runs": {}}
        entries, runs = {Entry(*entry) for entry in known["entries"]}, known["runs"]
        wanted = range(start + 1, version + 1)
        if not set(wanted) <= set(commits):
            raise ValueError(f"version {version} of {self.path} is no longer kept")
        for number in wanted:
            commit = self._read(f"{number:020d}.json")
            entries |= {Entry(*entry) for entry in commit["added"]}
            entries -= {Entry(*entry) for entry in commit["removed"]}
            runs = runs | commit["runs"]
        return Snapshot(version, frozenset(entries), runs)

    def publish(
        self, read: Snapshot, added: Iterable[Entry] = (), removed: Iterable[Entry] = (),
        stream: tuple[str, int, int] | None = None,
    ) -> bool:
        """Publish the commit after the snapshot that it was worked out from; false if there is one.

        ``stream`` is (checkpoint, number, batch) of the stream whose batch it is.
        """
        added, removed = sorted(added), sorted(removed)
        runs = {qualified(self.spark, stream[0]).rstrip("/"): list(stream[1:])} if stream else {}
        version = read.version + 1
        if not self._put(f"{version:020d}.json", {"added": added, "removed": removed, "runs": runs}):
            return False
        if version % WHOLE_EVERY == 0:
            entries = sorted((read.entries | set(added)) - set(removed))
            self._put(f"{version:020d}.whole.json", {"entries": entries, "runs": read.runs | runs})
        return True

    def publish_later(self, added: Iterable[Entry], removed: Iterable[Entry]) -> Snapshot:
        """Publish after whatever came since, if that left what is taken away in place."""
        while True:
            now = self.snapshot()
            if not set(removed) <= now.entries:
                raise StoreChanged(f"what was read of {self.path} has been replaced")
            if self.publish(now, added, removed):
                return self.snapshot(now.version + 1)

    def stream(self, checkpoint: str) -> tuple[int, int]:
        """(number, last batch) of the stream of a checkpoint, from the log; a new one gets the next number."""
        key = qualified(self.spark, checkpoint).rstrip("/")
        while True:
            now = self.snapshot()
            if key in now.runs:
                return tuple(now.runs[key])
            run = max((number for number, _ in now.runs.values()), default=0) + 1
            if self.publish(now, stream=(checkpoint, run, -1)):
                return run, -1

    def vacuum(self, keep: int = 1) -> int:
        """Remove folders that none of the last ``keep`` versions has; returns their number."""
        commits, wholes = self._names()
        oldest = max(0, (commits[-1] if commits else 0) - keep + 1)
        kept = self.snapshot(oldest).entries
        start = max((n for n in wholes if n <= oldest), default=0)
        gone = [
            Entry(*entry) for number in commits if start < number <= oldest
            for entry in self._read(f"{number:020d}.json")["removed"]
        ]
        if not start:
            drop_folders(self.spark, [self.folder(entry) for entry in gone if entry not in kept])
            return len(gone)
        # Commits before a whole list are no longer needed once their folders are gone.
        early = [n for n in commits if n <= start]
        gone += [Entry(*entry) for n in early for entry in self._read(f"{n:020d}.json")["removed"]]
        drop_folders(self.spark, [self.folder(entry) for entry in gone if entry not in kept])
        drop_folders(self.spark, [f"{self.path}/log/{n:020d}.json" for n in early])
        drop_folders(self.spark, [f"{self.path}/log/{n:020d}.whole.json" for n in wholes if n < start])
        return len(gone)

    # --- tables ----------------------------------------------------------------

    def folder(self, entry: Entry) -> str:
        return f"{self.path}/data/{entry.table}/day={entry.day}/commit={entry.commit}"

    def has(self, entry: Entry) -> bool:
        return folder_exists(self.spark, self.folder(entry))

    def write(self, df: DataFrame, table: str, days: Iterable[str]) -> list[Entry]:
        """Write rows of the given days into folders of a new commit, not yet published."""
        days = sorted(days)
        if not days:
            return []
        commit = f"{int(time.time() * 1000)}-{uuid.uuid4().hex[:12]}"
        df = df.withColumn("commit", F.lit(commit))
        if table == EVENTS_TABLE:
            name = self._table()
            # Rows are dealt as the table's buckets are, so a bucket of a day is one file.
            dealt = df.repartition(self.buckets, "slot").select(*STORED.names, "commit")
            dealt.write.mode("append").insertInto(name)
            self._drop(name)
        else:
            rows = df.hint("rebalance", F.col("day"))
            rows.write.mode("append").partitionBy("day", "commit").parquet(f"{self.path}/data/{table}")
        return [Entry(table, day, commit) for day in days]

    def rows(self, snapshot: Snapshot, table: str, schema: T.StructType, days: Iterable[str] | None = None) -> DataFrame:
        """A table of a snapshot, of some days or all."""
        wanted = None if days is None else {str(day) for day in days}
        entries = [e for e in snapshot.entries if e.table == table and (wanted is None or e.day in wanted)]
        if not entries:
            return self.spark.createDataFrame([], schema)
        if table != EVENTS_TABLE:
            reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data/{table}")
            return reader.parquet(*sorted(self.folder(entry) for entry in entries)).select(*schema.names)
        name = self._table()
        self._tables.append(name)
        parts = " ".join(f"PARTITION (day='{e.day}', commit='{e.commit}')" for e in sorted(entries))
        self.spark.sql(f"ALTER TABLE {name} ADD {parts}")
        return self.spark.table(name).select(*schema.names)

    def _table(self) -> str:
        """A table of the session over the stored events, without partitions yet."""
        name = f"footfall_{uuid.uuid4().hex}"
        columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in STORED)
        options = ", ".join(f"`parquet.bloom.filter.{key}` '{value}'" for key, value in BLOOM.items())
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, commit string) USING parquet OPTIONS ({options}) "
            f"PARTITIONED BY (day, commit) CLUSTERED BY (slot) SORTED BY (slot, user_id, ts, article_id) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/data/{EVENTS_TABLE}'"
        )
        return name

    def _drop(self, name: str) -> None:
        """Drop a table of the session; files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def forget(self) -> None:
        """Drop the session's tables that stand behind the frames this object gave out."""
        for name in self._tables:
            self._drop(name)
        self._tables = []

    def stage(self, batch: DataFrame, batch_id: int, run: int) -> tuple[list[Entry], list[str], list[int]]:
        """Write a batch of messages, not yet published: its folders, days and slots."""
        placed = batch.withColumn("pos", F.coalesce(F.col("pos"), F.monotonically_increasing_id()))
        numbered = {"run": F.lit(run).cast("long"), "batch_id": F.lit(batch_id).cast("long")}
        # Read once, as a source is costly to read and its rows are to keep their places; on disk, as a batch may be large.
        parsed = parse_messages(placed, "sent_at", "part", "pos").withColumns(numbered).persist(StorageLevel.DISK_ONLY)
        ok, slot = F.col("status") == "ok", slot_of(F.col("user_id"), F.col("ts"))
        # Bounded: days of the batch, and as many slots as there are at most.
        days, slots, n_rejected = parsed.agg(
            F.collect_set(F.when(ok, day_of(F.col("ts")))), F.collect_set(F.when(ok, slot)), F.count_if(~ok)
        ).first()
        days = sorted(map(str, days))
        accepted = parsed.where(ok).withColumns({"slot": slot, "day": day_of(F.col("ts"))})
        rejected = parsed.where(~ok).select("batch_id", "value", F.lit(NO_DAY).cast("date").alias("day"))
        added = self.write(accepted.select(*STORED.names), EVENTS_TABLE, days)
        added += self.write(rejected, "rejects", [NO_DAY] if n_rejected else [])
        parsed.unpersist()
        return added, days, slots

    def store(self, batch: DataFrame, batch_id: int, checkpoint: str) -> None:
        """Store and publish one batch of messages; a published one that is run again adds nothing."""
        run, last = self.stream(checkpoint)
        if last >= batch_id:
            return
        added, _, _ = self.stage(batch, batch_id, run)
        while not self.publish(self.snapshot(), added, stream=(checkpoint, run, batch_id)):
            pass

    def rejects(self, snapshot: Snapshot | None = None) -> DataFrame:
        """Texts of the messages that could not be read."""
        return self.rows(snapshot or self.snapshot(), "rejects", REJECTS).select("batch_id", "value")

    def events(self, snapshot: Snapshot | None = None, days: Iterable[str] | None = None) -> DataFrame:
        """Stored writes of a snapshot, unresolved."""
        return self.rows(snapshot or self.snapshot(), EVENTS_TABLE, STORED, days)

    def lookup(self, user_id: str, ts: str, snapshot: Snapshot | None = None) -> DataFrame:
        """Last writes of one user at one moment: reads one bucket of one day."""
        at, user = F.lit(str(ts)).cast("timestamp_ntz"), F.lit(str(user_id))
        day = str(ts)[:10]
        # The slot as a number, as only a literal chooses buckets.
        slot = self.spark.range(1).select(slot_of(user, at).alias("slot")).first()["slot"]
        found = self.events(snapshot, [day]).where((F.col("slot") == slot) & (F.col("user_id") == user) & (F.col("ts") == at))
        return latest(found)

    def lookup_all(self, keys: DataFrame, snapshot: Snapshot | None = None) -> DataFrame:
        """Last writes of many keys (``user_id``, ``ts``): reads their days and their slots' buckets."""
        user = F.col("user_id").cast("string")
        keys = keys.select(user.alias("user_id"), "ts", slot_of(user, F.col("ts")).alias("slot")).distinct()
        # Bounded: the days asked for, and as many slots as there are at most.
        days, slots = keys.agg(F.collect_set(day_of(F.col("ts"))), F.collect_set("slot")).first()
        stored = self.events(snapshot, map(str, days)).where(F.col("slot").isin(slots))
        return latest(stored.join(keys, ["slot", "user_id", "ts"], "left_semi"))

    def of_article(self, article_id: str, days: Iterable[str], snapshot: Snapshot | None = None) -> DataFrame:
        """Last writes on one article in some days: Bloom filters pass over row groups without it."""
        return latest(self.events(snapshot, days).where(F.col("article_id") == F.lit(str(article_id))))

    def compact(self, tables: dict[str, tuple[T.StructType, list[str]]] | None = None) -> Snapshot:
        """Rewrite the days that lie in several commits: events resolved, other tables summed.

        ``tables`` names the others with their schema and the keys by which ``num`` is
        summed. Batches may be published meanwhile; readers keep what they have opened.
        """
        before = self.snapshot()
        added, removed = [], []
        for table in [EVENTS_TABLE, *(tables or {})]:
            commits: dict[str, list[Entry]] = {}
            for entry in before.entries:
                if entry.table == table:
                    commits.setdefault(entry.day, []).append(entry)
            days = [day for day, entries in commits.items() if len(entries) > 1]
            if not days:
                continue
            if table == EVENTS_TABLE:
                whole = latest(self.events(before, days))
            else:
                schema, keys = tables[table]
                summed = self.rows(before, table, schema, days).groupBy(*keys).agg(F.sum("num").alias("num"))
                whole = summed.where("num <> 0").select(*schema.names)
            added += self.write(whole, table, days)
            removed += [entry for day in days for entry in commits[day]]
        # A day whose sums are all zero has no folder, and needs none.
        added = [entry for entry in added if self.has(entry)]
        return self.publish_later(added, removed) if removed else before
