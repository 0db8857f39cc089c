"""The weekly report kept up to date while past days change.

``refresh`` takes what the commits of a store of hourly facts changed since the last one:
rows of new folders count, those of folders taken away count against them, so a compaction
changes nothing. Changed days' totals correct their weeks' states. Work grows with what
changed and the days it lies in, not with the store. Totals, states and the version they
stand for appear in one commit, so a refresh that is run again, or beside another, adds nothing.

If ``vacuum`` has removed folders that were counted, their days are counted anew from the
store's facts; a refresh that meets a vacuum under way fails and can be run again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.operators import moments
from footfall.schemas import COUNT, DAY
from footfall.sources.tables import drop_folders
from footfall.streaming.deltas import CHANGES
from footfall.streaming.versions import Entry, Snapshot, Versions

# Changes of daily totals; changes of states, whose day is the Monday.
DAYS = T.StructType([T.StructField("num", COUNT), T.StructField("day", DAY)])
WEEKS = T.StructType([T.StructField(name, kind) for name, kind in moments.STATE.items()] + [T.StructField("day", DAY)])
TABLES = {"days": DAYS, "weeks": WEEKS}


def _of(table: str, snapshot: Snapshot) -> set[Entry]:
    return {entry for entry in snapshot.entries if entry.table == table}


def _picked(entries: Iterable[Entry]) -> Snapshot:
    """Just these folders."""
    return Snapshot(0, frozenset(entries), {})


class Weekly:
    """Daily totals and weekly figures of the activity facts of a ``source`` store."""

    def __init__(self, spark: SparkSession, path: str, source: Versions):
        self.spark, self.source = spark, source
        self.state = Versions(spark, path)

    def seen(self, state: Snapshot | None = None) -> int:
        """The source's version that the figures stand for."""
        return (state or self.state.snapshot()).runs.get(self.source.path, [1, 0])[1]

    def refresh(self) -> int:
        """Bring the figures to the source's newest version; returns it."""
        while True:
            state, now = self.state.snapshot(), self.source.snapshot()
            if self.seen(state) >= now.version:
                return self.seen(state)
            added = self._corrected(state, now)
            if self.state.publish(state, added, stream=(self.source.path, 1, now.version)):
                return now.version
            drop_folders(self.spark, [self.state.folder(entry) for entry in added])

    def _counted(self, entries: Iterable[Entry], sign: int = 1) -> DataFrame:
        rows = self.source.rows(_picked(entries), "changes", CHANGES).where("kind = 'user_hour'")
        return rows.groupBy("day").agg((sign * F.sum("num")).alias("num"))

    def _corrected(self, state: Snapshot, now: Snapshot) -> list[Entry]:
        """Write what changed of days and weeks between the version seen and ``now``."""
        entries = _of("changes", now)
        try:
            counted = _of("changes", self.source.snapshot(self.seen(state)))
            fresh, gone = entries - counted, counted - entries
            anew = {entry.day for entry in gone if not self.source.has(entry)}
        except ValueError:  # a version that is no longer kept
            fresh, gone = entries, set()
            anew = {entry.day for entry in entries | _of("days", state)}
        signed = self._counted(entry for entry in fresh if entry.day not in anew)
        signed = signed.unionByName(self._counted((entry for entry in gone if entry.day not in anew), -1))
        if anew:
            signed = signed.unionByName(self._counted(entry for entry in entries if entry.day in anew))
            signed = signed.unionByName(self.daily_totals(state, anew).withColumn("num", -F.col("num")))
        changed = signed.groupBy("day").agg(F.sum("num").alias("num")).where("num <> 0")
        days = {entry.day for entry in fresh | gone} | anew
        added = self._write(changed.select(*DAYS.names), "days", days)
        if not added:
            return []
        # The written changes from here on, so that facts are read once.
        before = self.daily_totals(state, {entry.day for entry in added})
        written = self.state.rows(_picked(added), "days", DAYS)
        after = before.unionByName(written).groupBy("day").agg(F.sum("num").alias("num"))
        weeks = moments.corrections(before, after).withColumnRenamed("week_start", "day")
        dates = {dt.date.fromisoformat(entry.day) for entry in added}
        mondays = {str(day - dt.timedelta(days=day.weekday())) for day in dates}
        return added + self._write(weeks.select(*WEEKS.names), "weeks", mondays)

    def _write(self, df: DataFrame, table: str, days: Iterable[str]) -> list[Entry]:
        return [entry for entry in self.state.write(df, table, days) if self.state.has(entry)]

    def daily_totals(self, state: Snapshot | None = None, days: Iterable[str] | None = None) -> DataFrame:
        """(day, num) of the days with events, of some days or all."""
        rows = self.state.rows(state or self.state.snapshot(), "days", DAYS, days)
        return rows.groupBy("day").agg(F.sum("num").alias("num")).where("num <> 0")

    def week_states(self, state: Snapshot | None = None) -> DataFrame:
        """(week_start, state) of the weeks with events; ``days`` has a bit for each such day."""
        rows = self.state.rows(state or self.state.snapshot(), "weeks", WEEKS)
        return moments.merged(rows.withColumnRenamed("day", "week_start"), "week_start").where("n_days > 0")

    def weekly_stats(self, with_year: bool = False) -> DataFrame:
        """As ``reports.weekly_stats`` over the whole facts."""
        return moments.stats(self.week_states(), with_year)

    def compact(self) -> Snapshot:
        """Fold days and weeks that lie in several commits."""
        before = self.state.snapshot()
        added, removed = [], []
        for table, schema in TABLES.items():
            commits: dict[str, list[Entry]] = {}
            for entry in _of(table, before):
                commits.setdefault(entry.day, []).append(entry)
            days = [day for day, entries in commits.items() if len(entries) > 1]
            if not days:
                continue
            names = [field for field in schema if field.name != "day"]
            sums = (F.sum(field.name).cast(field.dataType).alias(field.name) for field in names)
            whole = self.state.rows(before, table, schema, days).groupBy("day").agg(*sums)
            whole = whole.where(" OR ".join(f"{field.name} <> 0" for field in names))
            added += self._write(whole.select(*schema.names), table, days)
            removed += [entry for day in days for entry in commits[day]]
        return self.state.publish_later(added, removed) if removed else before
