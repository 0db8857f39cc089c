from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from footfall.operators import moments, reports
from footfall.schemas import USER_HOUR
from footfall.streaming import deltas, versions, weekly
from tests.conftest import rows

MONDAY = dt.date(2014, 12, 22)


def daily_of(spark, totals):
    return spark.createDataFrame([(day, num) for day, num in totals.items()], "day date, num bigint")


def figures(df):
    """Rows with the mean and the deviation to twelve digits, what doubles hold."""
    return [(*row[:-2], *(float(f"{value:.12g}") for value in row[-2:])) for row in rows(df)]


def wanted(spark, totals, with_year=False):
    """By the batch report, from one hourly row a day."""
    hours = [(dt.datetime.combine(day, dt.time(5)), "U", "java", num) for day, num in totals.items() if num]
    return figures(reports.weekly_stats(spark.createDataFrame(hours, USER_HOUR), with_year))


@pytest.mark.parametrize("with_year", [False, True])
def test_corrected_states_equal_the_report_of_all_days(spark, with_year):
    pick = random.Random(3)
    days = [MONDAY + dt.timedelta(days=k) for k in (*range(30), *range(364, 380))]
    now = {day: pick.choice([0, 1, 7, 10**9 + pick.randrange(10**6)]) for day in days}
    state = moments.week_states(daily_of(spark, now))
    for _ in range(3):
        touched = pick.sample(days, 6)
        before = {day: now[day] for day in touched}
        now |= {day: pick.choice([0, 2, now[day] + 1, 10**12]) for day in touched}
        changed = moments.corrections(daily_of(spark, before), daily_of(spark, {day: now[day] for day in touched}))
        state = state.unionByName(changed)
    assert figures(moments.stats(state, with_year)) == wanted(spark, now, with_year)
    for start, n_days, total, squares, bits in moments.merged(state, "week_start").collect():
        week = [now.get(start + dt.timedelta(days=k), 0) for k in range(7)]
        assert (n_days, total, squares) == (sum(map(bool, week)), sum(week), sum(n * n for n in week))
        assert bits == sum(bool(n) << k for k, n in enumerate(week))


def test_equal_days_have_no_deviation_and_no_days_no_row(spark):
    totals = {MONDAY + dt.timedelta(days=k): 10**15 for k in range(7)}
    state = moments.week_states(daily_of(spark, totals))
    assert figures(moments.stats(state)) == [(52, 7, 7 * 10**15, 1e15, 0.0)]
    gone = moments.corrections(daily_of(spark, totals), daily_of(spark, dict.fromkeys(totals, 0)))
    assert moments.stats(state.unionByName(gone)).count() == 0
    assert moments.corrections(daily_of(spark, totals), daily_of(spark, totals)).count() == 0


@pytest.fixture
def source(spark, tmp_path):
    return versions.Versions(spark, str(tmp_path / "facts"), buckets=2)


@pytest.fixture
def kept(spark, tmp_path, source):
    return weekly.Weekly(spark, str(tmp_path / "weekly"), source)


def change(source, totals):
    """Publish a commit that changes the days' totals, in two rows each and rows of another kind."""
    spark = source.spark
    made = [
        (kind, dt.datetime.combine(day, dt.time(hour)), None, "java", None, "U1", num, day)
        for day, total in totals.items()
        for kind, hour, num in (("user_hour", 3, total - 1), ("user_hour", 4, 1), ("article_hour", 3, 99))
    ]
    entries = source.write(spark.createDataFrame(made, deltas.CHANGES), "changes", {str(day) for day in totals})
    assert source.publish(source.snapshot(), entries)


def test_refreshes_follow_changes_of_past_days(spark, source, kept):
    assert kept.refresh() == 0 and kept.weekly_stats().count() == 0
    now = {}
    batches = (
        {MONDAY: 5, MONDAY + dt.timedelta(days=3): 8, MONDAY + dt.timedelta(days=9): 2},
        {MONDAY: -5, MONDAY + dt.timedelta(days=9): 40},
        {MONDAY + dt.timedelta(days=1): 3, MONDAY + dt.timedelta(days=9): -42},
        {MONDAY + dt.timedelta(days=1): -1, MONDAY + dt.timedelta(days=10): 6},
    )
    for number, batch in enumerate(batches):
        change(source, batch)
        for day, num in batch.items():
            now[day] = now.get(day, 0) + num
        if number == 1:
            continue  # two commits at once next time
        assert kept.refresh() == source.snapshot().version == kept.seen()
        assert rows(kept.daily_totals()) == sorted((day, num) for day, num in now.items() if num)
        assert figures(kept.weekly_stats(with_year=True)) == wanted(spark, now, with_year=True)
    version = kept.state.snapshot().version
    assert kept.refresh() == source.snapshot().version and kept.state.snapshot().version == version


def test_a_compaction_changes_nothing_and_a_vacuum_is_got_over(spark, source, kept):
    day = MONDAY + dt.timedelta(days=2)
    change(source, {MONDAY: 5, day: 1})
    change(source, {MONDAY: 2})
    kept.refresh()
    source.compact({"changes": (deltas.CHANGES, deltas.KEYS)})
    files = len(kept.state.snapshot().entries)
    kept.refresh()
    assert len(kept.state.snapshot().entries) == files
    assert rows(kept.daily_totals()) == [(MONDAY, 7), (day, 1)]
    change(source, {MONDAY: 3, day: -1})
    source.compact({"changes": (deltas.CHANGES, deltas.KEYS)})
    source.vacuum()
    kept.refresh()
    assert rows(kept.daily_totals()) == [(MONDAY, 10)]
    assert figures(kept.weekly_stats()) == wanted(spark, {MONDAY: 10})


def test_a_version_that_is_gone_has_all_days_counted_anew(spark, source, kept, monkeypatch):
    change(source, {MONDAY: 5})
    kept.refresh()
    change(source, {MONDAY + dt.timedelta(days=8): 4})
    whole = source.snapshot

    def forgotten(version=None):
        if version is not None:
            raise ValueError("no longer kept")
        return whole()

    monkeypatch.setattr(source, "snapshot", forgotten)
    kept.refresh()
    assert figures(kept.weekly_stats()) == wanted(spark, {MONDAY: 5, MONDAY + dt.timedelta(days=8): 4})


def test_the_slower_of_two_refreshes_adds_nothing_twice(spark, tmp_path, source, kept, monkeypatch):
    change(source, {MONDAY: 5})
    other = weekly.Weekly(spark, str(tmp_path / "weekly"), source)
    work, met = kept._corrected, []

    def overtaken(state, now):
        added = work(state, now)
        if not met:
            met.append(other.refresh())
        return added

    monkeypatch.setattr(kept, "_corrected", overtaken)
    assert kept.refresh() == met[0]
    assert rows(kept.daily_totals()) == [(MONDAY, 5)] and len(kept.state.snapshot().entries) == 2


def test_folded_states_stay_the_same(spark, source, kept):
    for batch in ({MONDAY: 5}, {MONDAY: 6}, {MONDAY: -11, MONDAY + dt.timedelta(days=7): 1}):
        change(source, batch)
        kept.refresh()
    before = figures(kept.weekly_stats())
    kept.compact()
    assert figures(kept.weekly_stats()) == before == wanted(spark, {MONDAY + dt.timedelta(days=7): 1})
    assert len({(e.table, e.day) for e in kept.state.snapshot().entries}) == len(kept.state.snapshot().entries) == 2
    change(source, {MONDAY: 9})
    kept.refresh()
    assert kept.week_states().where(F.col("week_start") == F.lit(MONDAY)).select("n_days", "days").first() == (1, 1)
