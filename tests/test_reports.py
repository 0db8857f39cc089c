from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from footfall.operators import reports
from tests.conftest import at, day, rows


@pytest.fixture
def week(make_user_hour):
    """Five active days of week 19 and one of week 20."""
    return make_user_hour(
        ("2015-05-04 08:00:00", "U1", "java", 4),
        ("2015-05-05 08:00:00", "U1", "java", 2),
        ("2015-05-06 08:00:00", "U2", "python", 6),
        ("2015-05-07 08:00:00", "U2", "python", 2),
        ("2015-05-08 08:00:00", "U2", "python", 5),
        ("2015-05-08 09:00:00", "U1", "java", 1),
        ("2015-05-11 08:00:00", "U3", "java", 3),
    )


def test_mean_and_deviation_over_active_days(week):
    totals = [4, 2, 6, 2, 6]
    mean = sum(totals) / 5
    deviation = math.sqrt(sum((t - mean) ** 2 for t in totals) / 5)
    first, second = rows(reports.weekly_stats(week))
    assert first[:4] == (19, 5, 20, mean)
    assert first[4] == pytest.approx(deviation)
    assert second == (20, 1, 3, 3.0, 0.0)
    assert rows(reports.active_days_per_week(week)) == [(19, 5), (20, 1)]
    by_join = reports.weekly_mean(
        reports.weekly_totals(week), reports.active_days_per_week(week)
    )
    assert rows(by_join) == [(19, mean), (20, 3.0)]


def test_squared_deviations_add_up_to_the_deviation(week):
    parts = reports.daily_deviations(week).groupBy("week").agg(
        F.sqrt(F.avg("sq_dev")).alias("stddev")
    )
    stats = reports.weekly_stats(week).select("week", "stddev")
    for (w1, a), (w2, b) in zip(rows(parts), rows(stats), strict=True):
        assert w1 == w2 and a == pytest.approx(b)


def test_weeks_of_different_years_merge_unless_asked(make_user_hour):
    fact = make_user_hour(
        ("2018-12-31 08:00:00", "U1", "java", 1),
        ("2019-01-01 08:00:00", "U1", "java", 2),
        ("2018-01-01 08:00:00", "U1", "java", 4),
    )
    assert rows(reports.weekly_totals(fact)) == [(1, 7)]
    assert rows(reports.active_days_per_week(fact)) == [(1, 3)]
    assert rows(reports.weekly_totals(fact, with_year=True)) == [
        (1, day("2018-01-01"), 4), (1, day("2018-12-31"), 3),
    ]
    assert rows(reports.top_users_per_week(fact, with_year=True).drop("rank")) == [
        (1, day("2018-01-01"), "U1", 4), (1, day("2018-12-31"), "U1", 3),
    ]


def test_ties_at_rank_ten_go_to_the_smaller_id(make_user_hour):
    users = [f"U{i:02}" for i in range(20)]
    fact = make_user_hour(*(("2015-05-04 08:00:00", u, "java", 3) for u in users))
    top = reports.top_users_per_week(fact)
    assert [r.user_id for r in top.orderBy("rank").collect()] == users[:10]
    assert [r["rank"] for r in top.orderBy("rank").collect()] == list(range(1, 11))


def test_lists_keep_rank_order(week):
    lists = reports.as_lists(reports.top_domains_per_week(week, n=2), "domain")
    found = {r.week: [tuple(e) for e in r.entries] for r in lists.collect()}
    assert found == {19: [("python", 13), ("java", 7)], 20: [("java", 3)]}


def test_records_and_hours_of_least_and_most_activity(make_user_hour):
    fact = make_user_hour(
        ("2015-05-04 08:00:00", "U1", "java", 4),
        ("2015-05-04 09:00:00", "U1", "java", 1),
        ("2015-05-04 09:00:00", "U2", "java", 1),
        ("2015-05-04 09:00:00", "U3", "java", 3),
        ("2015-05-04 10:00:00", "U2", "java", 4),
    )
    d, h8, h9 = day("2015-05-04"), at("2015-05-04 08:00:00"), at("2015-05-04 09:00:00")
    assert rows(reports.least_active_per_day(fact)) == [(d, h9, "U1", "java", 1)]
    assert rows(reports.most_active_per_day(fact)) == [(d, h8, "U1", "java", 4)]
    assert rows(reports.least_active_hour(fact)) == [(d, h8, 4)]
    assert rows(reports.most_active_hour(fact)) == [(d, h9, 5)]


def test_ranks_are_unique_and_totals_agree(week):
    stats = {r.week: r for r in reports.weekly_stats(week).collect()}
    for r in stats.values():
        assert r.avg * r.n_days == pytest.approx(r.total)
    users = reports.weekly_user_totals(week).groupBy("week").agg(F.sum("num").alias("n"))
    assert {r.week: r.n for r in users.collect()} == {w: r.total for w, r in stats.items()}
