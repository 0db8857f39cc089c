from __future__ import annotations

from pyspark.sql import functions as F

from footfall.operators import facts, reports
from footfall.schemas import DOMAIN_DAY
from tests.conftest import at, day, rows


def test_hourly_counts_drop_unknown_articles(make_events, make_articles):
    events = make_events(
        ("2015-05-08 13:13:19", "U1", "D1", "1"),
        ("2015-05-08 13:59:59", "U1", "D1", "1"),
        ("2015-05-08 13:20:00", "U1", "D2", "1"),
        ("2015-05-08 14:00:00", "U2", "D1", "0"),
        ("2015-05-08 14:00:00", "U2", "D9", "0"),
    )
    articles = make_articles(D1="python", D2="python")
    assert rows(facts.article_hour_counts(events, articles)) == [
        (at("2015-05-08 13:00:00"), "D1", "python", "1", 2),
        (at("2015-05-08 13:00:00"), "D2", "python", "1", 1),
        (at("2015-05-08 14:00:00"), "D1", "python", "0", 1),
    ]
    assert rows(facts.user_hour_counts(events, articles)) == [
        (at("2015-05-08 13:00:00"), "U1", "python", 3),
        (at("2015-05-08 14:00:00"), "U2", "python", 1),
    ]


def test_unique_articles_keeps_one_row_per_id(spark):
    articles = spark.createDataFrame(
        [("D1", "java"), ("D1", "ajax"), ("D2", "java")], "article_id STRING, domain STRING"
    )
    assert rows(facts.unique_articles(articles)) == [("D1", "ajax"), ("D2", "java")]


def test_day_rollup_and_both_domain_totals_agree(make_events, make_articles):
    events = make_events(
        ("2015-05-08 13:13:19", "U1", "D1", "1"),
        ("2015-05-08 23:13:19", "U2", "D1", "1"),
        ("2015-05-09 00:00:00", "U1", "D1", "1"),
        ("2015-05-09 01:00:00", "U1", "D2", "7"),
    )
    articles = make_articles(D1="python", D2="java")
    article_day = facts.article_day_rollup(facts.article_hour_counts(events, articles))
    assert rows(article_day) == [
        (day("2015-05-08"), "D1", "python", "1", 2),
        (day("2015-05-09"), "D1", "python", "1", 1),
        (day("2015-05-09"), "D2", "java", "7", 1),
    ]
    activity = facts.domain_day_from_activity(facts.user_hour_counts(events, articles))
    both = facts.reconcile(
        activity, facts.domain_day_from_articles(article_day), ["day", "domain"]
    )
    assert both.count() == 3
    assert both.filter(~F.col("equal")).count() == 0


def test_reconcile_finds_missing_differing_and_doubled(spark):
    d = day("2015-05-08")
    left = spark.createDataFrame(
        [(d, "a", 1), (d, "b", 2), (d, None, 3), (d, "d", 4)], DOMAIN_DAY
    )
    right = spark.createDataFrame(
        [(d, "a", 1), (d, "b", 5), (d, None, 3), (d, "d", 4), (d, "d", 4), (d, "e", 1)],
        DOMAIN_DAY,
    )
    found = facts.reconcile(left, right, ["day", "domain"]).select(
        "domain", "left_num", "right_num", "equal"
    )
    assert rows(found) == [
        ("a", 1, 1, True), ("b", 2, 5, False), ("d", 4, 8, False),
        ("e", None, 1, False), (None, 3, 3, True),
    ]


def test_daily_totals_skip_days_without_events(make_user_hour):
    fact = make_user_hour(
        ("2015-05-08 13:00:00", "U1", "java", 2), ("2015-05-08 14:00:00", "U1", "java", 3),
        ("2015-05-10 00:00:00", "U1", "java", 1),
    )
    assert rows(reports.daily_totals(fact)) == [(day("2015-05-08"), 5), (day("2015-05-10"), 1)]
