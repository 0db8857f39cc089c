from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footfall.functions import text, timeparts
from tests.conftest import at, day, rows


def one(spark, column, **values):
    """Value of a column expression over one row."""
    df = spark.range(1).select(*(F.lit(v).alias(n) for n, v in values.items()))
    return df.select(column).first()[0]


def ntz(value):
    return F.lit(value).cast("timestamp_ntz")


def week_by_counting(d: dt.date) -> int:
    """Week number counted from the Monday of the week that holds 1 January."""
    monday = d - dt.timedelta(days=d.weekday())
    year = (monday + dt.timedelta(days=6)).year
    first = dt.date(year, 1, 1)
    return (monday - (first - dt.timedelta(days=first.weekday()))).days // 7 + 1


def test_calendar_week_every_day_of_thirty_years(spark):
    days = spark.range(0, 11_400).select(
        F.date_add(F.lit("1999-12-01").cast("date"), F.col("id").cast("int")).alias("d")
    )
    for d, week in days.select("d", timeparts.calendar_week(F.col("d"))).collect():
        assert week == week_by_counting(d), d


@pytest.mark.parametrize(
    "d, week", [("2018-12-31", 1), ("2019-01-01", 1), ("2016-01-01", 1), ("2015-05-08", 19)]
)
def test_calendar_week_cases(spark, d, week):
    assert one(spark, timeparts.calendar_week(F.to_date(F.lit(d)))) == week


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2015-05-08 13:13:19", "2015-05-08 13:13:19.0"),
        ("2015-05-08 13:13:19.05", "2015-05-08 13:13:19.05"),
        ("2015-05-08 13:13:19.500000", "2015-05-08 13:13:19.5"),
        ("2015-05-08 00:00:00", "2015-05-08 00:00:00.0"),
    ],
)
def test_time_text(spark, value, expected):
    assert one(spark, timeparts.time_text(ntz(value))) == expected
    assert one(spark, timeparts.parse_time(F.lit(expected))) == at(value)


def test_unreadable_time_is_null(spark):
    values = ["", "yesterday", "now", "2015-13-01 00:00:00.0", "12:00:00", "2015", "2015-05-08",
              "2015-05-08 13", "2015-05-08 13:13", None]
    df = spark.createDataFrame([(v,) for v in values], "value STRING")
    parsed = df.repartition(2).select(timeparts.parse_time(F.col("value")).alias("ts"))
    assert rows(parsed) == [(None,)] * len(values)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    # 02:30 on this day does not exist in New York.
    ts = ntz("2024-03-10 02:30:15.25")
    assert one(spark, timeparts.hour_of(ts)) == at("2024-03-10 02:00:00")
    assert one(spark, timeparts.hour_key(ts)) == "2024-03-10 02"
    assert one(spark, timeparts.hour_key(ts, compact=True)) == "2024031002"
    assert one(spark, timeparts.day_of(ts)) == day("2024-03-10")
    assert one(spark, timeparts.day_key(ts, compact=True)) == "20240310"


def test_row_key_round_trip(spark):
    key = "2015-05-08 13:13:19.0@U0155827"
    assert one(spark, text.row_key(ntz("2015-05-08 13:13:19"), F.lit("U0155827"))) == key
    ts, user = text.split_row_key(F.lit(key))
    assert one(spark, ts) == at("2015-05-08 13:13:19")
    assert one(spark, user) == "U0155827"


def test_message_keeps_places_of_missing_fields(spark):
    value = text.message(
        F.lit("U1"), F.lit(None).cast("string"), F.lit("D1"), ntz("2015-05-08 13:00:00")
    )
    assert one(spark, value) == "U1@@D1@2015-05-08 13:00:00.0"


@pytest.mark.parametrize(
    "code, label", [("0", "publish"), ("1", "browse"), ("2", "comment"), ("7", "comment")]
)
def test_behavior_label(spark, code, label):
    assert one(spark, text.behavior_label(F.lit(code))) == label


@pytest.mark.parametrize(
    "num, total, expected",
    [
        (1, 3, "33.33%"), (1, 8, "12.5%"), (1, 1, "100%"), (2, 3, "66.67%"), (1, 16, "6.25%"),
        (1, 800, "0.12%"), (3, 800, "0.38%"), (0, 5, "0%"), (1, 100_000, "0%"),
        (250, 2, "12,500%"), (1, 10, "10%"), (1, 1000, "0.1%"),
    ],
)
def test_format_percent(spark, num, total, expected):
    assert one(spark, text.format_percent(F.lit(num), F.lit(total))) == expected


@pytest.mark.parametrize("num, total", [(None, 5), (1, 0), (1, None)])
def test_format_percent_null(spark, num, total):
    column = text.format_percent(F.lit(num).cast("bigint"), F.lit(total).cast("bigint"))
    assert one(spark, column) is None


def test_line_shows_null(spark):
    assert one(spark, text.line(F.lit("a"), F.lit(None).cast("int"), F.lit(3))) == "a,null,3"


def test_as_number_refuses_other_text(spark, conf):
    conf("spark.sql.ansi.enabled", "true")
    assert one(spark, text.as_number(F.lit("12"))) == 12
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rows(spark.range(1).select(text.as_number(F.concat(F.lit("x"), F.col("id")))))
