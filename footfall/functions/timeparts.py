"""Times, days and calendar weeks as column expressions.

All expressions on ``TIMESTAMP_NTZ`` avoid the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_WHOLE_TIME = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}(\.\d+)?$"


def parse_time(text: Column) -> Column:
    """Time of a text like ``2015-05-08 13:13:19.0``; null without a full date and time."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(_WHOLE_TIME), trimmed.try_cast("timestamp_ntz"))


def time_text(ts: Column) -> Column:
    """Text of a time with the shortest fraction of at least one digit."""
    text = ts.cast("string")
    return F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".0")))


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def hour_of(ts: Column) -> Column:
    """Start of the hour, as a zone-free time."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def hour_key(ts: Column, compact: bool = False) -> Column:
    """``yyyy-MM-dd HH``, or ``yyyyMMddHH`` when ``compact``."""
    text = F.substring(ts.cast("string"), 1, 13)
    return F.translate(text, "- ", "") if compact else text


def day_key(day: Column, compact: bool = False) -> Column:
    """``yyyy-MM-dd``, or ``yyyyMMdd`` when ``compact``."""
    text = F.to_date(day).cast("string")
    return F.translate(text, "-", "") if compact else text


def week_start(day: Column) -> Column:
    """The Monday on or before ``day``."""
    return F.to_date(F.trunc(day, "week"))


def calendar_week(day: Column) -> Column:
    """Week of the year: weeks start on Monday, week 1 holds 1 January.

    A week that reaches into the next year is that year's week 1, so the last
    days of December may be week 1. This is not the ISO week.
    """
    reaches_next_year = F.year(F.date_add(week_start(day), 6)) > F.year(day)
    days_before_year = F.weekday(F.trunc(day, "year"))
    number = ((F.dayofyear(day) + days_before_year + 6) / 7).cast("int")
    return F.when(reaches_next_year, F.lit(1)).otherwise(number)
