"""Weekly figures as sums that can be merged and corrected.

A week's state holds the number of its days with events, their total, the sum of their
squares and one bit for each of them (Monday lowest). All are exact numbers, so states
of several sources or years are added, and a day that is counted anew is taken away as it
was and put back as it is, without any rounding left behind. Squares are exact for daily
totals up to 10^15.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.timeparts import calendar_week, week_start

STATE = {"n_days": T.LongType(), "total": T.LongType(), "squares": T.DecimalType(38, 0), "days": T.LongType()}


def _parts(day: Column, num: Column) -> dict[str, Column]:
    """What one day's total adds to its week; no events add nothing."""
    num = F.coalesce(num, F.lit(0))
    exact = num.cast("decimal(19,0)")
    active = (num != 0).cast("long")
    bit = F.call_function("shiftleft", F.lit(1), F.weekday(day))
    return {"n_days": active, "total": num, "squares": exact * exact, "days": active * bit}


def merged(states: DataFrame, *keys: str) -> DataFrame:
    """States added up by key."""
    sums = (F.sum(name).cast(kind).alias(name) for name, kind in STATE.items())
    return states.groupBy(*keys).agg(*sums)


def week_states(daily: DataFrame, sign: int = 1) -> DataFrame:
    """(week_start, state) of daily totals (day, num), a row for each day at most."""
    parts = _parts(F.col("day"), F.col("num"))
    signed = ((F.lit(sign) * part).cast(STATE[name]).alias(name) for name, part in parts.items())
    return merged(daily.select(week_start(F.col("day")).alias("week_start"), *signed), "week_start")


def corrections(before: DataFrame, after: DataFrame) -> DataFrame:
    """What weeks' states change by when some days' totals were ``before`` and are ``after``."""
    both = week_states(after).unionByName(week_states(before, sign=-1))
    return merged(both, "week_start").where(" OR ".join(f"{name} <> 0" for name in STATE))


def stats(states: DataFrame, with_year: bool = False) -> DataFrame:
    """Active days, total, mean and population deviation, as ``reports.weekly_stats`` gives them.

    ``states`` has any number of rows for each ``week_start``.
    """
    keys = [calendar_week(F.col("week_start")).alias("week")] + (["week_start"] if with_year else [])
    names = ["week", "week_start"] if with_year else ["week"]
    sums = merged(states.select(*keys, *STATE), *names).where("n_days > 0")
    n, total = F.col("n_days"), F.col("total").cast("decimal(19,0)")
    spread = (n.cast("decimal(10,0)") * F.col("squares") - total * total).cast("double")
    return sums.select(
        *names, "n_days", "total",
        (F.col("total").cast("double") / n).alias("avg"),
        (F.sqrt(spread) / n).alias("stddev"),
    )
