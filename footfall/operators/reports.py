"""Weekly report: daily and weekly totals, mean and deviation, rankings.

Every function takes the hourly activity fact (hour, user_id, domain, num).
Weeks are calendar week numbers; weeks of different years share a number unless
``with_year`` adds the Monday of the week to the key.

Rankings use ``row_number``, which Spark cuts to the first n rows per group in
each task before the shuffle, for n up to
``spark.sql.optimizer.windowGroupLimitThreshold``. Ties go to the smaller
remaining columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.timeparts import calendar_week, day_of, week_start


def _week_keys(day: Column, with_year: bool) -> list[Column]:
    keys = [calendar_week(day).alias("week")]
    return keys + [week_start(day).alias("week_start")] if with_year else keys


def _week_names(with_year: bool) -> list[str]:
    return ["week", "week_start"] if with_year else ["week"]


def _first(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)


def daily_totals(user_hour: DataFrame) -> DataFrame:
    return user_hour.groupBy(day_of(F.col("hour")).alias("day")).agg(F.sum("num").alias("num"))


def active_days_per_week(user_hour: DataFrame, with_year: bool = False) -> DataFrame:
    """Number of distinct days with events, per week."""
    days = user_hour.select(day_of(F.col("hour")).alias("day")).distinct()
    return days.groupBy(*_week_keys(F.col("day"), with_year)).agg(
        F.count("*").alias("n_days")
    )


def weekly_totals(user_hour: DataFrame, with_year: bool = False) -> DataFrame:
    return totals_of_days(daily_totals(user_hour), with_year)


def totals_of_days(daily: DataFrame, with_year: bool = False) -> DataFrame:
    """Weekly totals from daily ones."""
    return daily.groupBy(*_week_keys(F.col("day"), with_year)).agg(F.sum("num").alias("total"))


def count_of_days(daily: DataFrame, with_year: bool = False) -> DataFrame:
    """Days with events per week, from daily totals."""
    return daily.groupBy(*_week_keys(F.col("day"), with_year)).agg(F.count("*").alias("n_days"))


def weekly_mean(totals: DataFrame, active_days: DataFrame) -> DataFrame:
    """Mean per active day from separately kept weekly totals and day counts."""
    keys = [name for name in ("week", "week_start") if name in totals.columns]
    return totals.join(active_days, keys).select(
        *keys, (F.col("total").cast("double") / F.col("n_days")).alias("avg")
    )


def weekly_stats(user_hour: DataFrame, with_year: bool = False) -> DataFrame:
    """Active days, total, mean and population deviation of the daily totals.

    Days without events do not count.
    """
    return (
        daily_totals(user_hour)
        .groupBy(*_week_keys(F.col("day"), with_year))
        .agg(
            F.count("*").alias("n_days"),
            F.sum("num").alias("total"),
            F.avg("num").alias("avg"),
            F.stddev_pop("num").alias("stddev"),
        )
    )


def daily_deviations(user_hour: DataFrame, with_year: bool = False) -> DataFrame:
    """Each day's total, its week's mean and the squared deviation from it.

    The weekly side has at most 53 rows per year, so it is broadcast.
    """
    names = _week_names(with_year)
    daily = daily_totals(user_hour)
    means = weekly_stats(user_hour, with_year).select(*names, "avg")
    return (
        daily.select("day", "num", *_week_keys(F.col("day"), with_year))
        .join(F.broadcast(means), names)
        .select(*names, "day", "num", "avg", F.pow(F.col("num") - F.col("avg"), 2).alias("sq_dev"))
    )


def _weekly_by(user_hour: DataFrame, column: str, with_year: bool) -> DataFrame:
    day = day_of(F.col("hour"))
    return user_hour.groupBy(*_week_keys(day, with_year), column).agg(F.sum("num").alias("num"))


def weekly_user_totals(user_hour: DataFrame, with_year: bool = False) -> DataFrame:
    return _weekly_by(user_hour, "user_id", with_year)


def weekly_domain_totals(user_hour: DataFrame, with_year: bool = False) -> DataFrame:
    return _weekly_by(user_hour, "domain", with_year)


def top_users_per_week(user_hour: DataFrame, n: int = 10, with_year: bool = False) -> DataFrame:
    return _first(
        weekly_user_totals(user_hour, with_year),
        _week_names(with_year),
        [F.desc("num"), F.asc("user_id")],
        n,
    )


def top_domains_per_week(user_hour: DataFrame, n: int = 10, with_year: bool = False) -> DataFrame:
    return _first(
        weekly_domain_totals(user_hour, with_year),
        _week_names(with_year),
        [F.desc("num"), F.asc("domain")],
        n,
    )


def as_lists(ranked: DataFrame, key: str) -> DataFrame:
    """Ranked rows as one list of (key, num) per week, in rank order.

    Takes the output of a top-n report, so a list has at most n entries.
    """
    names = [name for name in ("week", "week_start") if name in ranked.columns]
    entries = F.sort_array(F.collect_list(F.struct("rank", F.col(key).alias("key"), "num")))
    return ranked.groupBy(*names).agg(
        F.transform(entries, lambda e: F.struct(e["key"].alias("key"), e["num"].alias("num")))
        .alias("entries")
    )


def _extreme_record(user_hour: DataFrame, num_order: Column) -> DataFrame:
    records = user_hour.select(day_of(F.col("hour")).alias("day"), "hour", "user_id", "domain", "num")
    order = [num_order, F.asc("hour"), F.asc("user_id"), F.asc("domain")]
    return _first(records, ["day"], order, 1).drop("rank")


def least_active_per_day(user_hour: DataFrame) -> DataFrame:
    """The hourly record with the smallest count of each day."""
    return _extreme_record(user_hour, F.asc("num"))


def most_active_per_day(user_hour: DataFrame) -> DataFrame:
    """The hourly record with the greatest count of each day."""
    return _extreme_record(user_hour, F.desc("num"))


def _extreme_hour(user_hour: DataFrame, num_order: Column) -> DataFrame:
    hours = user_hour.groupBy("hour").agg(F.sum("num").alias("num"))
    daily = hours.select(day_of(F.col("hour")).alias("day"), "hour", "num")
    return _first(daily, ["day"], [num_order, F.asc("hour")], 1).drop("rank")


def least_active_hour(user_hour: DataFrame) -> DataFrame:
    """The quietest hour of each day, over all users."""
    return _extreme_hour(user_hour, F.asc("num"))


def most_active_hour(user_hour: DataFrame) -> DataFrame:
    """The busiest hour of each day, over all users."""
    return _extreme_hour(user_hour, F.desc("num"))
