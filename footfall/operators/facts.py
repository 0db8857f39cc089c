"""Hourly and daily facts.

Counts and sums combine on the map side before they are shuffled, so a key that
holds a large part of the rows costs one partial row per task and group.

The article dimension grows with the data, so it carries no broadcast hint:
Spark broadcasts it when its estimated or measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by shuffle, where
adaptive execution splits the partition of an article with very many events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.timeparts import day_of, hour_of


def unique_articles(articles: DataFrame) -> DataFrame:
    """One row per article id, for a dimension that may hold an id twice.

    The joins below repeat an event's count for every dimension row of its id.
    The row kept is the one with the smallest remaining values. Rebalancing
    afterwards lets a join on the id shuffle both its sides, which is what
    splitting the partition of a hot article takes.
    """
    others = [name for name in articles.columns if name != "article_id"]
    first = articles.groupBy("article_id").agg(F.min(F.struct(*others)).alias("row"))
    return first.select("article_id", "row.*").select(*articles.columns).hint("rebalance")


def _domains(articles: DataFrame) -> DataFrame:
    return articles.select("article_id", "domain")


def article_hour_counts(events: DataFrame, articles: DataFrame) -> DataFrame:
    """Events per hour, article and behaviour, with the article's domain.

    Counting comes first: the join then sees at most one row per hour and
    behaviour of an article. Events of unknown articles drop out.
    """
    counts = events.groupBy(
        hour_of(F.col("ts")).alias("hour"), "article_id", "behavior"
    ).agg(F.count("*").alias("num"))
    return counts.join(_domains(articles), "article_id").select(
        "hour", "article_id", "domain", "behavior", "num"
    )


def user_hour_counts(events: DataFrame, articles: DataFrame) -> DataFrame:
    """Events per hour, user and domain. Events of unknown articles drop out."""
    located = events.select(
        hour_of(F.col("ts")).alias("hour"), "user_id", "article_id"
    ).join(_domains(articles), "article_id")
    return located.groupBy("hour", "user_id", "domain").agg(F.count("*").alias("num"))


def article_day_rollup(article_hour: DataFrame) -> DataFrame:
    """Hourly article counts summed per day."""
    return article_hour.groupBy(
        day_of(F.col("hour")).alias("day"), "article_id", "domain", "behavior"
    ).agg(F.sum("num").alias("num"))


def domain_day_from_activity(user_hour: DataFrame) -> DataFrame:
    """Daily total per domain, from the hourly activity fact."""
    return user_hour.groupBy(day_of(F.col("hour")).alias("day"), "domain").agg(
        F.sum("num").alias("num")
    )


def domain_day_from_articles(article_day: DataFrame) -> DataFrame:
    """Daily total per domain, from the daily article fact."""
    return article_day.groupBy("day", "domain").agg(F.sum("num").alias("num"))


def reconcile(
    left: DataFrame, right: DataFrame, keys: list[str], metric: str = "num"
) -> DataFrame:
    """One metric from two stores side by side, per key, with an ``equal`` flag.

    A key absent from a store has a null there. Both stores are stacked and
    summed in one shuffle, so null keys meet and doubled rows show up as a
    difference.
    """
    kind = left.schema[metric].dataType
    absent = F.lit(None).cast(kind)
    value = F.col(metric).cast(kind)
    stacked = left.select(*keys, value.alias("left_num"), absent.alias("right_num")).unionByName(
        right.select(*keys, absent.alias("left_num"), value.alias("right_num"))
    )
    return (
        stacked.groupBy(*keys)
        .agg(F.sum("left_num").alias("left_num"), F.sum("right_num").alias("right_num"))
        .withColumn("equal", F.col("left_num").eqNullSafe(F.col("right_num")))
    )
