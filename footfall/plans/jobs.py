"""The engine's jobs, from stored events to report files.

Every job writes its facts by day and replaces whole days, so running it again gives
the same tables. A job that is given some days needs all events of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.timeparts import day_of
from footfall.operators import facts, reports
from footfall.operators.cells import key_range
from footfall.sources.tables import overwrite_days, read_jdbc, read_table, write_report, written
from footfall.streaming.ingest import between, compacted_folders, read_events


def _with_day(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn("day", day_of(F.col("hour")))


def hourly_facts(
    events: DataFrame, articles: DataFrame, root: str, covered: Column | None = None,
    database: str | None = None,
) -> None:
    """Write the hourly article fact and the hourly activity fact.

    Both read ``events``, so these should be stored, not a plan that would run twice.
    ``covered`` is a condition on ``day``: the days that ``events`` holds whole. With
    ``database`` the facts also become tables of the catalog, by day.
    """
    made = {
        "article_hour": _with_day(facts.article_hour_counts(events, articles)),
        "user_hour": _with_day(facts.user_hour_counts(events, articles)),
    }
    for name, fact in made.items():
        overwrite_days(fact, f"{root}/{name}", covered)
        if database:
            publish_table(fact.sparkSession, f"{root}/{name}", f"{database}.{name}", fact.schema)


def fact(
    spark: SparkSession, name: str, root: str | None = None, database: str | None = None,
    jdbc: str | None = None, split: tuple[str, int | str, int | str, int] | None = None,
) -> DataFrame:
    """A stored fact: from a database over JDBC, from the catalog, or from a folder, the first one given."""
    if jdbc:
        return read_jdbc(spark, jdbc, name, split=split)
    if database:
        return read_table(spark, f"{database}.{name}")
    if root:
        return spark.read.parquet(f"{root}/{name}")
    raise ValueError("a fact needs a folder, a database of the catalog or a JDBC address")


def publish_table(spark: SparkSession, path: str, name: str, schema: T.StructType) -> None:
    """Make a fact stored by day a table of the catalog, and let it see new days."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (day) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def hourly_days(
    spark: SparkSession, store: str, articles: DataFrame, root: str,
    first_day: str | None = None, last_day: str | None = None,
    compacted: str | None = None, database: str | None = None,
) -> None:
    """Hourly facts of whole days from the store: all of them, or from the first to the last.

    The events are resolved once, for both facts. Compacted days that the store has noted
    count without ``compacted``.
    """
    days = between(first_day, last_day)
    folders = compacted_folders(spark, store, compacted)
    events = written(read_events(spark, store, days=days, compacted=folders), "events")
    hourly_facts(events, articles, root, days, database)


def hourly_range(
    spark: SparkSession, store: str, articles: DataFrame, folder: str,
    start: tuple, stop: tuple, compacted: str | None = None,
) -> None:
    """Hourly facts of exactly a key range, in a folder of their own.

    A range may hold part of a day, so it must not replace days of the whole facts.
    """
    folders = compacted_folders(spark, store, compacted)
    events = read_events(spark, store, str(start[0])[:10], str(stop[0])[:10], folders)
    hourly_facts(written(key_range(events, start, stop), "events"), articles, folder, F.lit(True))


def daily_facts(
    spark: SparkSession, root: str, first_day: str | None = None, last_day: str | None = None,
    database: str | None = None, sink: Callable[[DataFrame, str], None] | None = None,
) -> None:
    """Write the daily article fact and both daily domain totals, of all days or a span.

    With ``database`` they also become tables of the catalog; ``sink`` gets each of
    them, read from what was written, with its name, such as to append it to a database.
    """
    days = between(first_day, last_day)

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{name}").filter(days)

    def keep(df: DataFrame, name: str) -> None:
        overwrite_days(df, f"{root}/{name}", days)
        if database:
            publish_table(spark, f"{root}/{name}", f"{database}.{name}", df.schema)
        if sink:
            sink(stored(name), name)

    keep(facts.article_day_rollup(stored("article_hour")), "article_day")
    keep(facts.domain_day_from_articles(stored("article_day")), "domain_day_articles")
    keep(facts.domain_day_from_activity(stored("user_hour")), "domain_day_activity")


def weekly_report(
    user_hour: DataFrame, folder: str, n: int = 10, with_year: bool = False, fmt: str = "json"
) -> dict[str, str]:
    """Write the six reports and return where each lies.

    The weekly figures are worked out once and kept in the folder; mean and deviation
    are read from there. Each other report is one job over the columns it needs.
    """
    figures = reports.weekly_stats(user_hour, with_year)
    path = write_report(figures, folder, "figures", "parquet")
    stats = user_hour.sparkSession.read.schema(figures.schema).parquet(path)
    keys = [name for name in ("week", "week_start") if name in stats.columns]
    outputs = {
        "least_active": reports.least_active_per_day(user_hour),
        "most_active": reports.most_active_per_day(user_hour),
        "average": stats.select(*keys, "avg"),
        "deviation": stats.select(*keys, "stddev"),
        "top_users": reports.as_lists(
            reports.top_users_per_week(user_hour, n, with_year), "user_id"
        ),
        "top_domains": reports.as_lists(
            reports.top_domains_per_week(user_hour, n, with_year), "domain"
        ),
    }
    return {name: write_report(df, folder, name, fmt) for name, df in outputs.items()}
