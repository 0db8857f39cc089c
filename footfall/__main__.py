"""The jobs from a command line: ``spark-submit --py-files ... footfall/__main__.py <job>``.

Folders must be reachable by every executor. Connection details come only from
the caller.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import facts, search
from footfall.plans import jobs
from footfall.session import MIB, build_session, size_settings
from footfall.sources import messages, raw_log, tables
from footfall.streaming import deltas, ingest


def _articles(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.articles.startswith("jdbc:"):
        split = None
        if args.articles_split:
            column, low, high, parts = args.articles_split.split(",")
            split = (column, low, high, int(parts))
        found = tables.read_jdbc(spark, args.articles, args.articles_table, split=split)
    else:
        found = spark.read.parquet(args.articles)
    return facts.unique_articles(tables.as_articles(found))


def _key(text: str) -> tuple[str, str]:
    """(time, user) of a ``time@user`` key."""
    ts, _, user = text.partition("@")
    return ts, user


def replay(spark: SparkSession, args: argparse.Namespace) -> None:
    """Send a raw log to a topic, each user's lines in time order."""
    log = raw_log.log_events(raw_log.read_behavior_log(spark, args.log))
    messages.publish(raw_log.to_messages(log), args.topic, args.servers)


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Store the messages of topics until stopped."""
    more = {"maxOffsetsPerTrigger": str(args.max_offsets)} if args.max_offsets else {}
    options = messages.kafka_options(args.servers, args.topics, **more)
    stream = messages.read_stream(spark, "kafka", **options)
    ingest.start_ingest(stream, args.store, args.checkpoint, every=args.every).awaitTermination()


def follow(spark: SparkSession, args: argparse.Namespace) -> None:
    """Store the messages of topics with what they change in the hourly facts, until stopped."""
    more = {"maxOffsetsPerTrigger": str(args.max_offsets)} if args.max_offsets else {}
    stream = messages.read_stream(spark, "kafka", **messages.kafka_options(args.servers, args.topics, **more))
    kept = deltas.Followed(spark, args.store, lambda: _articles(spark, args))
    kept.writer(stream, args.checkpoint).trigger(processingTime=args.every).start().awaitTermination()


def fold(spark: SparkSession, args: argparse.Namespace) -> None:
    """Compact a followed store and remove what its last versions do not hold."""
    kept = deltas.Followed(spark, args.store, lambda: _articles(spark, args))
    print(f"version\t{kept.compact().version}")
    print(f"removed\t{kept.versions.vacuum(args.keep)}")


def hourly(spark: SparkSession, args: argparse.Namespace) -> None:
    """Hourly facts of the stored events: of whole days, or of exactly a key range.

    ``--start`` and ``--stop`` choose the days from the one's day to the other's; either
    alone leaves the other end open. With ``--exact`` they are the ends of a key range,
    both needed, whose facts go to ``--facts`` as a folder of their own.
    """
    articles = _articles(spark, args)
    if args.exact:
        if not (args.start and args.stop):
            raise SystemExit("--exact needs --start and --stop")
        start, stop = _key(args.start), _key(args.stop)
        jobs.hourly_range(spark, args.store, articles, args.facts, start, stop, args.compacted)
        return
    first, last = (_key(key)[0][:10] if key else None for key in (args.start, args.stop))
    jobs.hourly_days(
        spark, args.store, articles, args.facts, first, last, args.compacted, args.database
    )


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Resolve stored days into one folder each and retire the batches read."""
    ingest.compact_days(spark, args.store, args.compacted, args.first_day, args.last_day)


def daily(spark: SparkSession, args: argparse.Namespace) -> None:
    """Daily facts from the hourly ones, also as tables or in a database."""
    sink = None
    if args.jdbc:
        def sink(df: DataFrame, name: str) -> None:
            tables.append_jdbc(df, args.jdbc, name, connections=args.connections)
    jobs.daily_facts(spark, args.facts, args.first_day, args.last_day, args.database, sink)


def weekly(spark: SparkSession, args: argparse.Namespace) -> None:
    """The six weekly report files."""
    user_hour = jobs.fact(spark, "user_hour", args.facts, args.database)
    for name, path in jobs.weekly_report(user_hour, args.out, args.n, args.with_year).items():
        print(f"{name}\t{path}")


def compare(spark: SparkSession, args: argparse.Namespace) -> None:
    """Daily domain totals from two stores: seconds each takes, and differing keys.

    The activity comes from the catalog's ``--database`` or the folder ``--facts``, the
    articles from a database over ``--jdbc``, else from where the activity comes from.
    """
    stores = {
        "activity": (facts.domain_day_from_activity, "user_hour", None),
        "articles": (facts.domain_day_from_articles, "article_day", args.jdbc),
    }
    totals = {}
    for name, (total, fact, jdbc) in stores.items():
        totals[name] = total(jobs.fact(spark, fact, args.facts, args.database, jdbc))
        start = time.perf_counter()
        totals[name].write.format("noop").mode("overwrite").save()
        print(f"{name}\t{time.perf_counter() - start:.3f} s")
    both = facts.reconcile(totals["activity"], totals["articles"], ["day", "domain"])
    differing, keys = both.agg(F.count_if(~F.col("equal")), F.count("*")).first()
    print(f"differing\t{differing} of {keys}")


def find(spark: SparkSession, args: argparse.Namespace) -> None:
    """One page of a search, by behaviour or by article."""
    article_day = jobs.fact(spark, "article_day", args.facts, args.database, args.jdbc)
    found = search.search_facts(
        article_day, args.start, args.end, args.domain, args.behavior, args.article
    )
    order = ["day", "num", "article_id", "behavior"]
    shown = search.page(search.with_percent(found), order, args.page, args.size)
    search.result_rows(shown).show(args.size, truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="footfall")
    top.add_argument("--data-gib", type=float, default=0, help="size of the data read")
    top.add_argument("--cores", type=int, default=8, help="cores of all executors")
    commands = top.add_subparsers(required=True)

    def command(name, job, *needed, **optional):
        sub = commands.add_parser(name, help=job.__doc__.splitlines()[0])
        for option in needed:
            sub.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            kind = type(default) if default is not None else str
            flag = "--" + option.replace("_", "-")
            if kind is bool:
                sub.add_argument(flag, action="store_true")
            else:
                sub.add_argument(flag, type=kind, default=default)
        sub.set_defaults(job=job)

    command("replay", replay, "log", "topic", "servers")
    command("ingest", run_ingest, "servers", "topics", "store", "checkpoint",
            every="10 seconds", max_offsets=0)
    command("compact", compact, "store", "compacted", first_day=None, last_day=None)
    command("hourly", hourly, "store", "articles", "facts", compacted=None, database=None,
            articles_table="articles", articles_split=None, start=None, stop=None, exact=False)
    command("daily", daily, "facts", first_day=None, last_day=None, database=None,
            jdbc=None, connections=3)
    command("weekly", weekly, "out", facts=None, database=None, n=10, with_year=False)
    command("compare", compare, facts=None, database=None, jdbc=None)
    command("search", find, "start", "end", "domain", facts=None, database=None, jdbc=None,
            behavior=None, article=None, page=0, size=10)
    command("follow", follow, "servers", "topics", "store", "checkpoint", "articles",
            articles_table="articles", articles_split=None, every="10 seconds", max_offsets=0)
    command("fold", fold, "store", "articles", articles_table="articles", articles_split=None, keep=10)
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    sizes = size_settings(int(args.data_gib * 1024 * MIB), args.cores) if args.data_gib else {}
    spark = build_session(f"footfall {args.job.__name__}", **sizes)
    args.job(spark, args)


if __name__ == "__main__":
    main()
