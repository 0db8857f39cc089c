"""Registered queries over the given tables, each beside its SQL twin.

Days and hours leave a query as text, as the stored facts show them. Every query
runs over whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import text, timeparts
from footfall.operators import cells, digests, facts, positions, reports, search, spans
from footfall.plans import jobs
from footfall.plans.tables import articles, events, table, visits
from footfall.session import work_dir
from footfall.sources import log_tail, messages, raw_log, replay
from footfall.sources.tables import append_table, read_table, register, written
from footfall.streaming import deltas, hourly, ingest, versions, weekly

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}

# Shared start of the SQL twins.
SQL_BASE = """
WITH b AS (
  SELECT event_id AS seq, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS article_id,
         CASE event_type WHEN 'purchase' THEN '0' WHEN 'view' THEN '1' ELSE '2' END AS behavior
  FROM events),
dim AS (SELECT doc_id AS article_id, source AS domain, lang FROM documents),
article_hour AS (
  SELECT strftime(ts, '%Y-%m-%d %H') AS hour, CAST(ts AS DATE) AS day,
         article_id, domain, behavior, count(*) AS num
  FROM b JOIN dim USING (article_id)
  GROUP BY ALL),
user_hour AS (
  SELECT strftime(ts, '%Y-%m-%d %H') AS hour, CAST(ts AS DATE) AS day,
         user_id, domain, count(*) AS num
  FROM b JOIN dim USING (article_id)
  GROUP BY ALL),
article_day AS (
  SELECT day, article_id, domain, behavior, CAST(sum(num) AS BIGINT) AS num
  FROM article_hour GROUP BY ALL),
daily AS (SELECT day, CAST(sum(num) AS BIGINT) AS num FROM user_hour GROUP BY day),
weekly_user AS (
  SELECT {week:day} AS week, user_id, CAST(sum(num) AS BIGINT) AS num
  FROM user_hour GROUP BY ALL),
weekly_domain AS (
  SELECT {week:day} AS week, domain, CAST(sum(num) AS BIGINT) AS num
  FROM user_hour GROUP BY ALL),
top_users AS (
  SELECT *, row_number() OVER (PARTITION BY week ORDER BY num DESC, user_id) AS rank
  FROM weekly_user QUALIFY rank <= 10),
top_domains AS (
  SELECT *, row_number() OVER (PARTITION BY week ORDER BY num DESC, domain) AS rank
  FROM weekly_domain QUALIFY rank <= 10),
least AS (
  SELECT * FROM user_hour
  QUALIFY row_number() OVER (PARTITION BY day ORDER BY num, hour, user_id, domain) = 1),
most AS (
  SELECT * FROM user_hour
  QUALIFY row_number() OVER (PARTITION BY day ORDER BY num DESC, hour, user_id, domain) = 1),
week_stats AS (
  SELECT {week:day} AS week, count(*) AS n_days, CAST(sum(num) AS BIGINT) AS total,
         avg(num) AS avg, stddev_pop(num) AS stddev
  FROM daily GROUP BY week),
found AS (
  SELECT * FROM article_day
  WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND domain = 'src3'),
day_latest AS (
  SELECT CAST(ts AS DATE) AS day, user_id, article_id, behavior FROM b
  QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id, article_id
                             ORDER BY seq DESC) = 1)
"""

SPAN = ("2024-01-05", "20240120", "src3")


def _week_sql(day: str) -> str:
    return (
        f"CASE WHEN year(CAST(date_trunc('week', {day}) AS DATE) + 6) > year({day}) THEN 1 "
        f"ELSE CAST(floor((dayofyear({day}) - 1 + "
        f"isodow(CAST(date_trunc('year', {day}) AS DATE)) - 1) / 7) + 1 AS INTEGER) END"
    )


def _percent_sql(num: str, total: str) -> str:
    share = f"CAST(CAST({num} AS FLOAT) / CAST({total} AS FLOAT) * CAST(100 AS FLOAT) AS DOUBLE)"
    digits = f"format('{{:,.2f}}', round_even({share}, 2))"
    return f"regexp_replace({digits}, '\\.?0{{1,2}}$', '') || '%'"


def _time_sql(ts: str) -> str:
    return (
        f"CASE WHEN contains(CAST({ts} AS VARCHAR), '.') THEN CAST({ts} AS VARCHAR) "
        f"ELSE CAST({ts} AS VARCHAR) || '.0' END"
    )


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL twin if it has one."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            base = SQL_BASE.replace("{week:day}", _week_sql("day"))
            TWINS[function.__name__] = base + sql
        return function

    return add


# --- shared inputs and outputs -------------------------------------------------


def _article_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.article_hour_counts(events(spark, sf_dir), articles(spark, sf_dir))


def _user_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.user_hour_counts(events(spark, sf_dir), articles(spark, sf_dir))


def _article_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.article_day_rollup(_article_hour(spark, sf_dir))


def _shown(df: DataFrame) -> DataFrame:
    """Days and hours as text."""
    shown: dict[str, Column] = {}
    if "hour" in df.columns:
        shown["hour"] = timeparts.hour_key(F.col("hour"))
    for name in {"day", "week_start"} & set(df.columns):
        shown[name] = timeparts.day_key(F.col(name))
    return df.withColumns(shown) if shown else df


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


# --- facts ---------------------------------------------------------------------


@query("SELECT hour, article_id, domain, behavior, num FROM article_hour")
def article_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_article_hour(spark, sf_dir))


@query("SELECT hour, user_id, domain, num FROM user_hour")
def user_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_user_hour(spark, sf_dir))


@query("""
SELECT strftime(ts, '%Y-%m-%d %H') AS hour, article_id, domain, behavior, count(*) AS num
FROM b JOIN (SELECT * FROM dim WHERE lang = 'en') USING (article_id) GROUP BY ALL""")
def article_hour_known_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = articles(spark, sf_dir).filter(F.col("lang") == "en")
    return _shown(facts.article_hour_counts(events(spark, sf_dir), known))


@query("""
SELECT strftime(ts, '%Y-%m-%d %H') AS hour, user_id, domain, count(*) AS num
FROM b JOIN (SELECT * FROM dim WHERE lang = 'en') USING (article_id) GROUP BY ALL""")
def user_hour_known_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = articles(spark, sf_dir).filter(F.col("lang") == "en")
    return _shown(facts.user_hour_counts(events(spark, sf_dir), known))


@query("""
SELECT strftime(ts, '%Y-%m-%d %H') AS hour, user_id, d.lang AS domain, count(*) AS num
FROM b JOIN (SELECT min(doc_id % 100) AS article_id, min(lang) AS lang
             FROM documents GROUP BY doc_id % 100) d USING (article_id)
GROUP BY ALL""")
def user_hour_unique_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that holds ids several times, made unique before the join."""
    repeated = articles(spark, sf_dir).select(
        (F.col("article_id") % 100).alias("article_id"), F.col("lang").alias("domain")
    )
    return _shown(facts.user_hour_counts(events(spark, sf_dir), facts.unique_articles(repeated)))


@query("SELECT CAST(day AS VARCHAR) AS day, article_id, domain, behavior, num FROM article_day")
def article_day_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_article_day(spark, sf_dir))


@query("""
SELECT CAST(day AS VARCHAR) AS day, domain, CAST(sum(num) AS BIGINT) AS num
FROM user_hour GROUP BY day, domain""")
def domain_day_from_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(facts.domain_day_from_activity(_user_hour(spark, sf_dir)))


@query("""
SELECT CAST(day AS VARCHAR) AS day, domain, CAST(sum(num) AS BIGINT) AS num
FROM article_day GROUP BY day, domain""")
def domain_day_from_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(facts.domain_day_from_articles(_article_day(spark, sf_dir)))


@query("""
SELECT CAST(day AS VARCHAR) AS day, domain, a.num AS left_num, c.num AS right_num,
       a.num IS NOT DISTINCT FROM c.num AS equal
FROM (SELECT day, domain, CAST(sum(num) AS BIGINT) AS num FROM user_hour GROUP BY ALL) a
FULL JOIN (SELECT day, domain, CAST(sum(num) AS BIGINT) AS num FROM article_day GROUP BY ALL) c
USING (day, domain)""")
def reconcile_domain_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(
        facts.reconcile(
            facts.domain_day_from_activity(_user_hour(spark, sf_dir)),
            facts.domain_day_from_articles(_article_day(spark, sf_dir)),
            ["day", "domain"],
        )
    )


@query("""
SELECT CAST(day AS VARCHAR) AS day, a.num AS left_num, c.num AS right_num,
       a.num IS NOT DISTINCT FROM c.num AS equal
FROM daily a
FULL JOIN (SELECT day, CAST(sum(num) AS BIGINT) AS num FROM article_day
           WHERE behavior <> '0' OR day > DATE '2024-01-15' GROUP BY day
           HAVING day <> DATE '2024-01-03') c
USING (day)""")
def reconcile_differing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores that differ: one lacks some behaviours of early days and one day."""
    day = F.col("day")
    partial = _article_day(spark, sf_dir).filter(
        ((F.col("behavior") != "0") | (day > F.lit("2024-01-15").cast("date")))
        & (day != F.lit("2024-01-03").cast("date"))
    )
    other = partial.groupBy("day").agg(F.sum("num").alias("num"))
    return _shown(facts.reconcile(reports.daily_totals(_user_hour(spark, sf_dir)), other, ["day"]))


@query("""
SELECT CAST(day AS VARCHAR) AS day, domain, num, 'articles' AS store
FROM (SELECT day, domain, CAST(sum(num) AS BIGINT) AS num FROM article_day GROUP BY ALL)
UNION ALL
SELECT CAST(day AS VARCHAR), domain, num, 'activity'
FROM (SELECT day, domain, CAST(sum(num) AS BIGINT) AS num FROM user_hour GROUP BY ALL)""")
def stored_domain_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly and daily jobs through stored tables."""
    root = work_dir(spark, "facts")
    jobs.hourly_facts(events(spark, sf_dir), articles(spark, sf_dir), root)
    jobs.daily_facts(spark, root)
    stores = [
        spark.read.parquet(f"{root}/domain_day_{name}").select(
            "day", "domain", "num", F.lit(name).alias("store")
        )
        for name in ("articles", "activity")
    ]
    return _shown(stores[0].unionByName(stores[1]))


@query("""
SELECT hour, user_id, domain, num FROM user_hour
UNION ALL SELECT hour, user_id, domain, num FROM user_hour""")
def appended_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The activity fact appended twice to a table of the catalog and read by name."""
    path = work_dir(spark, "act-num")
    name = f"act_num_{path[-32:]}"
    fact = _user_hour(spark, sf_dir).withColumn("day", F.to_date("hour"))
    append_table(fact, name, path=path)
    append_table(fact, name)
    return _shown(read_table(spark, name).drop("day"))


# --- stored behaviour ----------------------------------------------------------


def _at_midnight(df: DataFrame) -> DataFrame:
    """Times cut to the day, so that keys repeat."""
    return df.withColumn("ts", F.to_date("ts").cast("timestamp_ntz"))


def _day_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_midnight(events(spark, sf_dir))


@query("SELECT CAST(day AS VARCHAR) AS day, user_id, article_id, behavior FROM day_latest")
def latest_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = cells.latest_behavior(_day_events(spark, sf_dir))
    return _shown(latest.withColumnRenamed("ts", "day"))


@query("""
SELECT seq, CAST(ts AS VARCHAR) AS time, user_id FROM b
WHERE (ts > TIMESTAMP '2024-01-05 06:00:00'
       OR (ts = TIMESTAMP '2024-01-05 06:00:00' AND user_id >= 10))
  AND (ts < TIMESTAMP '2024-01-20 18:30:00'
       OR (ts = TIMESTAMP '2024-01-20 18:30:00' AND user_id < 20))""")
def key_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cells.key_range(
        visits(spark, sf_dir), ("2024-01-05 06:00:00", 10), ("2024-01-20 18:30:00", 20)
    )
    return found.select("seq", F.col("ts").cast("string").alias("time"), "user_id")


@query("""
SELECT seq, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id FROM b
WHERE (CAST(ts AS DATE) > DATE '2024-01-05' OR
       (CAST(ts AS DATE) = DATE '2024-01-05' AND user_id >= 7))
  AND (CAST(ts AS DATE) < DATE '2024-01-20' OR
       (CAST(ts AS DATE) = DATE '2024-01-20' AND user_id < 8))""")
def key_range_shared_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range whose end times many users share."""
    found = cells.key_range(
        _at_midnight(visits(spark, sf_dir)), ("2024-01-05 00:00:00", 7), ("2024-01-20 00:00:00", 8)
    )
    return found.select("seq", timeparts.day_key(F.col("ts")).alias("day"), "user_id")


@query("""
SELECT seq, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id FROM b
WHERE CAST(ts AS DATE) = DATE '2024-01-05' AND user_id = 7""")
def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal ends: exactly one key."""
    key = ("2024-01-05 00:00:00", 7)
    found = cells.key_range(_at_midnight(visits(spark, sf_dir)), key, key)
    return found.select("seq", timeparts.day_key(F.col("ts")).alias("day"), "user_id")


@query("""
SELECT CAST(day AS VARCHAR) || ' 00:00:00.0@' || user_id AS row_key, part, count(*) AS n_cells,
       string_agg(article_id || ':' || behavior, ';' ORDER BY article_id) AS cells
FROM (SELECT *, CAST(('0x' || substr(md5(CAST(article_id AS VARCHAR)), 1, 4)) AS INTEGER) % 16 AS part
      FROM day_latest)
GROUP BY day, user_id, part""")
def wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = cells.collapse_cells(cells.latest_behavior(_day_events(spark, sf_dir)))
    entries = F.array_sort(F.map_entries("cells"))
    shown = F.transform(entries, lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"]))
    return wide.select(
        text.row_key(F.col("ts"), F.col("user_id")).alias("row_key"),
        "part",
        F.size("cells").cast("bigint").alias("n_cells"),
        F.array_join(shown, ";").alias("cells"),
    )


@query("SELECT CAST(day AS VARCHAR) AS day, user_id, article_id, behavior FROM day_latest")
def cells_of_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows taken apart again."""
    latest = cells.latest_behavior(_day_events(spark, sf_dir))
    flat = cells.explode_cells(cells.collapse_cells(latest))
    return _shown(flat.withColumnRenamed("ts", "day"))


@query(f"SELECT seq, {_time_sql('ts')} || '@' || user_id AS row_key, "
       "CAST(ts AS VARCHAR) AS time, CAST(user_id AS VARCHAR) AS user_id FROM b")
def row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row keys built and split again."""
    keyed = visits(spark, sf_dir).select(
        "seq", text.row_key(F.col("ts"), F.col("user_id")).alias("row_key")
    )
    ts, user = text.split_row_key(F.col("row_key"))
    return keyed.select("*", ts.cast("string").alias("time"), user.alias("user_id"))


# --- messages and logs ---------------------------------------------------------

_MESSAGE_SQL = f"user_id || '@' || behavior || '@' || article_id || '@' || {_time_sql('ts')}"


@query(f"SELECT {_MESSAGE_SQL} AS msg FROM b")
def replay_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_log.to_messages(events(spark, sf_dir)).select(F.col("value").alias("msg"))


@query(f"""
SELECT {_MESSAGE_SQL} AS msg,
       row_number() OVER (ORDER BY ts, user_id, article_id, behavior) - 1 AS position FROM b""")
def replay_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with their place in the replay order."""
    value = text.message(F.col("user_id"), F.col("behavior"), F.col("article_id"), F.col("ts"))
    return search.with_positions(events(spark, sf_dir), raw_log.EVENT_ORDER).select(
        value.alias("msg"), "position"
    )


@query("""
SELECT CAST(ts AS VARCHAR) AS time, CAST(user_id AS VARCHAR) AS user_id,
       CAST(article_id AS VARCHAR) AS article_id, behavior, 'ok' AS status FROM b""")
def parsed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = raw_log.parse_messages(raw_log.to_messages(events(spark, sf_dir)))
    return parsed.select(
        F.col("ts").cast("string").alias("time"), "user_id", "article_id", "behavior", "status"
    )


@query("""
SELECT CAST(ts AS VARCHAR) AS time, CAST(user_id AS VARCHAR) AS user_id,
       CAST(article_id AS VARCHAR) AS article_id, behavior FROM b""")
def raw_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as a raw log and read back."""
    path = work_dir(spark, "raw-log")
    raw_log.log_lines(events(spark, sf_dir)).write.text(path)
    parsed = raw_log.log_events(raw_log.read_behavior_log(spark, path))
    return parsed.select(
        F.col("ts").cast("string").alias("time"), "user_id", "article_id", "behavior"
    )


# --- scalar functions ----------------------------------------------------------


@query("""
SELECT strftime(ts, '%Y-%m-%d %H') AS hour, strftime(ts, '%Y%m%d%H') AS hour_compact,
       strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y%m%d') AS day_compact,
       CAST(date_trunc('hour', ts) AS VARCHAR) AS hour_start, count(*) AS num
FROM b GROUP BY ALL""")
def hour_and_day_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    keys = [
        timeparts.hour_key(ts).alias("hour"),
        timeparts.hour_key(ts, compact=True).alias("hour_compact"),
        timeparts.day_key(ts).alias("day"),
        timeparts.day_key(ts, compact=True).alias("day_compact"),
        timeparts.hour_of(ts).cast("string").alias("hour_start"),
    ]
    return visits(spark, sf_dir).groupBy(*keys).agg(F.count("*").alias("num"))


@query(f"""
SELECT {_week_sql("CAST(o_orderdate AS DATE)")} AS week,
       CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS week_start,
       dayofmonth(CAST(o_orderdate AS DATE)) AS dom, count(*) AS num
FROM orders GROUP BY ALL""")
def calendar_week_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    keys = [
        timeparts.calendar_week(day).alias("week"),
        timeparts.week_start(day).alias("week_start"),
        F.dayofmonth(day).cast("bigint").alias("dom"),
    ]
    return _shown(
        table(spark, sf_dir, "orders").groupBy(*keys).agg(F.count("*").alias("num"))
    )


@query("""
SELECT behavior, CASE behavior WHEN '0' THEN 'publish' WHEN '1' THEN 'browse'
       ELSE 'comment' END AS label, count(*) AS num FROM b GROUP BY ALL""")
def behavior_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        visits(spark, sf_dir)
        .groupBy("behavior", text.behavior_label(F.col("behavior")).alias("label"))
        .agg(F.count("*").alias("num"))
    )


@query("""
SELECT user_id, CAST(sum(CAST(CAST(num AS VARCHAR) AS BIGINT)) AS BIGINT) AS num
FROM user_hour GROUP BY user_id""")
def numbers_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts kept as text, as stored facts may have them, and summed as numbers."""
    stored = _user_hour(spark, sf_dir).withColumn("num", F.col("num").cast("string"))
    return stored.groupBy("user_id").agg(F.sum(text.as_number(F.col("num"))).alias("num"))


# --- weekly report -------------------------------------------------------------


@query("SELECT CAST(day AS VARCHAR) AS day, num FROM daily")
def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(reports.daily_totals(_user_hour(spark, sf_dir)))


@query("SELECT week, n_days FROM week_stats")
def active_days_per_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.active_days_per_week(_user_hour(spark, sf_dir))


@query("""
SELECT week, n_days, total, round(avg, 6) AS avg, round(stddev, 6) AS stddev FROM week_stats""")
def weekly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.weekly_stats(_user_hour(spark, sf_dir)), "avg", "stddev")


@query(f"""
SELECT {_week_sql("day")} AS week, CAST(CAST(date_trunc('week', day) AS DATE) AS VARCHAR) AS week_start,
       count(*) AS n_days, CAST(sum(num) AS BIGINT) AS total,
       round(avg(num), 6) AS avg, round(stddev_pop(num), 6) AS stddev
FROM daily GROUP BY ALL""")
def weekly_stats_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = reports.weekly_stats(_user_hour(spark, sf_dir), with_year=True)
    return _shown(_rounded(stats, "avg", "stddev"))


@query(f"""
, orders_daily AS (
  SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS num FROM orders GROUP BY ALL)
SELECT {_week_sql("day")} AS week, count(*) AS n_days, CAST(sum(num) AS BIGINT) AS total,
       round(avg(num), 6) AS avg, round(stddev_pop(num), 6) AS stddev
FROM orders_daily GROUP BY ALL""")
def weekly_stats_many_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks of several years that share a number, over order counts."""
    counted = (
        table(spark, sf_dir, "orders")
        .groupBy(timeparts.hour_of(F.col("o_orderdate")).alias("hour"))
        .agg(F.count("*").alias("num"))
    )
    return _rounded(reports.weekly_stats(counted), "avg", "stddev")


@query("SELECT week, round(total / n_days, 6) AS avg FROM week_stats")
def weekly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly totals joined with weekly day counts, both from the kept daily totals."""
    daily = written(reports.daily_totals(_user_hour(spark, sf_dir)), "daily")
    mean = reports.weekly_mean(reports.totals_of_days(daily), reports.count_of_days(daily))
    return _rounded(mean, "avg")


@query(f"""
SELECT s.week, CAST(day AS VARCHAR) AS day, num, round(avg, 6) AS avg,
       round(pow(num - avg, 2), 6) AS sq_dev
FROM daily JOIN week_stats s ON {_week_sql("day")} = s.week""")
def daily_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_rounded(reports.daily_deviations(_user_hour(spark, sf_dir)), "avg", "sq_dev"))


@query("SELECT week, user_id, num FROM weekly_user")
def weekly_user_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.weekly_user_totals(_user_hour(spark, sf_dir))


@query("SELECT week, domain, num FROM weekly_domain")
def weekly_domain_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.weekly_domain_totals(_user_hour(spark, sf_dir))


@query("SELECT CAST(day AS VARCHAR) AS day, hour, user_id, domain, num FROM least")
def least_active_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(reports.least_active_per_day(_user_hour(spark, sf_dir)))


@query("SELECT CAST(day AS VARCHAR) AS day, hour, user_id, domain, num FROM most")
def most_active_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(reports.most_active_per_day(_user_hour(spark, sf_dir)))


_HOURS_SQL = """
SELECT CAST(day AS VARCHAR) AS day, hour, num
FROM (SELECT day, hour, CAST(sum(num) AS BIGINT) AS num FROM user_hour GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY day ORDER BY num {}, hour) = 1"""


@query(_HOURS_SQL.format("ASC"))
def least_active_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(reports.least_active_hour(_user_hour(spark, sf_dir)))


@query(_HOURS_SQL.format("DESC"))
def most_active_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(reports.most_active_hour(_user_hour(spark, sf_dir)))


@query("SELECT week, user_id, num, CAST(rank AS INTEGER) AS rank FROM top_users")
def top_users_per_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_users_per_week(_user_hour(spark, sf_dir))


@query("SELECT week, domain, num, CAST(rank AS INTEGER) AS rank FROM top_domains")
def top_domains_per_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_domains_per_week(_user_hour(spark, sf_dir))


def _list_text() -> Column:
    shown = F.transform(
        "entries", lambda e: F.concat_ws(":", e["key"].cast("string"), e["num"].cast("string"))
    )
    return F.array_join(shown, ";").alias("entries")


@query("""
SELECT week, string_agg(user_id || ':' || num, ';' ORDER BY rank) AS entries
FROM top_users GROUP BY week""")
def top_user_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = reports.top_users_per_week(_user_hour(spark, sf_dir))
    return reports.as_lists(ranked, "user_id").select("week", _list_text())


@query("""
SELECT week, string_agg(domain || ':' || num, ';' ORDER BY rank) AS entries
FROM top_domains GROUP BY week""")
def top_domain_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = reports.top_domains_per_week(_user_hour(spark, sf_dir))
    return reports.as_lists(ranked, "domain").select("week", _list_text())


@query("""
SELECT 'average' AS report, CAST(week AS VARCHAR) AS span, '' AS name, round(avg, 6) AS num
FROM week_stats
UNION ALL SELECT 'deviation', CAST(week AS VARCHAR), '', round(stddev, 6) FROM week_stats
UNION ALL SELECT 'least_active', CAST(day AS VARCHAR), CAST(user_id AS VARCHAR), num FROM least
UNION ALL SELECT 'most_active', CAST(day AS VARCHAR), CAST(user_id AS VARCHAR), num FROM most
UNION ALL SELECT 'top_users', CAST(week AS VARCHAR), CAST(user_id AS VARCHAR), num FROM top_users
UNION ALL SELECT 'top_domains', CAST(week AS VARCHAR), domain, num FROM top_domains""")
def weekly_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six report files, written and read back as one list."""
    root = work_dir(spark, "report")
    _user_hour(spark, sf_dir).write.parquet(f"{root}/user_hour")
    paths = jobs.weekly_report(spark.read.parquet(f"{root}/user_hour"), root)
    number = F.col("num").cast("double").alias("num")
    columns = {
        "average": ("week INT, avg DOUBLE", "week", F.lit(""), F.round("avg", 6).alias("num")),
        "deviation": ("week INT, stddev DOUBLE", "week", F.lit(""), F.round("stddev", 6).alias("num")),
        "least_active": ("day STRING, user_id STRING, num BIGINT", "day", F.col("user_id"), number),
        "most_active": ("day STRING, user_id STRING, num BIGINT", "day", F.col("user_id"), number),
        "top_users": (None, "week", F.col("key"), number),
        "top_domains": (None, "week", F.col("key"), number),
    }
    lists = "week INT, entries ARRAY<STRUCT<key: STRING, num: BIGINT>>"
    merged = None
    for report, (schema, span, name, num) in columns.items():
        rows = spark.read.schema(schema or lists).json(paths[report])
        if schema is None:
            rows = rows.select("week", F.inline("entries"))
        part = rows.select(
            F.lit(report).alias("report"), F.col(span).cast("string").alias("span"),
            name.alias("name"), num,
        )
        merged = part if merged is None else merged.unionByName(part)
    return merged


# --- search --------------------------------------------------------------------

_TOTAL = "(SELECT sum(num) FROM found_rows)"


def _result_sql(where: str) -> str:
    return f"""
, found_rows AS (SELECT * FROM found WHERE {where})
SELECT CAST(day AS VARCHAR) AS day, article_id, domain, behavior, num,
       CAST(100 AS DOUBLE) * CAST(num AS DOUBLE) / CAST({_TOTAL} AS DOUBLE) AS percent,
       {_percent_sql("num", _TOTAL)} AS percent_text
FROM found_rows"""


@query(_result_sql("behavior = '2'"))
def search_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(search.table_view(_article_day(spark, sf_dir), *SPAN, behavior="2"))


@query(_result_sql("article_id = 43"))
def search_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(search.chart_view(_article_day(spark, sf_dir), *SPAN, article_id=43))


@query("SELECT CAST(day AS VARCHAR) AS day, article_id, domain, behavior, num FROM found")
def search_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No optional filter."""
    return _shown(search.search_facts(_article_day(spark, sf_dir), *SPAN))


@query("""
SELECT CAST(day AS VARCHAR) AS day, article_id, domain, behavior, num FROM found
WHERE behavior = '2' AND article_id = 43""")
def search_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both optional filters."""
    found = search.search_facts(_article_day(spark, sf_dir), *SPAN, behavior="2", article_id=43)
    return _shown(found)


@query("SELECT CAST(sum(num) AS BIGINT) AS total FROM found WHERE num > 1")
def grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total of a result whose counts of 1 are null."""
    found = search.search_facts(_article_day(spark, sf_dir), *SPAN)
    return search.grand_total(found.withColumn("num", F.when(F.col("num") > 1, F.col("num"))))


@query(f"""
, t AS (SELECT domain, CAST(sum(num) AS BIGINT) AS num FROM article_day GROUP BY domain)
SELECT domain, num,
       CAST(100 AS DOUBLE) * CAST(num AS DOUBLE)
         / CAST((SELECT sum(num) FROM t) AS DOUBLE) AS percent,
       {_percent_sql("num", "(SELECT sum(num) FROM t)")} AS percent_text FROM t""")
def percent_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _article_day(spark, sf_dir).groupBy("domain").agg(F.sum("num").alias("num"))
    return search.with_percent(totals)


_LINE_SQL = f"""
, found_rows AS (SELECT * FROM found WHERE article_id = 43)
SELECT strftime(day, '%Y%m%d') || ',' || {{}} AS line FROM found_rows"""


@query(_LINE_SQL.format(
    "domain || ',' || article_id || ',' || behavior || ',' || num || ',' || "
    + _percent_sql("num", _TOTAL)
))
def table_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.chart_view(_article_day(spark, sf_dir), *SPAN, article_id=43)
    return search.table_lines(search.result_rows(found))


@query(_LINE_SQL.format("behavior || ',' || num"))
def chart_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.chart_view(_article_day(spark, sf_dir), *SPAN, article_id=43)
    return search.chart_lines(search.result_rows(found))


@query("SELECT DISTINCT CAST(day AS VARCHAR) AS day FROM found WHERE article_id = 43")
def active_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search_facts(_article_day(spark, sf_dir), *SPAN, article_id=43)
    return _shown(search.active_days(found))


def _timeline_sql(where: str) -> str:
    return f"""
SELECT CAST(day AS VARCHAR) AS day,
       CAST(coalesce(sum(num) FILTER (behavior = '0'), 0) AS BIGINT) AS publish,
       CAST(coalesce(sum(num) FILTER (behavior = '1'), 0) AS BIGINT) AS browse,
       CAST(coalesce(sum(num) FILTER (behavior NOT IN ('0', '1')), 0) AS BIGINT) AS comment,
       CAST(sum(num) AS BIGINT) AS stacked
FROM found WHERE {where} GROUP BY day"""


@query(_timeline_sql("true"))
def behavior_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(search.behavior_timeline(_article_day(spark, sf_dir), *SPAN))


@query(_timeline_sql("article_id = 43"))
def behavior_timeline_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(search.behavior_timeline(_article_day(spark, sf_dir), *SPAN, article_id=43))


@query("""
SELECT CAST(day AS VARCHAR) AS day, article_id, domain, behavior, num FROM found
ORDER BY day, num, article_id, behavior LIMIT 10 OFFSET 20""")
def result_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search_facts(_article_day(spark, sf_dir), *SPAN)
    return _shown(search.page(found, ["day", "num", "article_id", "behavior"], number=2))


@query("""
SELECT CAST(day AS VARCHAR) AS day, article_id, domain, behavior, num FROM article_day
ORDER BY num DESC, article_id, article_day.day DESC, behavior LIMIT 25 OFFSET 25""")
def result_page_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page sorted by several columns in both directions."""
    order = [F.desc("num"), F.asc("article_id"), F.desc("day"), F.asc("behavior")]
    return _shown(search.page(_article_day(spark, sf_dir), order, number=1, size=25))


@query("""
SELECT CAST(day AS VARCHAR) AS day, article_id, behavior, num,
       row_number() OVER (ORDER BY article_day.day, num, article_id, behavior) - 1 AS position
FROM article_day""")
def result_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every row in result order, as deep pages use it."""
    rows = _article_day(spark, sf_dir).select("day", "article_id", "behavior", "num")
    return _shown(search.with_positions(rows, ["day", "num", "article_id", "behavior"]))


@query("""
SELECT domain, behavior, CAST(sum(num) AS BIGINT) AS num
FROM article_hour GROUP BY domain, behavior""")
def temp_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact registered by name and queried with SQL."""
    register(_article_hour(spark, sf_dir), "article_hour_fact")
    return spark.sql(
        "SELECT domain, behavior, sum(num) AS num FROM article_hour_fact GROUP BY domain, behavior"
    )


@query("""
SELECT CAST(day AS VARCHAR) AS day, article_id, behavior, num FROM article_day
WHERE day > DATE '2024-01-10' OR (day = DATE '2024-01-10' AND (num > 1 OR (num = 1 AND
  (article_id > 43 OR (article_id = 43 AND behavior > '1')))))
ORDER BY article_day.day, num, article_id, behavior LIMIT 25""")
def result_page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page that follows a given row."""
    rows = _article_day(spark, sf_dir).select("day", "num", "article_id", "behavior")
    last = {"day": dt.date(2024, 1, 10), "num": 1, "article_id": 43, "behavior": "1"}
    return _shown(search.page_after(rows, list(last), last, size=25))


@query("""
, numbered AS (
  SELECT *, row_number() OVER (ORDER BY article_day.day, num, article_id, behavior) - 1 AS position, count(*) OVER () AS n
  FROM article_day)
SELECT page, CAST(day AS VARCHAR) AS day, article_id, domain, behavior, num, position
FROM (SELECT *, position // 25 AS page FROM numbered) AS paged
WHERE page IN (0, n // 50, (n - 1) // 25)""")
def stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first, a middle and the last page of a whole result that is stored by position."""
    path, rows = work_dir(spark, "positions"), _article_day(spark, sf_dir)
    order = ["day", "num", "article_id", "behavior"]
    schema = positions.store_positions(rows, order, path, range_rows=1000)
    n = spark.read.schema(schema).parquet(path).count()
    pages = {0, n // 50, max(n - 1, 0) // 25}
    found = None
    for number in sorted(pages):
        page = positions.stored_page(spark, path, schema, number, 25, range_rows=1000)
        page = page.withColumn("page", F.lit(number).cast("bigint"))
        found = page if found is None else found.unionByName(page)
    return _shown(found)


@query("""
, asked AS (
  SELECT DISTINCT 'behavior' AS kind, day, domain, behavior, NULL AS article_id, 6 AS back FROM article_day
  UNION ALL SELECT DISTINCT 'domain', day, domain, NULL, NULL, 13 FROM article_day
  UNION ALL SELECT DISTINCT 'article', day, domain, NULL, article_id, CAST(article_id % 9 AS INTEGER) FROM article_day
  UNION ALL SELECT 'both', day, domain, behavior, article_id, CAST(article_id % 5 AS INTEGER) FROM article_day)
SELECT kind, CAST(a.day - back AS VARCHAR) AS first, CAST(a.day AS VARCHAR) AS last, a.domain, a.behavior, a.article_id,
       CAST(coalesce(sum(num), 0) AS BIGINT) AS total
FROM asked a LEFT JOIN article_day d ON d.domain = a.domain AND d.day BETWEEN a.day - back AND a.day
     AND (a.behavior IS NULL OR d.behavior = a.behavior) AND (a.article_id IS NULL OR d.article_id = a.article_id)
GROUP BY kind, a.day, back, a.domain, a.behavior, a.article_id""")
def totals_of_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of very many spans at once, by domain and with either optional filter or both."""
    rows = written(_article_day(spark, sf_dir), "article-day")
    asked = {
        "behavior": (rows.select("day", "domain", "behavior").distinct(), F.lit(6)),
        "domain": (rows.select("day", "domain").distinct(), F.lit(13)),
        "article": (rows.select("day", "domain", "article_id").distinct(), F.col("article_id") % 9),
        "both": (rows.select("day", "domain", "behavior", "article_id"), F.col("article_id") % 5),
    }
    wanted = None
    for kind, (keys, back) in asked.items():
        part = keys.withColumn("first", F.date_sub("day", back.cast("int"))).withColumnRenamed("day", "last")
        part = part.withColumn("kind", F.lit(kind))
        wanted = part if wanted is None else wanted.unionByName(part, allowMissingColumns=True)
    found = spans.span_totals(spans.running_sums(rows), wanted)
    return found.withColumns({name: timeparts.day_key(F.col(name)) for name in ("first", "last")})


_TWO_STORES_SQL = """
, l AS (SELECT day, user_id, domain, CAST(sum(num) AS BIGINT) AS num FROM user_hour GROUP BY ALL),
r AS (
  SELECT day, user_id, CASE WHEN user_id % 89 = 3 THEN domain || 'x' ELSE domain END AS domain,
         CASE WHEN user_id % 97 = 5 AND day = DATE '2024-01-09' THEN num + 1 ELSE num END AS num
  FROM l WHERE NOT (user_id % 61 = 7 AND day = DATE '2024-01-21'))
SELECT CAST(coalesce(l.day, r.day) AS VARCHAR) AS day, coalesce(l.user_id, r.user_id) AS user_id,
       coalesce(l.domain, r.domain) AS domain, l.num AS left_num, r.num AS right_num, false AS equal
FROM l FULL JOIN r ON l.day = r.day AND l.user_id = r.user_id AND l.domain = r.domain
WHERE l.num IS DISTINCT FROM r.num"""


def _two_stores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One fact twice, the second time with other counts, other domains and rows that are gone."""
    hours = _user_hour(spark, sf_dir).withColumn("day", timeparts.day_of(F.col("hour")))
    left = written(hours.groupBy("day", "user_id", "domain").agg(F.sum("num").alias("num")), "left")
    user, day = F.col("user_id"), F.col("day")
    changed = (user % 97 == 5) & (day == F.lit("2024-01-09").cast("date"))
    gone = (user % 61 == 7) & (day == F.lit("2024-01-21").cast("date"))
    right = left.where(~gone).withColumns({
        "domain": F.when(user % 89 == 3, F.concat("domain", F.lit("x"))).otherwise(F.col("domain")),
        "num": F.when(changed, F.col("num") + 1).otherwise(F.col("num")),
    })
    return left, right


@query(_TWO_STORES_SQL)
def differing_by_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stores compared by the digests of their parts; only parts that differ are read."""
    root, keys = work_dir(spark, "digests"), ["day", "user_id", "domain"]
    sides = [digests.store(df, f"{root}/{k}", keys, buckets=8) for k, df in enumerate(_two_stores(spark, sf_dir))]
    return _shown(digests.differences(spark, *sides))


@query(_TWO_STORES_SQL)
def compared_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table compared with a folder that holds the same fact with differences."""
    root = work_dir(spark, "compared")
    database = f"compared_{root[-32:]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    left, right = _two_stores(spark, sf_dir)
    append_table(left, f"{database}.user_day")
    right.write.parquet(f"{root}/user_day")
    sides = (jobs.fact(spark, "user_day", database=database), jobs.fact(spark, "user_day", root))
    return _shown(facts.reconcile(*sides, ["day", "user_id", "domain"]).where("NOT equal"))


# --- streams -------------------------------------------------------------------


def _message_stream(spark: SparkSession, sent: DataFrame, root: str) -> DataFrame:
    """Messages published to files, which stand in for a topic, and read as a stream."""
    messages.publish(sent, fmt="text", path=f"{root}/topic")
    return messages.read_stream(spark, "text", path=f"{root}/topic")


def _unordered(sent: DataFrame) -> DataFrame:
    """Messages of a source that tells nothing of their order."""
    kinds = {"sent_at": "timestamp", "part": "int", "pos": "bigint"}
    return sent.withColumns({name: F.lit(None).cast(kind) for name, kind in kinds.items()})


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(ts AS VARCHAR) AS time,
       CAST(user_id AS VARCHAR) AS user_id, CAST(article_id AS VARCHAR) AS article_id, behavior
FROM b""")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages ingested as a stream and read back as events."""
    root = work_dir(spark, "ingest")
    stream = _message_stream(spark, raw_log.to_messages(events(spark, sf_dir)), root)
    ingest.drain(ingest.ingest(stream, f"{root}/store", f"{root}/checkpoint"))
    stored = ingest.read_events(spark, f"{root}/store")
    return _shown(
        stored.select(
            "day", F.col("ts").cast("string").alias("time"), "user_id", "article_id", "behavior"
        )
    )


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(ts AS VARCHAR) AS time,
       CAST(user_id AS VARCHAR) AS user_id, CAST(article_id AS VARCHAR) AS article_id,
       CASE event_type WHEN 'click' THEN '9' ELSE behavior END AS behavior
FROM b""")
def compacted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second changing some behaviours, compacted by day."""
    root = work_dir(spark, "compact")
    kind = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "event_type")
    changed = events(spark, sf_dir).join(kind.filter("event_type = 'click'"), "seq")
    for number, batch in enumerate(
        [events(spark, sf_dir), changed.withColumn("behavior", F.lit("9"))]
    ):
        ingest.write_batch(_unordered(raw_log.to_messages(batch)), number, f"{root}/store")
    ingest.compact_days(spark, f"{root}/store", f"{root}/events")
    stored = spark.read.parquet(f"{root}/events")
    return _shown(
        stored.select(
            "day", F.col("ts").cast("string").alias("time"), "user_id", "article_id", "behavior"
        )
    )


@query("""
SELECT 'rejected' AS status, user_id || '@' || behavior || '@' || article_id AS value, count(*) AS num
FROM b WHERE event_type = 'signup' GROUP BY ALL
UNION ALL
SELECT 'ok', NULL, count(*) FROM b WHERE event_type <> 'signup'""")
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some lack their time: those are kept as rejects."""
    kind = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "event_type")
    whole = text.message(F.col("user_id"), F.col("behavior"), F.col("article_id"), F.col("ts"))
    short = F.substring_index(whole, text.FIELD_MARK, 3)
    sent = events(spark, sf_dir).join(kind, "seq").select(
        F.when(F.col("event_type") == "signup", short).otherwise(whole).alias("value")
    )
    root = work_dir(spark, "rejects")
    stream = _message_stream(spark, sent, root)
    ingest.drain(ingest.ingest(stream, f"{root}/store", f"{root}/checkpoint", writers=5))
    stored = ingest.read_ingested(spark, f"{root}/store")
    return stored.groupBy("status", "value").agg(F.count("*").alias("num"))


_EVENTS_SQL = """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(ts AS VARCHAR) AS time,
       CAST(user_id AS VARCHAR) AS user_id, CAST(article_id AS VARCHAR) AS article_id, {behavior} AS behavior
FROM b"""


def _shown_events(stored: DataFrame) -> DataFrame:
    return _shown(
        stored.select(
            "day", F.col("ts").cast("string").alias("time"), "user_id", "article_id", "behavior"
        )
    )


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two thirds of the events; then the rest, late, with some of the first again."""
    sent, seq = events(spark, sf_dir), F.col("seq")
    return sent.filter(seq % 3 != 1), sent.filter((seq % 3 == 1) | (seq % 5 == 0))


def _followed(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Facts kept by a stream that gets late and repeated messages and a growing dimension.

    The first part of the events arrives while half of the articles are known, the second
    one while all are. The store is compacted and its batches retired after each part.
    """
    root = work_dir(spark, name)
    every = articles(spark, sf_dir)
    known = [every.filter(F.col("article_id") % 2 == 0)]
    for batch in _parts(spark, sf_dir):
        stream = _message_stream(spark, raw_log.to_messages(batch), root)
        writer = hourly.keep_facts(
            stream, f"{root}/store", f"{root}/facts", f"{root}/checkpoint", lambda: known[-1]
        )
        ingest.drain(writer)
        ingest.compact_days(spark, f"{root}/store", f"{root}/compacted")
        known.append(every)
    return f"{root}/facts"


def _changed_facts(spark: SparkSession, sf_dir: str, name: str) -> deltas.Followed:
    """The same stream with its facts kept by signed changes."""
    root = work_dir(spark, name)
    every = articles(spark, sf_dir)
    known = [every.filter(F.col("article_id") % 2 == 0)]
    buckets = versions.buckets_for(events(spark, sf_dir).count())
    kept = deltas.Followed(spark, f"{root}/store", lambda: known[-1], buckets)
    for batch in _parts(spark, sf_dir):
        stream = _message_stream(spark, raw_log.to_messages(batch), root)
        ingest.drain(kept.writer(stream, f"{root}/checkpoint"))
        known.append(every)
    return kept


@query("SELECT hour, article_id, domain, behavior, num FROM article_hour")
def stream_article_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _changed_facts(spark, sf_dir, "article-hours").fact("article_hour").drop("day")
    return _shown(kept.withColumn("article_id", text.as_number(F.col("article_id"))))


@query("SELECT hour, user_id, domain, num FROM user_hour")
def stream_user_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _changed_facts(spark, sf_dir, "user-hours").fact("user_hour").drop("day")
    return _shown(kept.withColumn("user_id", text.as_number(F.col("user_id"))))


@query(f"""
SELECT (row_number() OVER (ORDER BY ts, user_id, article_id, behavior, seq) - 1) // 3000 AS slice,
       concat_ws('@', user_id, behavior, article_id, {_time_sql('ts')}) AS value
FROM b""")
def replayed_in_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log sent in order of time, slice by slice, stopped after two and gone on with."""
    root = work_dir(spark, "slices")
    slices = replay.store_slices(events(spark, sf_dir), f"{root}/slices", 3000)

    def publish(sent: DataFrame, number: int) -> None:
        messages.publish(sent, fmt="text", path=f"{root}/topic", by=["slice"])

    replay.send_slices(spark, slices, publish, most=2, together=300_000)
    replay.send_slices(spark, slices, publish, together=300_000)
    return spark.read.schema("value string, slice bigint").text(f"{root}/topic").select("slice", "value")


BATCHES = 12


def _sent_in_batches(sent: DataFrame, n: int) -> DataFrame:
    """Events with the number of the batch that brings them.

    Of ``n`` events in order of time most come at their time, every seventh three batches
    late, and every fifth is written again two batches after that with another behaviour.
    """
    seq = F.col("seq")
    home = F.floor(seq * BATCHES / n)
    first = F.least(F.when(seq % 7 == 0, home + 3).otherwise(home), F.lit(BATCHES - 1))
    again = sent.filter(seq % 5 == 0).withColumn("behavior", F.lit("9"))
    return sent.withColumn("batch", first).unionByName(again.withColumn("batch", first + 2))


@query("""
, final AS (SELECT * REPLACE (CASE WHEN seq % 5 = 0 THEN '9' ELSE behavior END AS behavior) FROM b JOIN dim USING (article_id))
SELECT 'article' AS fact, strftime(ts, '%Y-%m-%d %H') AS hour, article_id, NULL AS user_id, domain, behavior, count(*) AS num
FROM final GROUP BY ALL
UNION ALL
SELECT 'user', strftime(ts, '%Y-%m-%d %H'), NULL, user_id, domain, NULL, count(*) FROM final GROUP BY ALL""")
def facts_by_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many batches with repeated and late events and late articles, compacted half way; both facts."""
    root = work_dir(spark, "changes")
    sent, every = events(spark, sf_dir), articles(spark, sf_dir)
    n = sent.count()
    batches = written(_sent_in_batches(sent, n), "batches")
    known = [every.filter(F.col("article_id") % 3 != 0)]
    kept = deltas.Followed(spark, f"{root}/store", lambda: known[-1], versions.buckets_for(n))
    for number in range(BATCHES + 2):
        batch = batches.filter(F.col("batch") == number)
        kept.apply(_unordered(raw_log.to_messages(batch)), number, f"{root}/checkpoint")
        if number == BATCHES // 2:
            kept.compact()
            known.append(every)
    article = kept.fact("article_hour").select(
        F.lit("article").alias("fact"), "hour", text.as_number(F.col("article_id")).alias("article_id"),
        F.lit(None).cast("bigint").alias("user_id"), "domain", "behavior", "num",
    )
    user = kept.fact("user_hour").select(
        F.lit("user").alias("fact"), "hour", F.lit(None).cast("bigint").alias("article_id"),
        text.as_number(F.col("user_id")).alias("user_id"), "domain", F.lit(None).cast("string").alias("behavior"), "num",
    )
    return _shown(article.unionByName(user))


@query(f"""
SELECT {_week_sql("day")} AS week, CAST(CAST(date_trunc('week', day) AS DATE) AS VARCHAR) AS week_start,
       count(*) AS n_days, CAST(sum(num) AS BIGINT) AS total,
       round(avg(num), 6) AS avg, round(stddev_pop(num), 6) AS stddev,
       CAST(sum(1 << (isodow(day) - 1)) AS BIGINT) AS days
FROM daily GROUP BY ALL""")
def weekly_stats_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly figures corrected three times: by late events, a compaction, and articles known late."""
    root = work_dir(spark, "weekly")
    every = articles(spark, sf_dir)
    known = [every.filter(F.col("article_id") % 2 == 0)]
    buckets = versions.buckets_for(events(spark, sf_dir).count())
    kept = deltas.Followed(spark, f"{root}/store", lambda: known[-1], buckets)
    figures = weekly.Weekly(spark, f"{root}/weekly", kept.versions)
    for number, batch in enumerate(_parts(spark, sf_dir)):
        kept.apply(_unordered(raw_log.to_messages(batch)), number, f"{root}/checkpoint")
        figures.refresh()
    kept.compact()
    figures.refresh()
    known.append(every)
    again = events(spark, sf_dir).filter(F.col("seq") % 7 == 0)
    kept.apply(_unordered(raw_log.to_messages(again)), 2, f"{root}/checkpoint")
    figures.refresh()
    figures.compact()
    stats = _rounded(figures.weekly_stats(with_year=True), "avg", "stddev")
    return _shown(stats.join(figures.week_states().select("week_start", "days"), "week_start"))


@query(_EVENTS_SQL.replace("{behavior}", "CASE WHEN seq % 4 = 0 THEN '9' ELSE behavior END"))
def log_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw log followed as it grows, in three batches of one stream; the last writes some keys again."""
    root = work_dir(spark, "log")
    sent, seq = events(spark, sf_dir), F.col("seq")
    changed = sent.filter(seq % 4 == 0).withColumn("behavior", F.lit("9"))
    for part in (sent.filter(seq % 3 != 1), sent.filter(seq % 3 == 1), changed):
        raw_log.log_lines(part).write.mode("append").text(f"{root}/log")
        stream = log_tail.tail_messages(spark, f"{root}/log", split_bytes=1 << 20)
        ingest.drain(ingest.ingest(stream, f"{root}/store", f"{root}/checkpoint"))
    return _shown_events(ingest.read_events(spark, f"{root}/store"))


@query("""
SELECT state, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(ts AS VARCHAR) AS time, CAST(user_id AS VARCHAR) AS user_id,
       CAST(article_id AS VARCHAR) AS article_id,
       CASE WHEN state = 'before' THEN behavior WHEN seq % 4 = 0 THEN '9' ELSE behavior END AS behavior
FROM b, (VALUES ('before'), ('after')) AS states(state) WHERE state = 'after' OR seq % 2 = 0""")
def read_across_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that was opened before later batches and a compaction, beside one opened after them."""
    root = work_dir(spark, "snapshots")
    sent, seq = events(spark, sf_dir), F.col("seq")
    store = versions.Versions(spark, f"{root}/store", versions.buckets_for(sent.count()))
    parts = (sent.filter(seq % 2 == 0), sent.filter(seq % 2 == 1), sent.filter(seq % 4 == 0).withColumn("behavior", F.lit("9")))
    opened = None
    for number, part in enumerate(parts):
        store.store(_unordered(raw_log.to_messages(part)), number, f"{root}/checkpoint")
        opened = opened or store.snapshot()
    before = versions.latest(store.events(opened))
    store.compact()
    both = before.withColumn("state", F.lit("before")).unionByName(
        versions.latest(store.events()).withColumn("state", F.lit("after"))
    )
    return _shown(both.select("state", "day", F.col("ts").cast("string").alias("time"), "user_id", "article_id", "behavior"))


@query("""
, asked AS (SELECT user_id, max(ts) AS ts FROM b GROUP BY user_id)
SELECT CAST(CAST(b.ts AS DATE) AS VARCHAR) AS day, CAST(b.ts AS VARCHAR) AS time,
       CAST(b.user_id AS VARCHAR) AS user_id, CAST(b.article_id AS VARCHAR) AS article_id, b.behavior
FROM b JOIN asked ON b.ts = asked.ts AND b.user_id = asked.user_id""")
def looked_up_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each user did at the last moment, looked up by key in a compacted store."""
    root = work_dir(spark, "lookups")
    sent = events(spark, sf_dir)
    store = versions.Versions(spark, f"{root}/store", versions.buckets_for(sent.count()))
    for number in range(2):
        part = sent.filter(F.col("seq") % 2 == number)
        store.store(_unordered(raw_log.to_messages(part)), number, f"{root}/checkpoint")
    now = store.compact()
    return _shown_events(store.lookup_all(sent.groupBy("user_id").agg(F.max("ts").alias("ts")), now))


@query("SELECT hour, article_id, domain, behavior, num FROM article_hour")
def stream_compacted_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The followed store compacted between its batches; late events and new articles reach compacted days."""
    root = _followed(spark, sf_dir, "compacted-hours")
    kept = spark.read.parquet(f"{root}/article_hour").drop("day")
    return _shown(kept.withColumn("article_id", text.as_number(F.col("article_id"))))


@query(_EVENTS_SQL.replace("{behavior}", "CASE WHEN seq % 6 = 0 THEN '9' ELSE behavior END"))
def ingest_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with checkpoints of their own fill one store; the later one's writes win."""
    root = work_dir(spark, "two-checkpoints")
    sent, seq = events(spark, sf_dir), F.col("seq")
    changed = sent.withColumn("behavior", F.when(seq % 6 == 0, "9").otherwise(F.col("behavior")))
    parts = {"first": sent.filter(seq % 3 != 1), "second": changed.filter((seq % 3 == 1) | (seq % 6 == 0))}
    for name, part in parts.items():
        stream = _message_stream(spark, raw_log.to_messages(part), f"{root}/{name}")
        ingest.drain(ingest.ingest(stream, f"{root}/store", f"{root}/{name}/checkpoint"))
    return _shown_events(ingest.read_events(spark, f"{root}/store"))


@query(_EVENTS_SQL.replace("{behavior}", "CASE WHEN seq % 4 = 0 THEN '9' ELSE behavior END"))
def compacted_and_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches compacted and retired, a third one read beside the compacted days."""
    root = work_dir(spark, "tail")
    sent, seq = events(spark, sf_dir), F.col("seq")
    changed = sent.filter(seq % 4 == 0).withColumn("behavior", F.lit("9"))
    batches = (sent, changed.filter(seq % 8 == 0), changed.filter(seq % 8 != 0))
    store, target = f"{root}/store", f"{root}/events"
    for number, batch in enumerate(batches):
        if number == 2:
            ingest.compact_days(spark, store, target)
        ingest.write_batch(_unordered(raw_log.to_messages(batch)), number, store)
    return _shown_events(ingest.read_events(spark, store, compacted=target))


def _stored(spark: SparkSession, sf_dir: str, root: str) -> str:
    ingest.write_batch(_unordered(raw_log.to_messages(events(spark, sf_dir))), 0, f"{root}/store")
    return f"{root}/store"


@query("SELECT hour, user_id, domain, num, 'whole' AS store FROM user_hour UNION ALL "
       "SELECT strftime(ts, '%Y-%m-%d %H'), user_id, domain, count(*), 'range' FROM b JOIN dim USING (article_id) "
       "WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-05 12:00:00' GROUP BY ALL")
def hourly_in_two_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days run again from keys within them stay whole; an exact range is kept apart."""
    root = work_dir(spark, "ranges")
    store, known = _stored(spark, sf_dir, root), articles(spark, sf_dir)
    jobs.hourly_days(spark, store, known, f"{root}/facts")
    for first, last in (("2024-01-05", "2024-01-05"), ("2024-01-05", "2024-01-06"), ("2024-01-20", None)):
        jobs.hourly_days(spark, store, known, f"{root}/facts", first, last)
    ends = ("2024-01-05 00:00:00", ""), ("2024-01-05 12:00:00", "")
    jobs.hourly_range(spark, store, known, f"{root}/range", *ends)
    kept = [
        spark.read.parquet(f"{root}/{folder}/user_hour").drop("day").withColumn("store", F.lit(name))
        for folder, name in (("facts", "whole"), ("range", "range"))
    ]
    both = kept[0].unionByName(kept[1])
    return _shown(both.withColumn("user_id", text.as_number(F.col("user_id"))))


@query("""
SELECT CAST(day AS VARCHAR) AS day, domain, CAST(sum(num) AS BIGINT) AS num FROM user_hour GROUP BY ALL""")
def facts_in_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jobs through tables of the catalog, the hourly one run twice."""
    root = work_dir(spark, "tables")
    database = f"facts_{root[-32:]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    store, known = _stored(spark, sf_dir, root), articles(spark, sf_dir)
    for first in (None, "2024-01-10"):
        jobs.hourly_days(spark, store, known, f"{root}/facts", first, database=database)
    jobs.daily_facts(spark, f"{root}/facts", database=database)
    return _shown(read_table(spark, f"{database}.domain_day_activity").select("day", "domain", "num"))


@query("""
SELECT CAST(event_id AS BIGINT) AS line, CAST(user_id AS VARCHAR) || '@x.com' AS user_id,
       CASE event_type WHEN 'signup' THEN 'not-a-time' WHEN 'click' THEN CAST(year(ts) AS VARCHAR)
            ELSE CAST(ts AS VARCHAR) END AS behavior_time,
       event_type NOT IN ('signup', 'click') AS readable
FROM events""")
def replay_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with marks in its ids and unreadable times, written, read and replayed."""
    visited = table(spark, sf_dir, "events")
    kind, ts = F.col("event_type"), F.col("ts")
    log = visited.select(
        F.concat(F.col("user_id").cast("string"), F.lit("@x.com")).alias("user_id"),
        F.lit("1").alias("behavior"), F.col("event_id").alias("article_id"),
        F.when(kind == "signup", "not-a-time").when(kind == "click", F.year(ts).cast("string"))
        .otherwise(ts.cast("string")).alias("behavior_time"),
    )
    path = work_dir(spark, "texts")
    raw_log.log_lines(log).write.text(path)
    read_back = raw_log.log_events(raw_log.read_behavior_log(spark, path))
    sent = raw_log.to_messages(read_back)
    # The first field holds a mark itself, so the message's texts are taken from its end.
    value = F.col("value")
    before = F.substring_index(value, text.FIELD_MARK, -3)
    return sent.select(
        F.split_part(before, F.lit(text.FIELD_MARK), F.lit(2)).cast("bigint").alias("line"),
        F.col("key").alias("user_id"),
        F.substring_index(value, text.FIELD_MARK, -1).alias("behavior_time"),
        timeparts.parse_time(F.substring_index(value, text.FIELD_MARK, -1)).isNotNull().alias("readable"),
    )


@query("""
SELECT CAST(day AS VARCHAR) AS day, article_id, CASE WHEN article_id % 3 = 0 THEN NULL ELSE num END AS num
FROM (SELECT day, article_id, CAST(sum(num) AS BIGINT) AS num FROM article_day
      WHERE domain = 'src3' GROUP BY ALL)""")
def pages_walked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a result with null counts, met by walking page after page.

    The walk is followed on Spark for all pages at once: a row is met on its page if it
    comes after the last row of the page before, and not on the next if not after its own.
    """
    found = _article_day(spark, sf_dir).filter(F.col("domain") == "src3")
    found = found.groupBy("day", "article_id").agg(F.sum("num").alias("num"))
    found = found.withColumn("num", F.when(F.col("article_id") % 3 != 0, F.col("num")))
    found = written(found, "walk")
    order, size = ["num", "day", "article_id"], 50
    placed = search.with_positions(found, order).withColumn("page", F.expr(f"position div {size}"))
    ends = placed.filter(F.col("position") % size == size - 1)
    met = placed
    for name, page in (("before", F.col("page") + 1), ("own", F.col("page"))):
        last = ends.select(page.alias("page"), F.struct(*order).alias(name))
        after = search.follows(order, {key: F.col(f"{name}.{key}") for key in order})
        met = met.join(last, "page", "left").filter(F.col(name).isNull() | (after if name == "before" else ~after))
    return _shown(met.select("day", "article_id", "num"))
