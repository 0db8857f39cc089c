"""Plan shapes that matter at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from footfall.operators import cells, facts, reports, search
from footfall.plans import jobs, queries
from footfall.plans.tables import articles, events, visits
from footfall.sources import tables as stored
from footfall.streaming import ingest
from tests.conftest import final_plan, plan, rows

SMALL = "/root/testdata/sf0.001"

LAZY = [
    name for name in queries.QUERIES
    if not name.startswith("stream_")
    and name not in ("hourly_in_two_ranges", "facts_in_tables", "ingest_two_checkpoints", "compacted_and_tail",
                     "pages_walked", "replay_texts", "stored_domain_days", "appended_table", "compacted_events", "raw_log_events", "weekly_report_files",
                     "replay_positions", "result_positions", "facts_by_changes", "read_across_compaction", "looked_up_by_key",
                     "stored_pages", "differing_by_digests", "compared_tables", "replayed_in_slices",
                     "weekly_stats_kept", "log_followed")
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_single_task_window(spark, name):
    text = plan(queries.QUERIES[name](spark, SMALL))
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert word not in text
    if "Window " in text:
        assert "Exchange SinglePartition" not in text


@pytest.mark.parametrize(
    "report", [reports.top_users_per_week, reports.top_domains_per_week,
               reports.least_active_per_day, reports.most_active_per_day]
)
def test_rankings_are_cut_before_the_shuffle(spark, make_user_hour, report):
    text = plan(report(make_user_hour(("2015-05-08 13:00:00", "U1", "java", 2))))
    assert re.search(r"WindowGroupLimit .*Partial", text)
    assert re.search(r"WindowGroupLimit .*Final", text)


def test_a_page_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(queries.QUERIES["result_page"](spark, SMALL))


def test_scans_read_only_the_columns_used(spark):
    text = plan(facts.user_hour_counts(events(spark, SMALL), articles(spark, SMALL)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,props:string>" in text
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in text


def test_key_range_reaches_the_scan(spark):
    found = cells.key_range(
        visits(spark, SMALL), ("2024-01-05 00:00:00", 1), ("2024-01-06 00:00:00", 1)
    )
    text = plan(found)
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in text
    assert "LessThanOrEqual(ts,2024-01-06T00:00)" in text


def test_day_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact = queries._article_day(spark, SMALL)
    stored.overwrite_days(fact, path)
    found = search.search_facts(spark.read.parquet(path), "20240105", "20240106", "src3", behavior="2")
    text = plan(found)
    assert re.search(r"PartitionFilters: \[.*day.*>=.*day.*<=", text)
    assert "EqualTo(domain,src3)" in text and "EqualTo(behavior,2)" in text
    by_key = events(spark, SMALL).withColumn("day", F.to_date("ts"))
    stored.overwrite_days(by_key, str(tmp_path / "events"))
    text = plan(
        cells.key_range(
            spark.read.parquet(str(tmp_path / "events")),
            ("2024-01-05 00:00:00", 1), ("2024-01-06 00:00:00", 1),
        )
    )
    assert re.search(r"PartitionFilters: \[.*day.*>=.*day.*<=", text)


@pytest.fixture
def skewed(spark):
    """A third of the events on one article."""
    n = 300_000
    pad = F.sha2(F.col("id").cast("string"), 256)
    made = spark.range(0, n, 1, 8).select(
        F.col("id").alias("seq"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") % 86_400)).alias("ts"),
        pad.alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5_000).alias("article_id"),
        F.lit("1").alias("behavior"),
    )
    dimension = spark.range(5_000).select(
        F.col("id").alias("article_id"), (F.col("id") % 20).alias("domain")
    )
    return made, dimension


@pytest.mark.parametrize("made_unique", [False, True])
def test_a_large_dimension_joins_by_shuffle_and_a_hot_article_is_split(
    spark, conf, skewed, made_unique
):
    made, dimension = skewed
    if made_unique:
        dimension = facts.unique_articles(dimension)
    wanted = rows(
        facts.user_hour_counts(made, dimension).groupBy("domain").agg(F.sum("num"), F.count("*"))
    )
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1MB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.shuffle.partitions", "16")
    fact = facts.user_hour_counts(made, dimension)
    text = final_plan(fact)
    assert "BroadcastHashJoin" not in text
    assert re.search(r"Join\(skew=true\)|Join.*skew=true", text)
    found = rows(fact.groupBy("domain").agg(F.sum("num"), F.count("*")))
    assert found == wanted


def test_a_hot_wide_row_is_collected_in_pieces_without_a_join(spark):
    latest = spark.createDataFrame(
        [], "ts TIMESTAMP_NTZ, user_id STRING, article_id STRING, behavior STRING"
    )
    text = plan(cells.collapse_cells(latest))
    assert re.search(r"hashpartitioning\(ts#\d+, user_id#\d+, part#\d+, \d+\)", text)
    assert "Join" not in text and text.count("Exchange") == 1


def test_last_writes_are_sorted_once_after_the_only_shuffle(spark):
    events = spark.createDataFrame(
        [], "seq LONG, ts TIMESTAMP_NTZ, user_id STRING, article_id STRING, behavior STRING"
    )
    text = plan(cells.latest_behavior(events))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert len(re.findall(r"\bSort \[", text)) == 1
    assert text.index("Sort [") < text.index("Exchange hashpartitioning")


def test_both_hourly_facts_read_resolved_events(spark, tmp_path, monkeypatch, make_articles):
    """The store is resolved once, then both facts scan what was kept."""
    batch = spark.createDataFrame(
        [("U1@1@D1@2015-05-08 13:13:19.0", None, None, None, None)],
        "value STRING, topic STRING, sent_at TIMESTAMP, part INT, pos BIGINT",
    )
    ingest.write_batch(batch, 0, str(tmp_path / "store"))
    seen = []
    real = jobs.overwrite_days
    monkeypatch.setattr(jobs, "overwrite_days", lambda df, *a: (seen.append(plan(df)), real(df, *a)))
    jobs.hourly_days(spark, str(tmp_path / "store"), make_articles(D1="java"), str(tmp_path / "facts"))
    assert len(seen) == 2
    for text in seen:
        assert "max(struct" not in text and "run#" not in text


def test_weekly_figures_are_worked_out_once(spark, tmp_path, monkeypatch, make_user_hour):
    seen = {}
    real = jobs.write_report
    monkeypatch.setattr(
        jobs, "write_report", lambda df, folder, name, fmt="json": (seen.update({name: plan(df)}), real(df, folder, name, fmt))[1]
    )
    jobs.weekly_report(make_user_hour(("2015-05-08 13:00:00", "U1", "java", 2)), str(tmp_path))
    assert "stddev" in seen["figures"]
    for name in ("average", "deviation"):
        assert "Aggregate" not in seen[name] and "Exchange" not in seen[name]


def test_weekly_mean_reads_its_source_once(spark):
    text = plan(queries.QUERIES["weekly_mean"](spark, SMALL))
    assert "documents" not in text and "events.parquet" not in text


def test_a_small_dimension_is_broadcast_without_a_hint(spark, skewed):
    made, dimension = skewed
    assert "BroadcastHashJoin" in final_plan(facts.article_hour_counts(made, dimension))


def test_counts_combine_before_the_join_on_a_hot_article(spark, conf, skewed):
    """The join of article counts sees one row per hour and behaviour of an article."""
    made, dimension = skewed
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(facts.article_hour_counts(made, dimension))
    join, aggregate = text.index("SortMergeJoin"), text.index("HashAggregate")
    assert join < aggregate


def test_a_hot_day_is_split_when_written(spark, conf, tmp_path):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    conf("spark.sql.shuffle.partitions", "8")
    fact = spark.range(0, 200_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("user_id"),
        F.date_add(
            F.lit("2024-01-01").cast("date"),
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).cast("int"),
        ).alias("day"),
    )
    path = tmp_path / "fact"
    stored.overwrite_days(fact, str(path))
    files = {d.name: len(list(d.glob("*.parquet"))) for d in path.glob("day=*")}
    assert files["day=2024-01-01"] > 3
    assert spark.read.parquet(str(path)).count() == 200_000


def test_the_walk_over_pages_brings_no_rows_to_the_driver(spark, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("rows came to the driver")

    some = "/root/testdata/sf0.01"
    num = F.when(F.col("article_id") % 3 != 0, F.sum("num"))
    whole = queries._article_day(spark, some).filter("domain = 'src3'").groupBy("day", "article_id").agg(num.alias("num"))
    whole = whole.select(F.col("day").cast("string").alias("day"), "article_id", "num")
    wanted = whole.collect()
    for name in ("collect", "toLocalIterator", "toPandas", "toArrow"):
        monkeypatch.setattr(type(spark.range(1)), name, refuse)
    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    found = queries.QUERIES["pages_walked"](spark, some)
    monkeypatch.undo()
    assert len(wanted) > 100 and rows(found.select(*wanted[0].asDict())) == rows(whole)
