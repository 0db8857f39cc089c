from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from footfall.operators import search
from footfall.schemas import ARTICLE_DAY, RESULT_ROW
from tests.conftest import day, rows


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [
            (day("2015-05-12"), "D1", "python", "1", 1),
            (day("2015-05-12"), "D1", "python", "2", 2),
            (day("2015-05-12"), "D1", "python", "0", 3),
            (day("2015-05-13"), "D1", "python", "1", 4),
            (day("2015-05-13"), "D1", "python", "2", 5),
            (day("2015-05-13"), "D1", "python", "0", 6),
            (day("2015-05-13"), "D2", "python", "1", 7),
            (day("2015-05-13"), "D3", "java", "1", 8),
            (day("2015-05-14"), "D1", "python", "1", 9),
            (day("2015-05-14"), "D1", "python", "7", 2),
        ],
        ARTICLE_DAY,
    )


def nums(df):
    return [r.num for r in df.collect()]


def test_both_ends_are_included(fact):
    found = search.search_facts(fact, "20150512", "2015-05-13", "python")
    assert sorted(nums(found)) == [1, 2, 3, 4, 5, 6, 7]


@pytest.mark.parametrize(
    "options, expected",
    [
        ({}, [1, 2, 2, 3, 4, 5, 6, 7, 9]),
        ({"behavior": "1"}, [1, 4, 7, 9]),
        ({"article_id": "D1"}, [1, 2, 2, 3, 4, 5, 6, 9]),
        ({"behavior": "1", "article_id": "D1"}, [1, 4, 9]),
        ({"behavior": "", "article_id": ""}, [1, 2, 2, 3, 4, 5, 6, 7, 9]),
    ],
)
def test_optional_filters(fact, options, expected):
    found = search.search_facts(fact, "20150501", "20150531", "python", **options)
    assert sorted(nums(found)) == expected


def test_start_after_end_is_empty(fact):
    assert nums(search.search_facts(fact, "20150531", "20150501", "python")) == []


def test_inputs_are_needed(fact):
    with pytest.raises(ValueError, match="domain"):
        search.search_facts(fact, "20150501", "20150531", "")
    with pytest.raises(ValueError, match="behavior"):
        search.table_view(fact, "20150501", "20150531", "python", "")
    with pytest.raises(ValueError, match="start, article_id"):
        search.chart_view(fact, "", "20150531", "python", "")


def test_table_view_is_ordered_and_has_percents(fact):
    found = search.table_view(fact, "20150501", "20150531", "python", "1")
    assert nums(found) == [1, 4, 7, 9]
    assert [r.percent_text for r in found.collect()] == ["4.76%", "19.05%", "33.33%", "42.86%"]
    assert found.agg(F.sum("percent")).first()[0] == pytest.approx(100)


def test_null_num_is_skipped(fact):
    some = fact.withColumn("num", F.when(F.col("num") > 7, F.col("num")))
    assert search.grand_total(some).first().total == 17
    percents = [r.percent_text for r in search.with_percent(some).orderBy("num").collect()]
    assert percents == [None] * 8 + ["47.06%", "52.94%"]


def test_result_rows_and_lines(fact):
    found = search.chart_view(fact, "20150512", "20150512", "python", "D1")
    result = search.result_rows(found)
    assert result.schema.names == RESULT_ROW.names
    assert {f.dataType for f in result.schema} == {f.dataType for f in RESULT_ROW}
    assert rows(search.table_lines(result), "as_is") == [
        ("20150512,python,D1,1,1,16.67%",),
        ("20150512,python,D1,2,2,33.33%",),
        ("20150512,python,D1,0,3,50%",),
    ]
    assert rows(search.chart_lines(result), "as_is")[0] == ("20150512,1,1",)


def test_timeline_aligns_by_day(fact):
    found = search.behavior_timeline(fact, "20150501", "20150531", "python", "D1")
    assert rows(found, "as_is") == [
        (day("2015-05-12"), 3, 1, 2, 6),
        (day("2015-05-13"), 6, 4, 5, 15),
        (day("2015-05-14"), 0, 9, 2, 11),
    ]
    axis = search.active_days(search.search_facts(fact, "20150501", "20150531", "python"))
    assert [r.day.day for r in axis.collect()] == [12, 13, 14]


ORDER = ["num", "article_id", "behavior"]


def test_pages_do_not_overlap_and_miss_nothing(fact):
    pages = [nums(search.page(fact, ORDER, number, 4)) for number in range(4)]
    assert pages == [[1, 2, 2, 3], [4, 5, 6, 7], [8, 9], []]
    with pytest.raises(ValueError):
        search.page(fact, ORDER, -1)


def test_pages_of_a_numbered_result_are_the_same(fact):
    numbered = search.with_positions(fact, ORDER)
    for n in range(5):
        assert rows(search.page_at(numbered, n, 3), "as_is") == rows(search.page(fact, ORDER, n, 3), "as_is")
    with pytest.raises(ValueError):
        search.page_at(numbered, 0, 0)


def test_a_walk_passes_nulls_like_the_pages(spark):
    made = [(None, None), (None, "a"), (1, None), (1, "b"), (None, "b"), (2, "a"), (1, "a"), (2, None)]
    df = spark.createDataFrame(made, "num INT, k STRING")
    pages = [r for n in range(4) for r in rows(search.page(df, ["num", "k"], n, 2), "as_is")]
    walked, last = [], None
    while part := search.page_after(df, ["num", "k"], last, 2).collect():
        walked += [tuple(r) for r in part]
        last = part[-1].asDict()
    assert walked == pages and len(walked) == len(made)


def test_walking_on_from_the_last_row(fact):
    seen, last = [], None
    while True:
        part = search.page_after(fact, ORDER, last, 3).collect()
        if not part:
            break
        seen += [r.num for r in part]
        last = part[-1].asDict()
    assert seen == [1, 2, 2, 3, 4, 5, 6, 7, 8, 9]


def test_positions_over_many_partitions(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("n"))
    placed = search.with_positions(df.repartition(7), ["n"])
    assert placed.filter(F.col("n") != F.col("position")).count() == 0
    assert placed.count() == 20_000
