from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from footfall.operators import cells
from tests.conftest import at, rows


def test_last_write_wins(make_events):
    events = make_events(
        ("2015-05-08 13:13:19", "U1", "D1", "0"),
        ("2015-05-08 13:13:19", "U1", "D1", "1"),
        ("2015-05-08 13:13:19", "U1", "D2", "2"),
    )
    assert rows(cells.latest_behavior(events)) == [
        (at("2015-05-08 13:13:19"), "U1", "D1", "1"),
        (at("2015-05-08 13:13:19"), "U1", "D2", "2"),
    ]


def test_equal_sequence_is_settled_by_the_behavior(make_events):
    events = make_events(
        ("2015-05-08 13:13:19", "U1", "D1", "2"), ("2015-05-08 13:13:19", "U1", "D1", "0")
    ).withColumn("seq", F.lit(7).cast("bigint"))
    assert rows(cells.latest_behavior(events))[0][-1] == "2"


@pytest.fixture
def ranged(make_events):
    return make_events(
        ("2015-05-08 13:13:18", "U9", "D1", "1"),
        ("2015-05-08 13:13:19", "U1", "D2", "1"),
        ("2015-05-08 13:13:19", "U5", "D3", "1"),
        ("2015-05-08 13:13:19.05", "U0", "D4", "1"),
        ("2015-05-31 23:59:47", "U1", "D5", "1"),
        ("2015-05-31 23:59:47", "U5", "D6", "1"),
        ("2015-06-01 00:00:00", "U0", "D7", "1"),
    )


def articles_of(df):
    return sorted(r.article_id for r in df.collect())


@pytest.mark.parametrize("stored_by_day", [False, True])
def test_key_range_start_kept_stop_excluded(ranged, stored_by_day):
    if stored_by_day:
        ranged = ranged.withColumn("day", F.to_date("ts"))
    found = cells.key_range(
        ranged, ("2015-05-08 13:13:19.0", "U5"), ("2015-05-31 23:59:47.0", "U5")
    )
    assert articles_of(found) == ["D3", "D4", "D5"]


def test_equal_ends_look_up_one_key(ranged):
    key = ("2015-05-08 13:13:19.0", "U5")
    assert articles_of(cells.key_range(ranged, key, key)) == ["D3"]


def test_stop_before_start_is_empty(ranged):
    late, early = ("2015-05-31 00:00:00", "U1"), ("2015-05-08 00:00:00", "U1")
    assert cells.key_range(ranged, late, early).count() == 0


def test_wide_rows_and_back(make_events):
    latest = cells.latest_behavior(
        make_events(
            ("2015-05-08 13:13:19", "U1", "D1", "0"),
            ("2015-05-08 13:13:19", "U1", "D2", "1"),
            ("2015-05-08 13:13:19", "U2", "D1", "1"),
        )
    )
    wide = cells.collapse_cells(latest, parts=1)
    assert {(r.user_id, r.part): r.cells for r in wide.collect()} == {
        ("U1", 0): {"D1": "0", "D2": "1"},
        ("U2", 0): {"D1": "1"},
    }
    assert rows(cells.explode_cells(wide)) == rows(latest)


def test_a_cell_keeps_its_row_as_others_arrive(spark):
    def wide(n):
        latest = spark.range(n).select(
            F.lit("2015-05-08 00:00:00").cast("timestamp_ntz").alias("ts"), F.lit("U").alias("user_id"),
            F.concat(F.lit("D"), F.col("id")).alias("article_id"), F.lit("1").alias("behavior"),
        )
        return {a: r.part for r in cells.collapse_cells(latest).collect() for a in r.cells}

    few, many = wide(10), wide(3_000)
    assert len(many) == 3_000 and few.items() <= many.items()


def test_a_very_wide_row_is_spread_and_stays_whole(spark):
    """A third of all cells share one key."""
    latest = spark.range(9_000).select(
        F.lit("2015-05-08 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("U"), F.col("id") % 100)).alias("user_id"),
        F.concat(F.lit("D"), F.col("id")).alias("article_id"),
        F.lit("1").alias("behavior"),
    )
    wide = cells.collapse_cells(latest)
    hot = wide.filter(F.col("user_id") == "hot").select(F.size("cells").alias("n")).collect()
    assert len(hot) == cells.PARTS
    assert sum(r.n for r in hot) == 3_000
    assert max(r.n for r in hot) < 300
    back = cells.explode_cells(wide)
    assert back.exceptAll(latest.select(*back.columns)).count() == 0
    assert back.count() == 9_000
