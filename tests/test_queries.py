"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from footfall.plans.queries import QUERIES, TWINS

SMALL = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SMALL.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_a_twin_and_is_registered():
    assert set(TWINS) == set(QUERIES)
    assert QUERIES.items() <= entry_points.queries().items()
    assert TWINS.items() <= entry_points.oracle_sql().items()
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 50


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_twin(spark, duck, name):
    df = QUERIES[name](spark, str(SMALL))
    columns = sorted(df.columns)
    found = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    twin = duck.sql(TWINS[name])
    assert sorted(twin.columns) == columns
    places = [twin.columns.index(c) for c in columns]
    wanted = sorted((tuple(r[i] for i in places) for r in twin.fetchall()), key=repr)
    assert found == wanted
