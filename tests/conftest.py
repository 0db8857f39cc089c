from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from footfall.session import build_session  # noqa: E402
from footfall.schemas import ARTICLES, EVENTS, USER_HOUR  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def put(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


@pytest.fixture
def make_events(spark):
    def make(*rows):
        """Rows of (time, user, article, behaviour), numbered in order."""
        return spark.createDataFrame(
            [(i, at(t), u, a, b) for i, (t, u, a, b) in enumerate(rows)], EVENTS
        )

    return make


@pytest.fixture
def make_articles(spark):
    def make(**domains):
        return spark.createDataFrame(
            [(a, "t", "0", "1", d) for a, d in domains.items()], ARTICLES
        )

    return make


@pytest.fixture
def make_user_hour(spark):
    def make(*rows):
        return spark.createDataFrame([(at(h), u, d, n) for h, u, d, n in rows], USER_HOUR)

    return make


def in_order(found):
    """Sorted tuples, nulls last."""
    return sorted(found, key=lambda row: [(value is None, value) for value in row])


def rows(df, *order):
    """Rows as tuples: sorted, or in the frame's own order with "as_is"."""
    found = [tuple(r) for r in df.collect()]
    return found if order == ("as_is",) else in_order(found)


def final_plan(df) -> str:
    """The plan that ran, after adaptive re-planning."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
