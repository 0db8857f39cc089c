from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from footfall.llm import urls

CASES = [
    ("http://WWW.Example.ORG/es/5", "www.example.org", "/es/5", "example.org/es/", "block"),
    ("https://example.org/en/17?x#y", "example.org", "/en/17", "example.org/en/1", "block"),
    ("https://example.org/en/27", "example.org", "/en/27", "org/", "allow"),
    ("https://notexample.org/es/5", "notexample.org", "/es/5", "org/", "allow"),
    ("https://a.com/de/", "a.com", "/de/", "com/de/", "block"),
    ("https://a.com/fr/cheap-pills", "a.com", "/fr/cheap-pills", "com/fr/", "allow"),
    ("https://www.cheap-pills.net/x", "www.cheap-pills.net", "/x", None, "block"),
    ("https://cheappills.net/x", "cheappills.net", "/x", None, "allow"),
    ("https://x.org", "x.org", "", None, "allow"),
    ("https://x.org?a/b", "x.org", "", None, "allow"),
    ("x://a://b/c", "a:", "//b/c", None, "allow"),
    ("spam-farm", "", "", None, "block"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("https://É.com/DE/", "É.com", "/DE/", None, "allow"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(i, case[0]) for i, case in enumerate(CASES)], "page_id long, url string")


def test_parts_rules_and_verdicts(pages):
    found = [tuple(row)[2:] for row in urls.judge_urls(pages).orderBy("page_id").collect()]
    assert found == [case[1:] for case in CASES]


def test_any_filing_gives_the_verdicts_of_all_patterns(spark):
    texts = [f"http://{a}{s}{b}.net/{c}" for a in ("spam", "cheap", "login", "x") for s in ".-/" for b in ("farm", "pills", "verify")
             for c in ("", "casino-bonus", "casino/free", "login/a/verify")]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "page_id long, url string")
    found = {row.url: row.verdict for row in urls.judge_urls(rows, path_rules=()).collect()}
    assert found == {
        t: "block" if any(re.search(rule.pattern, t) for rule in urls.PATTERN_RULES) else "allow" for t in texts
    }
    assert set(found.values()) == {"block", "allow"}


def test_rules_are_filed_under_their_rarest_word(spark):
    rows = spark.createDataFrame([("http://a.net/spam",), ("http://spam-farm.net/",), (None,)], "url string")
    index = urls.rarest_words(rows, [urls.phrase("spam", "farm")])
    assert list(index) == ["farm"]


def test_no_python_runs(pages):
    plan = urls.judge_urls(pages)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_clashing_columns_repeated_rows_and_empty_tables(pages):
    twice = pages.unionAll(pages).withColumn("Verdict", F.lit(1)).withColumn("a b", F.lit(2))
    found = urls.judge_urls(twice)
    assert found.columns == ["page_id", "url", "a b", "host", "path", "rule", "verdict"]
    assert found.count() == 2 * len(CASES)
    assert urls.judge_urls(pages.limit(0)).count() == 0
    assert urls.judge_urls(pages, (), ()).where("verdict = 'block'").count() == 0
