from __future__ import annotations

import pytest

from footfall.__main__ import main
from footfall.streaming import ingest
from tests.conftest import rows


def test_jobs_from_store_to_reports(spark, tmp_path, capsys):
    store, facts, out = (str(tmp_path / name) for name in ("store", "facts", "out"))
    values = [
        "U1@1@D1@2015-05-08 13:13:19.0", "U1@1@D1@2015-05-08 13:20:00.0",
        "U2@0@D2@2015-05-09 10:00:00.0", "U2@0@D9@2015-05-09 10:00:00.0",
        "U3@0@D1@2015-06-01 00:00:00.0",
    ]
    batch = spark.createDataFrame(
        [(v, None, None, None, None) for v in values],
        "value STRING, topic STRING, sent_at TIMESTAMP, part INT, pos BIGINT",
    )
    ingest.write_batch(batch, 0, store)
    articles = str(tmp_path / "articles")
    spark.createDataFrame(
        [("D1", "t", "0", "1", "java"), ("D2", "t", "0", "1", "python"), ("D2", "u", "0", "1", "r")],
        "passage STRING, kind STRING, top STRING, status STRING, dom STRING",
    ).write.parquet(articles)

    def hourly(*ends, folder=facts):
        main(["hourly", "--store", store, "--articles", articles, "--facts", folder, *ends])

    # An exact range has a folder of its own; without its ends it is refused.
    exact = str(tmp_path / "exact")
    ends = ("--start", "2015-05-08 13:15:00.0@U1", "--stop", "2015-06-01 00:00:00.0@U3")
    hourly("--exact", *ends, folder=exact)
    counts = spark.read.parquet(f"{exact}/user_hour").select("user_id", "domain", "num")
    assert rows(counts) == [("U1", "java", 1), ("U2", "python", 1)]
    with pytest.raises(SystemExit):
        hourly("--exact", *ends[:2], folder=exact)

    # Ends choose whole days, also one end alone, and days of other runs stay.
    hourly("--start", "2015-05-08 13:15:00.0@U1", "--stop", "2015-05-08 13:18:00.0@U1")
    hourly("--start", "2015-05-09 10:00:00.0@U2", "--stop", "2015-05-09 10:00:00.0@U2")
    hourly("--stop", "2015-05-09 00:00:00.0@U1")
    main(["daily", "--facts", facts])
    main(["weekly", "--facts", facts, "--out", out])
    main(["compare", "--facts", facts])
    main(["search", "--facts", facts, "--start", "20150501", "--end", "20150531",
          "--domain", "java", "--behavior", "1"])

    user_hour = spark.read.parquet(f"{facts}/user_hour").select("user_id", "domain", "num")
    assert rows(user_hour) == [("U1", "java", 2), ("U2", "python", 1)]
    average = spark.read.json(f"{out}/average")
    assert rows(average.select("week", "avg")) == [(19, 1.5)]
    printed = capsys.readouterr().out
    assert "differing\t0 of 2" in printed
    assert "100%" in printed


def test_hourly_without_a_range_takes_everything(spark, tmp_path):
    store, facts = str(tmp_path / "store"), str(tmp_path / "facts")
    batch = spark.createDataFrame(
        [("U1@1@D1@2015-05-08 13:13:19.0", None, None, None, None)],
        "value STRING, topic STRING, sent_at TIMESTAMP, part INT, pos BIGINT",
    )
    ingest.write_batch(batch, 0, store)
    articles = str(tmp_path / "articles")
    spark.createDataFrame(
        [("D1", "t", "0", "1", "java")], "a STRING, b STRING, c STRING, d STRING, e STRING"
    ).write.parquet(articles)
    main(["hourly", "--store", store, "--articles", articles, "--facts", facts])
    assert spark.read.parquet(f"{facts}/article_hour").count() == 1


def test_hourly_after_compaction_and_with_an_open_end(spark, tmp_path):
    store, facts, target = (str(tmp_path / name) for name in ("store", "facts", "compacted"))
    schema = "value STRING, topic STRING, sent_at TIMESTAMP, part INT, pos BIGINT"

    def send(batch_id, *values):
        ingest.write_batch(spark.createDataFrame([(v, None, None, None, None) for v in values], schema), batch_id, store)

    articles = str(tmp_path / "articles")
    spark.createDataFrame(
        [("D1", "t", "0", "1", "java")], "a STRING, b STRING, c STRING, d STRING, e STRING"
    ).write.parquet(articles)

    def users():
        return rows(spark.read.parquet(f"{facts}/user_hour").select("user_id", "num"))

    hourly = ["hourly", "--store", store, "--articles", articles, "--facts", facts, "--compacted", target]
    send(0, "U1@1@D1@2015-05-08 13:13:19.0", "U1@1@D1@2015-05-08 13:13:19.0", "U2@1@D1@2015-06-01 10:00:00.0")
    main(["compact", "--store", store, "--compacted", target])
    main([*hourly, "--start", "2015-06-01 00:00:00.0@"])
    assert users() == [("U2", 1)]
    send(1, "U3@1@D1@2015-05-08 13:20:00.0")
    main(hourly)
    assert users() == [("U1", 1), ("U2", 1), ("U3", 1)]


def test_days_that_lose_all_rows_are_removed(spark, tmp_path):
    store, facts = str(tmp_path / "store"), str(tmp_path / "facts")
    schema = "value STRING, topic STRING, sent_at TIMESTAMP, part INT, pos BIGINT"
    sent = ["U1@1@D1@2015-05-08 13:13:19.0", "U2@1@D2@2015-05-09 10:00:00.0"]
    ingest.write_batch(spark.createDataFrame([(v, None, None, None, None) for v in sent], schema), 0, store)
    for known in (["D1", "D2"], ["D1"]):
        articles = str(tmp_path / f"articles{len(known)}")
        spark.createDataFrame(
            [(a, "t", "0", "1", "java") for a in known], "a STRING, b STRING, c STRING, d STRING, e STRING"
        ).write.parquet(articles)
        main(["hourly", "--store", store, "--articles", articles, "--facts", facts])
        main(["daily", "--facts", facts])
        for name in ("user_hour", "article_hour", "article_day", "domain_day_activity"):
            assert spark.read.parquet(f"{facts}/{name}").count() == len(known)
