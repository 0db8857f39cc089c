from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from footfall.operators import facts
from footfall.plans import queries
from footfall.sources import messages
from footfall.streaming import deltas, ingest, versions
from tests.conftest import at, rows

GOOD = "2015-05-08 13:13:19.0"
SCHEMA = "value STRING, topic STRING, sent_at TIMESTAMP, part INT, pos BIGINT"


@pytest.fixture
def batch(spark):
    def make(*values):
        return spark.createDataFrame([(v, None, None, None, i) for i, v in enumerate(values)], SCHEMA).coalesce(1)

    return make


@pytest.fixture
def store(spark, tmp_path):
    return versions.Versions(spark, str(tmp_path / "store"), buckets=4)


def cells(df):
    return rows(df.select("ts", "user_id", "article_id", "behavior"))


def many(n, day="2015-05-08"):
    return [f"U{i % 50}@{i % 3}@D{i % 17}@{day} {i % 24:02}:{i % 60:02}:00.{i % 10}" for i in range(n)]


def scan_of(df, conf):
    """(files of the chosen days, rows that the scan gave) of the only scan of a plan."""
    conf("spark.sql.adaptive.enabled", "false")
    df = df.select("*")
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if "FileScan" in leaves.apply(i).toString()]
    assert len(scans) == 1
    metrics = scans[0].metrics()
    return metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()


def test_commits_are_numbered_and_taken_once(store):
    first = store.snapshot()
    assert first.version == 0 and not first.entries
    one, other = versions.Entry("events", "2015-05-08", "a"), versions.Entry("events", "2015-05-08", "b")
    assert store.publish(first, [one])
    assert not store.publish(first, [other])
    assert store.snapshot().entries == {one} and store.snapshot(0).entries == set()
    assert store.publish(store.snapshot(), [other], [one])
    assert store.snapshot().entries == {other} and store.snapshot(1).entries == {one}
    with pytest.raises(versions.StoreChanged):
        store.publish_later([], [one])
    with pytest.raises(ValueError):
        store.snapshot(9)


def test_streams_are_numbered_by_the_log(store, tmp_path):
    a, b = (str(tmp_path / name) for name in "ab")
    assert [store.stream(x)[0] for x in (a, b, a)] == [1, 2, 1]


def test_whole_lists_and_vacuum(store, monkeypatch):
    monkeypatch.setattr(versions, "WHOLE_EVERY", 3)
    entries = [versions.Entry("events", "2015-05-08", f"c{i}") for i in range(8)]
    for i, entry in enumerate(entries):
        assert store.publish(store.snapshot(), [entry], entries[i - 1 : i] if i else [])
    assert [store.snapshot(i + 1).entries for i in range(8)] == [{entry} for entry in entries]
    store.vacuum(keep=2)
    assert store.snapshot().entries == {entries[7]} and store.snapshot(7).entries == {entries[6]}
    with pytest.raises(ValueError):
        store.snapshot(2)


def test_last_write_wins_and_a_repeated_batch_adds_nothing(store, batch, tmp_path):
    checkpoint = str(tmp_path / "cp")
    store.store(batch(f"U1@0@D1@{GOOD}", "bad@1", f"U1@2@D2@{GOOD}"), 0, checkpoint)
    for _ in range(2):
        store.store(batch(f"U1@1@D1@{GOOD}", "U4@1@D4@2015-05-09 00:00:00.0"), 1, checkpoint)
    assert store.events().count() == 4
    assert cells(versions.latest(store.events())) == [
        (at("2015-05-08 13:13:19"), "U1", "D1", "1"), (at("2015-05-08 13:13:19"), "U1", "D2", "2"),
        (at("2015-05-09 00:00:00"), "U4", "D4", "1"),
    ]
    assert rows(store.rejects()) == [(0, "bad@1")]
    assert cells(versions.latest(store.events(days=["2015-05-09"]))) == [(at("2015-05-09 00:00:00"), "U4", "D4", "1")]


def test_a_reader_keeps_what_it_opened(store, batch, tmp_path):
    checkpoint = str(tmp_path / "cp")
    store.store(batch(*many(300)), 0, checkpoint)
    store.store(batch(*many(100, "2015-05-09")), 1, checkpoint)
    opened = store.events()
    wanted = cells(versions.latest(opened))
    store.store(batch(f"U1@1@D1@{GOOD}"), 2, checkpoint)
    store.compact()
    assert opened.count() == 400 and cells(versions.latest(opened)) == wanted
    assert store.events().count() == len(wanted) + 1
    assert store.vacuum() > 0
    assert store.events().count() == len(wanted) + 1


def test_compaction_gives_way_to_batches_but_not_to_another_one(store, batch, tmp_path, monkeypatch):
    checkpoint = str(tmp_path / "cp")
    for i in range(2):
        store.store(batch(*many(20 + i)), i, checkpoint)
    other = versions.Versions(store.spark, store.path, 4)
    write = store.write

    def meanwhile(*args):
        other.store(batch("U9@1@D9@2015-05-08 23:00:00.0"), 2, checkpoint)
        return write(*args)

    monkeypatch.setattr(store, "write", meanwhile)
    store.compact()
    assert "U9" in {r.user_id for r in versions.latest(store.events()).collect()}
    monkeypatch.setattr(store, "write", lambda *args: (other.compact(), write(*args))[1])
    with pytest.raises(versions.StoreChanged):
        store.compact()


def test_resolving_moves_no_rows(store, batch, tmp_path, conf):
    for i in range(3):
        store.store(batch(*many(200)), i, str(tmp_path / "cp"))
    conf("spark.sql.adaptive.enabled", "false")
    text = versions.latest(store.events())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "SelectedBucketsCount: 4 out of 4" in text


def test_a_lookup_reads_one_bucket_of_one_day(store, batch, tmp_path, conf):
    store.store(batch(*many(600), *many(600, "2015-05-09")), 0, str(tmp_path / "cp"))
    found = store.lookup("U7", "2015-05-08 07:07:00.7")
    assert "SelectedBucketsCount: 1 out of 4" in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.user_id, r.article_id) for r in found.collect()} == {("U7", "D7")}
    files, read = scan_of(found, conf)
    # Four files of the day, of which one bucket was read.
    assert files == 4 and 0 < read < 300
    asked = store.spark.createDataFrame([("U7", at("2015-05-08 07:07:00.700")), ("U0", at("2015-05-07 00:00:00"))], "user_id string, ts timestamp_ntz")
    assert cells(store.lookup_all(asked)) == cells(found)


def test_bloom_filters_pass_over_files_without_an_article(store, batch, tmp_path, conf):
    for i in range(4):  # each article in one batch only; bounds alone would not tell them apart
        values = [f"U{k % 9}@1@D{4 * (k % 50) + i}@{GOOD}" for k in range(200)]
        store.store(batch(*values), i, str(tmp_path / "cp"))
    found = store.of_article("D81", ["2015-05-08"])
    wanted = {r.user_id for r in versions.latest(store.events()).where("article_id = 'D81'").collect()}
    assert wanted and {r.user_id for r in found.collect()} == wanted
    _, read = scan_of(found, conf)
    total = store.events().count()
    assert read <= total // 4


SENT = [
    [f"U1@0@D1@{GOOD}", "U1@0@D1@2015-05-08 13:59:19.5", "U2@1@D9@2015-05-08 13:00:00.0", "oops"],
    ["U1@0@D1@2015-05-09 13:59:59.0", "U1@1@D2@2015-05-09 14:00:00.0", f"U1@0@D1@{GOOD}"],
    ["U2@1@D2@2015-05-12 16:30:00.0", "U1@0@D1@2015-05-12 18:00:00.0", "U2@2@D9@2015-05-08 13:00:00.0"],
    ["U1@0@D1@2015-05-08 13:14:00.0", "U1@2@D1@2015-05-09 13:59:59.0", "U2@0@D9@2015-05-08 13:00:00.0"],
    ["U3@1@D9@2015-05-08 13:00:00.0", "U1@1@D1@2015-05-09 13:59:59.0", "U1@2@D1@2015-05-09 13:59:59.0"],
]


def assert_equal_to_batch(kept, articles):
    events = kept.events().drop("day")
    for name, count in (("article_hour", facts.article_hour_counts), ("user_hour", facts.user_hour_counts)):
        assert rows(kept.fact(name).drop("day")) == rows(count(events, articles))


def test_facts_by_changes_equal_the_batch_job(spark, tmp_path, batch, make_articles):
    known = [make_articles(D1="java")]
    kept = deltas.Followed(spark, str(tmp_path / "store"), lambda: known[-1], buckets=4)
    for number, values in enumerate(SENT):
        if number == 3:
            known.append(make_articles(D1="java", D2="python", D9="r"))
        for _ in range(2 if number in (1, 3) else 1):
            kept.apply(batch(*values), number, str(tmp_path / "cp"))
        if number == 2:
            kept.compact()
        if number != 2:  # the third batch names articles that only the fourth one's dimension knows
            assert_equal_to_batch(kept, known[-1])
    assert rows(kept.versions.rejects()) == [(0, "oops")]
    assert kept.waiting(kept.versions.snapshot()).count() == 0
    kept.compact()
    assert_equal_to_batch(kept, known[-1])


def test_two_streams_at_once_count_a_key_once(spark, tmp_path, batch, make_articles, monkeypatch):
    articles = make_articles(D1="java")
    path = str(tmp_path / "store")
    mine, other = (deltas.Followed(spark, path, lambda: articles, buckets=4) for _ in range(2))
    worked, calls = mine._changed, []

    def changed(*args):
        if not calls:
            calls.append(1)
            other.apply(batch(f"U1@0@D1@{GOOD}"), 0, str(tmp_path / "other"))
        return worked(*args)

    monkeypatch.setattr(mine, "_changed", changed)
    mine.apply(batch(f"U1@1@D1@{GOOD}"), 0, str(tmp_path / "mine"))
    assert_equal_to_batch(mine, articles)
    assert [r.num for r in mine.fact("user_hour").collect()] == [1]


def test_a_batch_reads_only_its_keys_buckets(store, batch, tmp_path, conf):
    store.store(batch(*many(600), *many(600, "2015-05-09")), 0, str(tmp_path / "cp"))
    added, days, slots = store.stage(batch("U7@2@D7@2015-05-08 07:07:00.7"), 1, 1)
    mine = store.rows(versions.Snapshot(0, frozenset(added), {}), versions.EVENTS_TABLE, versions.STORED)
    stored = store.events(days=days).where(F.col("slot").isin(slots))
    changed = deltas.changes(mine, stored)
    assert sorted((r.behavior, r.num) for r in changed.collect()) == [("1", -1), ("2", 1)]
    conf("spark.sql.adaptive.enabled", "false")
    text = deltas.changes(mine, stored)._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 4" in text
    files, read = scan_of(stored, conf)
    assert files == 4 and 0 < read < 300


def test_changes_from_a_stream(spark, tmp_path, make_articles):
    folder = tmp_path / "topic"
    folder.mkdir()
    articles = make_articles(D1="java", D2="python", D9="r")
    kept = deltas.Followed(spark, str(tmp_path / "store"), lambda: articles, buckets=4)
    for number, values in enumerate(SENT[:2]):
        (folder / f"{number}.txt").write_text("\n".join(values) + "\n")
        stream = messages.read_stream(spark, "text", path=str(folder))
        ingest.drain(kept.writer(stream, str(tmp_path / "cp")))
    assert_equal_to_batch(kept, articles)


@pytest.mark.parametrize("name", ["facts_by_changes", "read_across_compaction", "looked_up_by_key"])
def test_buckets_of_a_query_grow_with_its_events(spark, tmp_path, monkeypatch, name):
    spark.range(120).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id AS int)) AS ts", "id % 7 AS user_id",
        "'view' AS event_type", "1.0D AS value", "concat('{\"k\": ', id % 5, '}') AS props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(5).selectExpr(
        "id AS doc_id", "'' AS text", "'en' AS lang", "concat('src', id) AS source", "0L AS n_chars"
    ).write.parquet(str(tmp_path / "documents.parquet"))
    wanted = queries.QUERIES[name](spark, str(tmp_path)).collect()
    made = []
    begin = versions.Versions.__init__

    def begun(self, *args, **options):
        begin(self, *args, **options)
        made.append(self.buckets)

    monkeypatch.setattr(versions, "BUCKET_ROWS", 10, raising=False)
    monkeypatch.setattr(versions.Versions, "__init__", begun)
    assert sorted(map(str, queries.QUERIES[name](spark, str(tmp_path)).collect())) == sorted(map(str, wanted))
    assert wanted and set(made) == {12}  # 120 rows, 10 a bucket


def test_buckets_are_no_more_than_slots():
    assert [versions.buckets_for(n) for n in (0, 10, 6_000_000, 1 << 40)] == [4, 4, 12, versions.SLOTS]


def test_a_batch_is_read_once(store, batch, tmp_path, spark):
    read = spark.sparkContext.accumulator(0)

    def count(rows_):
        for row in rows_:
            read.add(1)
            yield row

    values = batch(f"U1@0@D1@{GOOD}", "bad@1", f"U1@2@D2@{GOOD}")
    store.store(spark.createDataFrame(values.rdd.mapPartitions(count), SCHEMA), 0, str(tmp_path / "cp"))
    assert read.value == 3
    assert store.events().count() == 2 and rows(store.rejects()) == [(0, "bad@1")]
