from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from footfall.sources import messages, raw_log, synthetic, tables
from footfall.session import MIB, size_settings, work_dir
from tests.conftest import at, day, rows


def test_raw_log_lines(spark, tmp_path):
    (tmp_path / "log").write_text(
        "U0155827\x011\x01D0863227\x012015-05-08 13:13:19.0\n"
        'U"2\x010\x01D"1,x\x012015-05-08 13:13:20.5\x01extra\n'
        "U3\x011\n"
    )
    log = raw_log.read_behavior_log(spark, str(tmp_path / "log"))
    assert rows(log) == [
        ('U"2', "0", 'D"1,x', "2015-05-08 13:13:20.5"),
        ("U0155827", "1", "D0863227", "2015-05-08 13:13:19.0"),
        ("U3", "1", None, None),
    ]
    assert rows(raw_log.log_events(log).select("ts")) == [
        (at("2015-05-08 13:13:19"),), (at("2015-05-08 13:13:20.500"),), (None,),
    ]


def test_messages_are_keyed_and_in_time_order_for_each_user(make_events):
    events = make_events(
        ("2015-05-08 13:13:20", "U1", "D1", "1"),
        ("2015-05-08 13:13:19.05", "U2", "D2", "0"),
        ("2015-05-08 13:13:19", "U1", "D3", "2"),
        ("2015-05-08 13:13:18", "U2", "D4", "2"),
    ).repartition(3)
    sent = raw_log.to_messages(events).withColumn("task", F.spark_partition_id()).collect()
    for user, wanted in {
        "U1": ["U1@2@D3@2015-05-08 13:13:19.0", "U1@1@D1@2015-05-08 13:13:20.0"],
        "U2": ["U2@2@D4@2015-05-08 13:13:18.0", "U2@0@D2@2015-05-08 13:13:19.05"],
    }.items():
        assert [r.value for r in sent if r.key == user] == wanted
        assert len({r.task for r in sent if r.key == user}) == 1


def test_a_log_keeps_its_texts_through_a_replay(spark, tmp_path):
    logged = [("u@x.com", "1", "D1", "not-a-time"), ("U2", "0", "a@b", "2015"), ("U3", "2", "D3", " 2015-05-08 13:13:19.0")]
    log = spark.createDataFrame(logged, "user_id STRING, behavior STRING, article_id STRING, behavior_time STRING")
    raw_log.log_lines(log).write.text(str(tmp_path / "log"))
    read_back = raw_log.read_behavior_log(spark, str(tmp_path / "log"))
    assert rows(read_back) == sorted(logged)
    sent = rows(raw_log.to_messages(raw_log.log_events(read_back)).select("value"))
    assert sent == sorted(("@".join(fields),) for fields in logged)
    assert [r.ts for r in raw_log.log_events(read_back).orderBy("user_id").collect()] == [
        None, at("2015-05-08 13:13:19"), None,
    ]


def test_parse_messages(spark):
    values = [
        "U1@1@D1@2015-05-08 13:13:19.0",
        "bad@1",
        "U3@1@D3@",
        "U4@1@D4@2015-05-09 00:00:00.0@extra",
        "@1@D5@2015-05-09 00:00:00.0",
        "U6@1@@2015-05-09 00:00:00.0",
        "U7@@D7@2015-05-09 00:00:00.0",
        "",
    ]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value STRING, pos INT")
    parsed = {r.pos: r for r in raw_log.parse_messages(df, "pos").collect()}
    assert [parsed[i].status for i in range(8)] == [
        "ok", "rejected", "rejected", "ok", "rejected", "rejected", "ok", "rejected",
    ]
    assert (parsed[3].ts, parsed[3].user_id, parsed[3].article_id) == (
        at("2015-05-09 00:00:00"), "U4", "D4",
    )
    assert parsed[1].value == "bad@1" and parsed[0].value is None
    assert parsed[7].value == ""


def test_topic_options():
    assert messages.topic_list("b, a,b,,c ") == "a,b,c"
    options = messages.kafka_options("h1:9092,h2:9092", "t1,t2", startingOffsets="latest")
    assert options == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "t1,t2",
        "startingOffsets": "latest",
    }


class Recorder:
    """Stands in for a reader or writer and keeps what it is told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def load(self):
        return self.told

    def save(self):
        self.told["saved"] = True


class FakeFrame:
    columns = ["key", "value", "other"]

    def __init__(self):
        self.write = Recorder()

    def select(self, *names):
        self.write.told["selected"] = names
        return self

    def repartition(self, n):
        self.write.told["tasks"] = n
        return self


def test_publish_to_a_topic():
    frame = FakeFrame()
    messages.publish(frame, "visits", "h1:9092")
    assert frame.write.told == {
        "selected": ("key", "value"), "format": "kafka", "topic": "visits",
        "kafka.bootstrap.servers": "h1:9092", "mode": "append", "saved": True,
    }


def test_jdbc_options():
    class FakeSession:
        read = Recorder()

    told = tables.read_jdbc(
        FakeSession(), "jdbc:x", "facts", {"user": "u"}, ("day", "2015-05-01", "2015-06-01", 31)
    )
    assert told == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "facts", "user": "u",
        "partitionColumn": "day", "lowerBound": "2015-05-01", "upperBound": "2015-06-01",
        "numPartitions": "31",
    }
    frame = FakeFrame()
    tables.append_jdbc(frame, "jdbc:x", "facts", connections=5)
    assert frame.write.told == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "facts", "numPartitions": "5", "tasks": 5,
        "batchsize": "10000", "mode": "append", "saved": True,
    }


def test_append_table_goes_by_name(spark, tmp_path, make_user_hour):
    fact = make_user_hour(("2015-05-08 13:00:00", "U1", "java", 2)).withColumn(
        "day", F.to_date("hour")
    )
    spark.sql("DROP TABLE IF EXISTS act_num")
    tables.append_table(fact, "act_num", path=str(tmp_path / "act_num"))
    tables.append_table(fact.select("num", "day", "domain", "user_id", "hour"), "act_num")
    stored = tables.read_table(spark, "act_num").select(*fact.columns)
    assert rows(stored) == rows(fact) * 2
    spark.sql("DROP TABLE act_num")


def test_articles_by_position(spark):
    df = spark.createDataFrame(
        [("D1", "t", "0", "1", "java")], "passage STRING, Kind STRING, Top STRING, st STRING, dom STRING"
    )
    assert tables.as_articles(df).columns == ["article_id", "type", "is_top", "status", "domain"]


def test_overwrite_days_replaces_only_the_days_given(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = spark.createDataFrame(
        [(day("2015-05-08"), 1), (day("2015-05-09"), 2)], "day DATE, num BIGINT"
    )
    tables.overwrite_days(first, path)
    tables.overwrite_days(first, path)
    again = spark.createDataFrame([(day("2015-05-09"), 5)], "day DATE, num BIGINT")
    tables.overwrite_days(again, path)
    assert rows(spark.read.parquet(path).select("day", "num")) == [
        (day("2015-05-08"), 1), (day("2015-05-09"), 5),
    ]


def test_repartition_for_sink(spark):
    assert tables.repartition_for_sink(spark.range(10), 3).rdd.getNumPartitions() == 3


def test_temp_view(spark):
    tables.register(spark.range(3), "three")
    assert spark.sql("SELECT sum(id) AS s FROM three").first().s == 3


def test_synthetic_events(spark):
    made = synthetic.synthetic_events(spark, 2_000)
    parts = F.split("value", ",")
    checked = made.select(
        "key", parts[0].cast("bigint").alias("millis"), parts[1].alias("site"), parts[2].alias("ip")
    )
    assert made.count() == 2_000
    assert checked.filter((F.col("site") != "www.example.com") | (F.col("ip") != F.col("key"))).count() == 0
    last = F.split_part("key", F.lit("."), F.lit(4)).cast("int")
    low, high, n = checked.agg(F.min(last), F.max(last), F.count_distinct("key")).first()
    assert low == 0 and high == 254 and n == 255


class FakeSession:
    """A session on a cluster, with the given settings."""

    def __init__(self, **settings):
        self.conf = self
        self.sparkContext = self
        self.master = "spark://head:7077"
        self.settings = settings

    def get(self, name, default):
        return self.settings.get(name, default)


def test_work_dir_uses_the_named_folder():
    session = FakeSession(**{"spark.checkpoint.dir": "hdfs://shared/folder/"})
    assert work_dir(session, "x").startswith("hdfs://shared/folder/x-")
    assert work_dir(session, "x") != work_dir(session, "x")


def test_work_dir_refuses_a_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(FakeSession(), "x")


def test_sizes_follow_the_data():
    small = size_settings(10 * MIB, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * MIB)
    large = size_settings(100 * 1024 * 1024 * MIB, 4_000)
    assert large["spark.sql.shuffle.partitions"] == "204800"
    assert large["spark.sql.files.maxPartitionBytes"] == str(512 * MIB)


def test_days_are_emptied_by_a_result_that_turns_out_empty_while_it_runs(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    path, known = str(tmp_path / "facts"), str(tmp_path / "known")
    spark.range(20).select("id", F.lit("2024-01-05").cast("date").alias("day")).write.parquet(known)
    rows = spark.read.parquet(known)
    tables.overwrite_days(rows, path, F.lit(True))
    assert len(tables.stored_days(spark, path)) == 1
    unknown = rows.join(spark.read.parquet(known).select("id"), "id", "left_anti").distinct()
    tables.overwrite_days(unknown, path, F.lit(True))
    assert tables.stored_days(spark, path) == []
