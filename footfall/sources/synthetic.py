"""Made-up site visits for trying out a topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the made-up visits.
SITE = "www.example.com"
NETWORK = "192.168.2."
HOSTS = 255


def _visit(millis: Column, seed: int) -> list[Column]:
    ip = F.concat(F.lit(NETWORK), F.floor(F.rand(seed) * HOSTS).cast("string"))
    return [ip.alias("key"), millis.cast("string").alias("millis")]


def _messages(visits: DataFrame) -> DataFrame:
    return visits.select("key", F.concat_ws(",", "millis", F.lit(SITE), "key").alias("value"))


def synthetic_events(spark: SparkSession, n: int = 10_000, seed: int = 42) -> DataFrame:
    """``n`` messages ``millis,site,ip`` with the ip as key."""
    now = F.unix_millis(F.current_timestamp())
    return _messages(spark.range(n).select(*_visit(now, seed)))


def synthetic_stream(spark: SparkSession, per_second: int = 100, seed: int = 42) -> DataFrame:
    """The same messages as a stream."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return _messages(ticks.select(*_visit(F.unix_millis("timestamp"), seed)))
