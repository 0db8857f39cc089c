"""Comparison of two large stores of one fact by digests of their parts.

A store lies by day and bucket of its keys, with a digest of each part: the number of its
rows and the sum of their hashes, which no order changes and which a repeated row does.
Only parts whose digests differ are read and compared key by key.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.operators.facts import reconcile

BUCKETS = 64
DIGESTS = T.StructType([
    T.StructField("day", T.DateType()), T.StructField("bucket", T.IntegerType()),
    T.StructField("n", T.LongType()), T.StructField("digest", T.DecimalType(38, 0)),
])


class Store(NamedTuple):
    """A fact stored with its digests."""

    path: str
    schema: T.StructType
    keys: list[str]
    metric: str


def part_digests(parts: DataFrame, columns: list[str]) -> DataFrame:
    """(day, bucket, n, digest) of rows that have a ``day`` and a ``bucket``."""
    # A null and its absence from the hash differ by the marks of which columns are null.
    marks = F.concat_ws("", *(F.col(name).isNull().cast("int").cast("string") for name in columns))
    row = F.xxhash64(*columns, marks).cast("decimal(38,0)")
    return parts.groupBy("day", "bucket").agg(F.count("*").alias("n"), F.sum(row).cast("decimal(38,0)").alias("digest"))


def store(df: DataFrame, path: str, keys: list[str], metric: str = "num", buckets: int = BUCKETS) -> Store:
    """Write a fact (``day`` among its keys) below ``path`` by day and bucket, with its digests."""
    others = [name for name in keys if name != "day"]
    parts = df.select(*keys, metric).withColumn("bucket", F.pmod(F.xxhash64(*others), F.lit(buckets)).cast("int"))
    dealt = parts.hint("rebalance", F.col("day"), F.col("bucket"))
    dealt.write.mode("overwrite").partitionBy("day", "bucket").parquet(f"{path}/rows")
    schema = T.StructType([*(parts.schema[name] for name in (*others, metric)), parts.schema["day"], parts.schema["bucket"]])
    written = df.sparkSession.read.schema(schema).parquet(f"{path}/rows")
    part_digests(written, [*others, metric]).write.mode("overwrite").parquet(f"{path}/digests")
    return Store(path, schema, keys, metric)


def differing_parts(spark: SparkSession, left: Store, right: Store) -> list[tuple[str, int]]:
    """(day, bucket) of the parts whose digests differ or that one store lacks.

    Days are compared first; at most one row comes back for each part that differs.
    """
    sides = [spark.read.schema(DIGESTS).parquet(f"{side.path}/digests") for side in (left, right)]

    def unlike(*level: str) -> DataFrame:
        signed = [
            side.groupBy(*level).agg(F.sum("n").alias("n"), F.sum("digest").cast("decimal(38,0)").alias("digest"))
            .withColumn("side", F.lit(k)) for k, side in enumerate(sides)
        ]
        both = signed[0].unionByName(signed[1]).groupBy(*level).agg(
            F.count("*").alias("sides"), F.count_distinct("n", "digest").alias("kinds")
        )
        return both.where("sides = 1 OR kinds > 1").select(*level)

    days = unlike("day")
    parts = unlike("day", "bucket").join(days, "day", "left_semi")
    return sorted((str(row["day"]), row["bucket"]) for row in parts.collect())


def read_parts(spark: SparkSession, side: Store, parts: list[tuple[str, int]]) -> DataFrame:
    """The rows of some parts of a store; a part that it lacks has none."""
    stored = spark.read.schema(side.schema).parquet(f"{side.path}/rows")
    by_day: dict[str, list[int]] = {}
    for day, bucket in parts:
        by_day.setdefault(day, []).append(bucket)
    wanted = F.lit(False)
    for day, buckets in by_day.items():
        wanted = wanted | ((F.col("day") == F.lit(day).cast("date")) & F.col("bucket").isin(buckets))
    return stored.where(wanted).select(*side.keys, side.metric)


def differences(spark: SparkSession, left: Store, right: Store) -> DataFrame:
    """The keys whose metric differs, as ``facts.reconcile`` gives them; reads only parts that differ."""
    parts = differing_parts(spark, left, right)
    sides = (read_parts(spark, side, parts) for side in (left, right))
    return reconcile(*sides, left.keys, left.metric).where("NOT equal")
