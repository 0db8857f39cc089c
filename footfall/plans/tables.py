"""The given tables as behaviour events and articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.text import BROWSE, PUBLISH

# Known schemas, so that opening a table does not start a job to read footers.
_KINDS = {
    "bigint": T.LongType(), "string": T.StringType(), "double": T.DoubleType(),
    "time": T.TimestampNTZType(),
}
_TABLES = {
    "events": {
        "event_id": "bigint", "ts": "time", "user_id": "bigint",
        "event_type": "string", "value": "double", "props": "string",
    },
    "documents": {
        "doc_id": "bigint", "text": "string", "lang": "string",
        "source": "string", "n_chars": "bigint",
    },
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
        "o_totalprice": "double", "o_orderdate": "time", "o_orderpriority": "string",
    },
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    fields = [T.StructField(field, _KINDS[kind]) for field, kind in _TABLES[name].items()]
    return spark.read.schema(T.StructType(fields)).parquet(f"{sf_dir}/{name}.parquet")


def behavior_code(event_type: str) -> Column:
    """purchase is a publish, view a browse, everything else a comment."""
    kind = F.col(event_type)
    return F.when(kind == "purchase", PUBLISH).when(kind == "view", BROWSE).otherwise("2")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without their article, for queries that do not ask for it."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), "ts", "user_id", behavior_code("event_type").alias("behavior")
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the article their JSON names.

    ``json_tuple`` reads each JSON text once; a plain expression would be worked
    out again in the null filter of a join on it.
    """
    named = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        "ts",
        "user_id",
        behavior_code("event_type").alias("behavior"),
        F.json_tuple("props", "k").alias("k"),
    )
    return named.select(
        "seq", "ts", "user_id", F.col("k").cast("bigint").alias("article_id"), "behavior"
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles; their source is the domain."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("article_id"), F.col("source").alias("domain"), "lang"
    )
