"""Pages of a stored result by their number.

A result is numbered once and written in ranges of positions, so any page lies in one
range or two neighbouring ones and reads their files only, however deep it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.operators.search import with_positions

RANGE_ROWS = 100_000


def store_positions(df: DataFrame, order_by: Sequence[str | Column], path: str, range_rows: int = RANGE_ROWS) -> T.StructType:
    """Number the rows of ``df`` in the order ``order_by`` and write them below ``path``; returns what to read.

    ``order_by`` should end in a unique key. A range is one file, sorted by position.
    """
    numbered = with_positions(df, order_by).withColumn("range", F.expr(f"position div {range_rows}"))
    dealt = numbered.repartition("range").sortWithinPartitions("range", "position")
    dealt.write.mode("overwrite").partitionBy("range").parquet(path)
    return T.StructType([*numbered.drop("range").schema, T.StructField("range", T.LongType())])


def stored_page(
    spark: SparkSession, path: str, schema: T.StructType, number: int, size: int = 10, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Page ``number`` (from 0) of ``size`` rows of a stored result, in its order."""
    if number < 0 or size < 1:
        raise ValueError("pages count from 0 and hold a row or more")
    first, last = number * size, number * size + size - 1
    stored = spark.read.schema(schema).parquet(path)
    wanted = F.col("range").between(first // range_rows, last // range_rows) & F.col("position").between(first, last)
    return stored.where(wanted).drop("range").orderBy("position")
