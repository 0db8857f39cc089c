"""Tables that cut a job into recoverable steps."""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall.sources import tables


def written(df: DataFrame, name: str, compression: str = "zstd", **options: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again."""
    return tables.written(df, name, compression=compression, **options)
