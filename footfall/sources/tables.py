"""Tables, files and databases to read facts from and write them to."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.schemas import ARTICLES, DAY
from footfall.session import work_dir

_DAY_ONLY = T.StructType([T.StructField("day", DAY)])


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` known to SQL as ``name``."""
    df.createOrReplaceTempView(name)
    return df


def as_articles(df: DataFrame) -> DataFrame:
    """An article table of any column names, by position, as the dimension."""
    return df.toDF(*ARTICLES.names)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def append_table(df: DataFrame, name: str, **options: str) -> None:
    """Append by column name, creating the table by day if it is missing.

    Running an append again doubles its rows; ``overwrite_days`` and
    ``overwrite_table_days`` do not.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        _by_day(df).select(*spark.table(name).columns).write.insertInto(name)
        return
    writer = _by_day(df).write.format("parquet").options(**options)
    if "day" in df.columns:
        writer = writer.partitionBy("day")
    writer.saveAsTable(name)


def overwrite_table_days(df: DataFrame, name: str, **options: str) -> None:
    """Replace the days that ``df`` holds in a table of the catalog, made if it is missing."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        append_table(df, name, **options)
        return
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        _by_day(df).select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def overwrite_days(df: DataFrame, path: str, covered: Column | None = None) -> None:
    """Write ``df`` below ``path`` by day, replacing the days it holds.

    ``covered`` is a condition on ``day`` that says which days were worked out anew:
    stored days among them that have no rows any more are removed.
    """
    seen = Observation()
    (
        # Observed after the exchange: before it, the metrics go when adaptive execution finds no rows.
        _by_day(df).observe(seen, F.collect_set("day").alias("days"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )
    if covered is not None:
        spark, present = df.sparkSession, set(seen.get["days"])
        left = [(day,) for day in stored_days(spark, path) if day not in present]
        stale = spark.createDataFrame(left, _DAY_ONLY).where(covered).collect()
        drop_folders(spark, [f"{path}/day={row['day']}" for row in stale])


def stored_days(spark: SparkSession, path: str) -> list[dt.date]:
    """The days that have a folder below ``path``."""
    folder, files = _folder(spark, path)
    names = [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []
    days = [name.removeprefix("day=") for name in names if name.startswith("day=")]
    return sorted(dt.date.fromisoformat(day) for day in days if day[:1].isdigit())


def stored_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The files below ``path``; no rows if nothing is stored there yet."""
    folder, files = _folder(spark, path)
    if files.exists(folder):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def _folder(spark: SparkSession, path: str) -> tuple:
    """A path and its file system, as Hadoop knows them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, the same however it is written."""
    folder, files = _folder(spark, path)
    return files.makeQualified(folder).toString()


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def drop_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove folders of any file system that Spark knows."""
    for path in paths:
        folder, files = _folder(spark, path)
        files.delete(folder, True)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Remove a folder when the application ends."""
    folder, files = _folder(spark, path)
    files.deleteOnExit(folder)


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``df`` written below the work folder and read again, until the application ends.

    What follows starts from files that all executors share, so a lost executor costs
    no more than its own running tasks.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.options(**options).parquet(path)
    remove_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def repartition_for_sink(df: DataFrame, n: int) -> DataFrame:
    """Spread rows evenly over ``n`` writers."""
    return df.repartition(n)


def write_report(df: DataFrame, folder: str, name: str, fmt: str = "json") -> str:
    """Write one report below ``folder`` and return where."""
    path = f"{folder.rstrip('/')}/{name}"
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def jdbc_read_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split: tuple[str, int | str, int | str, int] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read; ``split`` is (column, lowest, highest, parts).

    Without ``split`` the table comes through one connection and one task, which
    suits a small dimension only. Rows outside the bounds are still read.
    """
    options = dict(properties or {}) | {"url": url, "dbtable": table}
    if split:
        column, low, high, parts = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split: tuple[str, int | str, int | str, int] | None = None,
) -> DataFrame:
    options = jdbc_read_options(url, table, properties, split)
    return spark.read.format("jdbc").options(**options).load()


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    connections: int = 3,
    batch_rows: int = 10_000,
) -> None:
    """Append over ``connections`` connections, in batches of rows.

    Rows are dealt to the connections in a shuffle of their own, so what makes them
    still runs in as many tasks as it needs.
    """
    options = jdbc_read_options(url, table, properties) | {
        "numPartitions": str(connections),
        "batchsize": str(batch_rows),
    }
    df.repartition(connections).write.format("jdbc").options(**options).mode("append").save()


def _by_day(df: DataFrame) -> DataFrame:
    """Bring the rows of a day together for writing.

    Rebalancing merges small days into few files and splits a large day over
    several tasks, by measured size.
    """
    return df.hint("rebalance", F.col("day")) if "day" in df.columns else df
