"""Bounded samples of whole texts to fit a model on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Of the rows that a sample is expected to take, so many times as many are ranked.
SPARE = 4
_STEPS = 1 << 40


def bounded(rows: DataFrame, group: str, most_rows: int, most_chars: int) -> DataFrame:
    """The distinct ids of each group's sample, of rows (id, ``group``, size).

    In the order of the ids' hash a group's texts are taken whole until there are
    ``most_rows`` of them or they hold ``most_chars`` characters; the one that goes beyond
    is the last, so every group has one at least, however long its texts are. Only rows
    of small hashes are ranked, whose number the group's means bound.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(_STEPS))
    placed = rows.withColumn("place", place)
    means = placed.groupBy(group).agg(
        F.count("*").alias("n"), F.avg("size").alias("mean"), F.min("place").alias("least")
    )
    # As many rows as the bounds let in if all were of the mean size.
    wanted = F.least(F.lit(float(most_rows)), F.lit(float(most_chars)) / F.greatest("mean", F.lit(1.0)) + 1)
    limit = F.greatest("least", (F.lit(float(SPARE * _STEPS)) * wanted / F.col("n")).cast("long"))
    few = placed.join(F.broadcast(means.select(group, limit.alias("limit"))), group).where("place <= limit")
    order = Window.partitionBy(group).orderBy("place", "id")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = few.select("id", F.row_number().over(order).alias("at"), before.alias("before"))
    return ranked.where((F.col("at") <= most_rows) & (F.col("before") < most_chars)).select("id").distinct()
