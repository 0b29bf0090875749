"""Order over a whole table without a task that sees all of it: ids fall into buckets, buckets into levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Buckets that one window orders.
LEVEL_BITS = 10


def sort_id(doc_id: str) -> Column:
    """The id as a long; null sorts before all others."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))


def previous(buckets: DataFrame) -> DataFrame:
    """``buckets`` (column ``bucket``, distinct) with ``to``: the bucket before; before the first comes the last."""
    levels = buckets.withColumn("over", F.shiftright("bucket", LEVEL_BITS))
    within = levels.withColumn("to", F.lag("bucket").over(Window.partitionBy("over").orderBy("bucket")))
    last = levels.groupBy("over").agg(F.max("bucket").alias("last"))
    ends = last.withColumn("before", F.lag("last").over(Window.orderBy("over"))).withColumn("final", F.max("last").over(Window.partitionBy()))
    return within.join(ends, "over").withColumn("to", F.coalesce("to", "before", "final")).drop("over", "last", "before", "final")


def sum_before(buckets: DataFrame, value: str, order: list[str], out: str) -> DataFrame:
    """``buckets`` with the sum of ``value`` over all buckets that come before in ``order``, the first of which is a long."""
    levels = buckets.withColumn("over", F.shiftright(order[0], LEVEL_BITS))
    within = F.sum(value).over(Window.partitionBy("over").orderBy(*order)) - F.col(value)
    sums = levels.groupBy("over").agg(F.sum(value).alias("level_sum"))
    starts = sums.select("over", (F.sum("level_sum").over(Window.orderBy("over")) - F.col("level_sum")).alias("level_start"))
    return levels.withColumn("within", within).join(starts, "over").withColumn(out, F.col("level_start") + F.col("within")).drop("over", "within", "level_start")
