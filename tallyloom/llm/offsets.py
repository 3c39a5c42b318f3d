"""Running totals over a numbered list of parts, without one task that sees all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Parts that one group of the first level holds.
GROUP = 1024
#: Rows of two numbers each, some 100 MB at most.
BROADCAST_PARTS = 2_000_000


def running_offsets(totals: DataFrame, part: str, total: str, offset: str) -> DataFrame:
    """``part`` and ``offset``: the sum of ``total`` over all smaller parts.

    Two levels: sums inside groups of ``GROUP`` parts, then over the groups, a thousandth of the rows.
    """
    grouped = totals.select(part, total, F.floor(F.col(part) / GROUP).alias("__g"))
    groups = grouped.groupBy("__g").agg(F.sum(total).alias("__t"))
    before = groups.select("__g", (F.sum("__t").over(Window.orderBy("__g")) - F.col("__t")).alias("__before"))
    inside = Window.partitionBy("__g").orderBy(part)
    within = grouped.withColumn("__inside", F.sum(total).over(inside) - F.col(total))
    return within.join(before, "__g").select(part, (F.col("__before") + F.col("__inside")).cast("long").alias(offset))


def join_offsets(rows: DataFrame, offsets: DataFrame, part: str, parts: int) -> DataFrame:
    """``rows`` with the offset of their part; ``parts`` is how many there are, and decides whether they are broadcast."""
    return rows.join(F.broadcast(offsets) if parts <= BROADCAST_PARTS else offsets, part)
