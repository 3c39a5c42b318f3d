"""Exact order statistics of a column of any length, found by counting ranges that narrow: no task and no driver holds the column."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranges that one counting pass tells apart, and so the rows that it returns at most.
FAN_OUT = 4096


def nth_smallest(values: DataFrame, name: str, n: int) -> float:
    """The value at place ``n`` (from 0) of the sorted column of doubles, which holds neither nulls nor NaN and more than ``n`` rows.

    Every pass reads the column again, so it should be settled. The smallest and largest value of a range fall into different
    ranges of the next pass, so each pass leaves fewer values.
    """
    low, high = values.agg(F.min(name), F.max(name)).first()
    while low < high:
        part = F.floor((F.col(name) - F.lit(low)) / F.lit(high - low) * FAN_OUT)
        inside = values.where(F.col(name).between(low, high)).groupBy(F.least(part, F.lit(FAN_OUT - 1)).alias("part"))
        for r in inside.agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("low"), F.max(name).alias("high")).orderBy("part").collect():
            if n < r["n"]:
                low, high = r["low"], r["high"]
                break
            n -= r["n"]
    return low


def quantile(values: DataFrame, name: str, share: float) -> float | None:
    """What ``percentile`` returns, which would hold all distinct values in one task; None without rows."""
    rows = values.count()
    if not rows:
        return None
    place = (rows - 1) * share
    below, above = math.floor(place), math.ceil(place)
    low = nth_smallest(values, name, below)
    high = low if above == below else nth_smallest(values, name, above)
    return low if low == high else (above - place) * low + (place - below) * high
