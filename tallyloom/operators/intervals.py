"""Calendars of consecutive intervals, and the assignment of instants to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.aggregate import positions
from tallyloom.operators.joins import MAX_BROADCAST_BYTES, fits_broadcast, lookup
from tallyloom.session import settle

BEFORE_ALL = "0001-01-01"


def build_intervals(
    calendar: DataFrame,
    boundary: str,
    name: str,
    first_start: Column | None = None,
    numbered: bool = True,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Consecutive intervals ending at each boundary: ``ordinal, label, start, end, is_last``.

    An interval starts where the previous one ends. The first starts at ``first_start``, or is open. ``numbered`` labels
    carry the ordinal in front, padded to two digits.
    """
    rows = calendar.select(F.col(boundary).alias("end"), F.col(name).alias("_name")).where(F.col("end").isNotNull())
    rows = settle(rows)  # a calendar is read several times from here on, and may have been derived from a large table
    few = fits_broadcast(rows, max_bytes)
    placed = positions(rows, ["end", "_name"], "ordinal", few)
    if few:
        whole = Window.orderBy("ordinal")
        placed = placed.withColumns({
            "start": F.lag("end").over(whole), "is_last": F.lead("end").over(whole).isNull(),
        })
    else:
        ends = placed.select((F.col("ordinal") + 1).alias("ordinal"), F.col("end").alias("start"))
        placed = placed.join(ends, "ordinal", "left")
        placed = placed.withColumn("is_last", F.col("ordinal") == placed.agg(F.max("ordinal")).scalar())
    if first_start is not None:
        placed = placed.withColumn("start", F.when(F.col("ordinal") == 0, first_start).otherwise(F.col("start")))
    label = F.concat(F.format_string("%02d ", "ordinal"), F.col("_name")) if numbered else F.col("_name")
    return placed.select("ordinal", label.alias("label"), "start", "end", "is_last")


def assign_interval(
    facts: DataFrame,
    intervals: DataFrame,
    time: str,
    out: str,
    closed: bool = False,
    carry: Sequence[str] = (),
    max_bytes: int = MAX_BROADCAST_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Add to each fact the label of the interval its instant falls in; null before the first and after the last.

    Half-open: ``start <= t < end``. Closed: ``start <= t <= end``, where a shared boundary goes to the later interval,
    so that only the end of the last interval is really closed. Either way one interval at most holds, and facts are
    neither multiplied nor de-duplicated afterwards.

    Facts and intervals meet on the day, not in a product of both: every interval is listed under each of its days. An
    open first interval is listed once, under a day before all others.
    """
    listed = _by_day(intervals).select(
        "_listed_day", F.col("start").alias("_start"), F.col("end").alias("_end"), F.col("is_last").alias("_last"),
        F.col("label").alias(out), *[F.col(c).alias(f"{out}_{c}") for c in carry],
    )
    # The day the calendar's first bounded stretch begins: anything earlier meets the open interval.
    opening = intervals.agg(F.min(F.when(F.col("start").isNull(), F.to_date("end")))).scalar()
    fact_day = F.to_date(time)
    keyed = facts.withColumn("_day", F.when(fact_day < opening, F.lit(BEFORE_ALL).cast("date")).otherwise(fact_day))
    at = F.col(time)
    after_start = F.col("_start").isNull() | (at >= F.col("_start"))
    before_end = (at < F.col("_end")) | (F.col("_last") & (at == F.col("_end"))) if closed else at < F.col("_end")
    # A join on the day, with the exact bounds as a further condition of the same join.
    matched = lookup(
        keyed, listed, (F.col("_day") == F.col("_listed_day")) & after_start & before_end, "left", max_bytes, small
    )
    return matched.select(*[F.col(c) for c in facts.columns], out, *[f"{out}_{c}" for c in carry])


def listing_fits(intervals: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the intervals, listed by day, may be broadcast: for several assignments to the same calendar."""
    return fits_broadcast(_by_day(intervals), max_bytes)


def _by_day(intervals: DataFrame) -> DataFrame:
    """Every interval once per day it touches; an open first interval once, and once more on its last day."""
    within = F.sequence(F.to_date("start"), F.to_date("end"))
    opening = F.array(F.lit(BEFORE_ALL).cast("date"), F.to_date("end"))
    days = F.when(F.col("start").isNull(), opening).otherwise(within)
    return intervals.withColumn("_listed_day", F.explode(days))
