"""Intervals that nest and cross, the last one of the list wins: disjoint segments, and the assignment of instants to them.

The ends of all intervals cut time into elementary segments, numbered in order. An interval covers a run of segments, which is the
sum of a few aligned blocks of 1, 2, 4, ... segments, two of each size at most. The last interval of every block is an
aggregate, and the last one of a segment is that of the blocks it lies in, one of each size. So a sweep over n ends is an
aggregation of n log n rows: no interval is ever listed under each segment it covers, and no task holds the open intervals of all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.aggregate import positions
from tallyloom.operators.joins import MAX_BROADCAST_BYTES, fits_broadcast, lookup
from tallyloom.session import settle

DAY = 86_400_000_000


def _shift(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def _blocks(first: str, beyond: str) -> Column:
    """The aligned blocks whose sum is the run of numbers from ``first`` up to before ``beyond``: structs (size, block)."""
    run = F.col(beyond) - F.col(first)
    sizes = F.when(run > 0, F.sequence(F.lit(0), F.floor(F.log2(run.cast("double"))).cast("int"))).otherwise(F.array().cast("array<int>"))

    def of_size(size: Column) -> Column:
        low, high = -_shift(-F.col(first), size), _shift(F.col(beyond), size)
        edge = lambda block, odd: F.when((low < high) & (odd % 2 == 1), F.struct(size.alias("size"), block.alias("block")))
        return F.array(edge(low, low), edge(high - 1, high))

    return F.filter(F.flatten(F.transform(sizes, of_size)), lambda b: b.isNotNull())


def winning_segments(
    intervals: DataFrame,
    order: Sequence[str],
    start: str = "start",
    end: str = "end",
    carry: Sequence[str] = ("label",),
    closed: bool = False,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Disjoint half-open segments ``start, end`` with the ``carry`` columns of the interval that is last by ``order`` there.

    A null start or end is open. Closed intervals hold at their end too, which for timestamps is until a microsecond later.
    Segments that no interval covers are left out, as are intervals that end before they start. Intervals equal in ``order``
    are told apart by their ``carry`` columns, the largest wins.
    """
    until = F.col(end) + F.expr("INTERVAL '0.000001' SECOND") if closed else F.col(end)
    given = intervals.select(
        F.col(start).alias("_start"), until.alias("_end"),
        F.struct(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)]).alias("by"),
                 F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]).alias("own")).alias("_own"),
    ).where("_start is null or _end is null or _start < _end")
    # Of equal intervals one can win at most.
    given = settle(given.groupBy("_start", "_end").agg(F.max("_own").alias("_own")))
    cuts = given.select(F.explode(F.array("_start", "_end")).alias("_at")).where("_at is not null").distinct()
    cuts = settle(positions(cuts, ["_at"], "_segment", fits_broadcast(given, max_bytes)).withColumn("_segment", F.col("_segment") + 1))
    count = F.coalesce(cuts.agg(F.max("_segment")).scalar(), F.lit(0).cast("bigint"))

    def numbered(rows: DataFrame, at: str, out: str, otherwise: Column) -> DataFrame:
        met = lookup(rows, cuts.select(F.col("_at").alias(at), F.col("_segment").alias(out)), at, max_bytes=max_bytes)
        return met.withColumn(out, F.coalesce(out, otherwise))

    placed = numbered(given, "_start", "_first", F.lit(0).cast("bigint"))
    placed = numbered(placed, "_end", "_beyond", count + 1)
    blocks = placed.select("_own", F.inline(_blocks("_first", "_beyond"))).groupBy("size", "block").agg(F.max("_own").alias("_own"))
    blocks = settle(blocks)

    begins = cuts.select("_segment", F.col("_at").alias("_from"))
    before_all = cuts.sparkSession.range(1).select(F.col("id").alias("_segment"), F.lit(None).cast(cuts.schema["_at"].dataType).alias("_from"))
    ends = cuts.select((F.col("_segment") - 1).alias("_segment"), F.col("_at").alias("_to"))
    segments = begins.unionByName(before_all).join(ends, "_segment", "left")
    largest = F.coalesce(blocks.agg(F.max("size")).scalar(), F.lit(0))
    inside = segments.withColumn("size", F.explode(F.sequence(F.lit(0), largest)))
    inside = inside.withColumn("block", _shift(F.col("_segment"), F.col("size")))
    won = lookup(inside, blocks, ["size", "block"], "inner", max_bytes).groupBy("_segment", "_from", "_to").agg(F.max("_own").alias("_own"))
    return won.select(F.col("_from").alias("start"), F.col("_to").alias("end"), *[F.col(f"_own.own.c{i}").alias(c) for i, c in enumerate(carry)])


def assign_latest(
    facts: DataFrame,
    intervals: DataFrame,
    time: str,
    order: Sequence[str],
    carry: Sequence[str] = ("label",),
    start: str = "start",
    end: str = "end",
    closed: bool = False,
    width: int = DAY,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add to each fact the ``carry`` columns of the last interval its instant falls in, null without any: one row per fact.

    Starts of segments and facts are sorted together, dealt into ranges of near equal size: a fact meets the segment that began last, in
    its own range or in one before it. So the work is a sort, however many facts and segments share a day or an instant. ``width``
    is left for callers; nothing depends on it.
    """
    segments = settle(winning_segments(intervals, order, start, end, carry, closed, max_bytes))
    segment = F.struct(F.col("start").alias("from"), F.col("end").alias("to"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    fact = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(facts.columns)])
    plain = [f.name for f in facts.schema if isinstance(f.dataType, T.AtomicType)]
    begun = segments.select(F.col("start").alias("_at"), F.lit(0).alias("_turn"), F.lit(0).cast("bigint").alias("_spread"), segment.alias("_segment"))
    asked = facts.select(F.col(time).alias("_at"), F.lit(1).alias("_turn"), F.xxhash64(F.lit(0), *plain).alias("_spread"), fact.alias("_fact"))
    # Equal instants may fill several ranges; nulls, of an open start too, come first.
    ranged = begun.unionByName(asked, allowMissingColumns=True).repartitionByRange("_at", "_turn", "_spread")
    ranged = settle(ranged.withColumn("_range", F.spark_partition_id()))
    latest = ranged.groupBy("_range").agg(F.max("_segment").alias("_latest"))  # one row per range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = latest.select("_range", F.max("_latest").over(before).alias("_earlier"))
    within = Window.partitionBy("_range").orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = ranged.withColumn("_own", F.last("_segment", ignorenulls=True).over(within)).where("_turn = 1")
    met = met.join(F.broadcast(earlier), "_range").withColumn("_met", F.coalesce("_own", "_earlier"))
    at, until = F.col("_at"), F.col("_met.to")
    holds = at.isNotNull() & (until.isNull() | (at < until))
    return met.select(
        *[F.col(f"_fact.c{i}").alias(c) for i, c in enumerate(facts.columns)],
        *[F.when(holds, F.col(f"_met.c{i}")).alias(c) for i, c in enumerate(carry)])
