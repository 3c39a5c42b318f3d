"""Exact distinct counts that add up: bitmaps over numbered values, kept by day and merged to months.

A distinct count of a month is no sum of its days' counts, but the union of their sets. Here a set is a row of bitmaps: every value
has a number from a dictionary that only grows, numbers are cut into buckets of 32,768, and a bucket's bitmap is an aggregate that
every task combines before the shuffle. So raw rows are read once, and any coarser period or group is a union of small rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.aggregate import positions
from tallyloom.operators.joins import lookup, skew_join


def new_numbers(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """``value, number`` for the values of ``column`` that ``known`` (the same columns) does not have; numbers go on from 1."""
    found = values.select(F.col(column).alias("value")).where("value is not null").distinct()
    after = F.lit(0).cast("bigint")
    if known is not None:
        found = found.join(known.select("value"), "value", "left_anti")
        after = F.coalesce(known.agg(F.max("number")).scalar(), after)
    return positions(found, ["value"], "number").select("value", (F.col("number") + 1 + after).alias("number"))


def distinct_bitmaps(rows: DataFrame, keys: Sequence[str], dictionaries: Mapping[str, DataFrame]) -> DataFrame:
    """The sets of values per group, one row per ``keys``, ``measure`` (the column) and ``bucket``, with its ``bitmap``.

    ``dictionaries`` has ``value, number`` for each column. Null values are in no set. A value without a number is an error.
    """
    parts = []
    for column, numbers in dictionaries.items():
        asked = rows.where(F.col(column).isNotNull()).select(*keys, F.col(column).alias("value"))
        # A value may be in a third of the rows, but once per group is enough.
        met = lookup(asked.distinct(), numbers.select("value", "number"), "value")
        number = F.coalesce("number", F.raise_error(F.concat(F.lit(f"no number for {column} "), F.col("value").cast("string"))).cast("bigint"))
        numbered = met.select(*keys, number.alias("number"))
        bits = numbered.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
        parts.append(bits.select(*keys, F.lit(column).alias("measure"), "bucket", "bitmap"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The union of the sets over all groups that agree in ``keys``."""
    return bitmaps.groupBy(*keys, "measure", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counts_of_bitmaps(bitmaps: DataFrame, keys: Sequence[str], counts: Mapping[str, str]) -> DataFrame:
    """Distinct counts per ``keys``; ``counts`` maps the output name to the column. Merges first, so the sets may overlap."""
    sizes = merge_bitmaps(bitmaps, keys).select(*keys, "measure", F.bitmap_count("bitmap").alias("n"))
    return sizes.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col("measure") == column, F.col("n"))), F.lit(0)).cast("bigint").alias(out) for out, column in counts.items()])


def with_row_counts(counts: DataFrame, row_counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct counts beside plain ones, which add up by themselves; a group without any value has distinct counts of 0."""
    met = skew_join(row_counts, counts, keys, "left")
    return met.fillna(0, subset=[c for c in counts.columns if c not in keys])
