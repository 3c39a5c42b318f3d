"""Aggregations. Every one combines on the map side first, so a hot key reaches its reducer as one row per task."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.columns import share_pct
from tallyloom.operators.joins import fits_broadcast, skew_join
from tallyloom.session import settle


def count_by(df: DataFrame, keys: Sequence[str], name: str = "event_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, str | Column], empty: float | None = None
) -> DataFrame:
    """Named sums; ``measures`` maps the output name to a column or an expression. ``empty`` replaces a sum of nothing."""
    def summed(m: str | Column) -> Column:
        return F.sum(m) if empty is None else F.coalesce(F.sum(m), F.lit(empty))

    return df.groupBy(*keys).agg(*[summed(m).alias(out) for out, m in measures.items()])


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def sum_all(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of every numeric column that is not a key; names are kept."""
    return sum_by(df, keys, {c: c for c in numeric_columns(df, keys)})


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], rows: str | None = None) -> DataFrame:
    """Exact distinct counts per group. Values are de-duplicated per (group, value) before the group is formed."""
    aggs = [F.count_distinct(F.col(c)).alias(out) for out, c in columns.items()]
    if rows:
        aggs.append(F.count(F.lit(1)).alias(rows))
    return df.groupBy(*keys).agg(*aggs)


def pivot_first(df: DataFrame, ident: str, key: str, value: str, keys: Sequence[str]) -> DataFrame:
    """Key/value rows to one row per ``ident``.

    The keys are given, so no job has to discover them. When a key has several values the smallest is taken, which
    does not depend on arrival order and makes a prior ``distinct`` unnecessary.
    """
    return df.groupBy(ident).agg(*[F.min(F.when(F.col(key) == k, F.col(value))).alias(k) for k in keys])


def pivot_sum(
    df: DataFrame, ident: str, key: str, value: str | Column, keys: Sequence[str], space: str = "_"
) -> DataFrame:
    """Sum ``value`` per (ident, key) into one column per key; spaces in the key become ``space``."""
    value = F.col(value) if isinstance(value, str) else value
    return df.groupBy(ident).agg(
        *[F.sum(F.when(F.col(key) == k, value)).alias(k.replace(" ", space)) for k in keys]
    )


def delimited_values(
    df: DataFrame, key: str | Sequence[str], value: str, out: str, separator: str = ":"
) -> DataFrame:
    """The distinct values per key, sorted and joined to one text. A key without any value has no row.

    Duplicates collapse in each task before the shuffle, so a reducer sees the label domain, not the rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    labels = F.concat_ws(separator, F.array_sort(F.collect_set(value)))
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(labels.alias(out))


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row with the greatest ``order`` per key.

    An aggregate rather than ``row_number``: each task keeps one candidate per key, so no group is ever sorted whole.
    """
    return _pick(df, keys, order, F.max)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, order, F.min)


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], best) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in [*order, *rest]])
    picked = df.groupBy(*keys).agg(best(packed).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def share_of_total(df: DataFrame, keys: Sequence[str], measure: str, total: str, share: str | None = None) -> DataFrame:
    """Add the group total, and optionally the percentage of it.

    The total is an aggregate joined back. A window would put each whole group through one task.
    """
    totals = df.groupBy(*keys).agg(F.sum(measure).alias(total))
    out = skew_join(df, totals, keys, "left")
    return out.withColumn(share, share_pct(measure, total)) if share else out


def totals(df: DataFrame, measures: Mapping[str, str | Column]) -> DataFrame:
    """Global sums as one row; use ``.scalar()`` on a single measure to feed it into an expression."""
    return df.agg(*[F.sum(m).alias(out) for out, m in measures.items()])


def row_quality(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and distinct rows in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.struct(*[F.col(c) for c in (columns or df.columns)])).alias("distinct_rows"),
    )


def sum_by_unit(df: DataFrame, keys: Sequence[str], unit: str, amount: str, units: Mapping[str, str]) -> DataFrame:
    """One sum per unit of measure, 0 without any; ``units`` maps the output name to the unit."""
    return sum_by(df, keys, {out: F.when(F.col(unit) == u, F.col(amount)) for out, u in units.items()}, empty=0.0)


def top_unmapped(
    df: DataFrame, mapped: str, keys: Sequence[str], measure: str, limit: int | None = None
) -> DataFrame:
    """What the rules missed, the most expensive first."""
    out = sum_by(df.where(F.col(mapped).isNull()), keys, {measure: measure}).orderBy(F.desc(measure), *keys)
    return out.limit(limit) if limit else out


def unmatched_share(df: DataFrame, columns: Sequence[str], missing: str) -> DataFrame:
    """How much the rules missed: per column, rows, rows without an answer (null or ``missing``) and their share."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("answer")) for c in columns]))
    asked = df.select(pairs.alias("p")).select("p.column", "p.answer")
    unmatched = F.count(F.when(F.coalesce(F.col("answer"), F.lit(missing)) == missing, 1))
    out = asked.groupBy("column").agg(F.count(F.lit(1)).alias("rows"), unmatched.alias("unmatched"))
    return out.withColumn("share", share_pct("unmatched", "rows"))


def positions(df: DataFrame, order: Sequence[str], out: str = "position", few: bool | None = None) -> DataFrame:
    """Number the rows of a whole table from 0 in ``order``.

    A table measured to have few rows goes through one window. A larger one is range-partitioned: rows are numbered
    inside each range, and the start of each range comes from the row counts of the ranges before it.
    """
    if fits_broadcast(df) if few is None else few:
        return df.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint") - 1)
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    numbered = settle(ranged.withColumn("_id", F.monotonically_increasing_id()))
    numbered = numbered.withColumns(
        {"_range": F.shiftright("_id", 33), "_local": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    sizes = numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # one row per range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        numbered.join(F.broadcast(starts), "_range")
        .withColumn(out, F.col("_start") + F.col("_local"))
        .drop("_id", "_range", "_local", "_start")
    )
