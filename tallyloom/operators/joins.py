"""Joins that stay even when one key holds a large part of the rows.

Rules followed here:

* a reference table is broadcast only if Catalyst's estimate of its bytes is within a bound; beyond the bound the same join
  runs shuffled, and adaptive execution splits its oversized partitions, or broadcasts what has turned out small;
* adaptive execution splits a join only where both sides were shuffled for that very join. A side that was just
  aggregated by the join key is not shuffled again, so ``skew_join`` gives both sides a second, equivalent key;
* adaptive execution can split only the preserved side of an outer join, and no side of a full outer join. Where the
  other side may have a hot key, ``left_fan_out`` and ``full_outer`` are written with joins that can be split. Its estimated
  size decides which way is taken; both ways give every row, and choosing runs no job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# By estimate, which goes by compressed files; what turns out small only at run time is left to adaptive execution.
MAX_BROADCAST_BYTES = 8 * 1024 * 1024
HOT_BYTES = 256 * 1024 * 1024

Keys = str | Sequence[str]


def _names(on: Keys) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a frame's size, from file sizes and the plan. Asking runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the estimate is within the bound. Estimates of joined frames are far too high, never too low by much."""
    return estimated_bytes(df) <= max_bytes


def lookup(
    facts: DataFrame, reference: DataFrame, on: Keys | Column, how: str = "left", max_bytes: int = MAX_BROADCAST_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Join facts to a reference table (rules, lists, catalogues): without moving the facts if the table is small.

    ``small`` is the answer of ``fits_broadcast``, for a caller that has asked already.
    """
    if fits_broadcast(reference, max_bytes) if small is None else small:
        return facts.join(F.broadcast(reference), on if isinstance(on, Column) else _names(on), how)
    return facts.join(reference, on, how) if isinstance(on, Column) else skew_join(facts, reference, on, how)


MEET = "_meet"
#: What the replaced keys of ``spread_nulls`` begin with.
NULL_KEY = "\u0000null-"


def skew_join(left: DataFrame, right: DataFrame, on: Keys, how: str = "inner") -> DataFrame:
    """Inner, left, semi or anti join (USING) whose hot keys adaptive execution can split.

    Both sides carry a hash of the key as one more join key. It never changes a match, but neither side is already
    partitioned by the longer key, so both are shuffled for this join and their partition sizes are known to it.
    """
    names = _names(on)
    meet = F.xxhash64(*names)
    joined = left.withColumn(MEET, meet).join(right.withColumn(MEET, meet), [MEET, *names], how)
    return joined.drop(MEET)


def spread_nulls(key: Column | str, *seed: Column | str, salts: int = 1024) -> Column:
    """A join key whose nulls are replaced by values that match nothing and differ between rows.

    Without it a left join sends every row with a null key to one task.
    """
    key = F.col(key) if isinstance(key, str) else key
    salt = F.pmod(F.xxhash64(*seed), F.lit(salts)).cast("string")
    return F.coalesce(key.cast("string"), F.concat(F.lit(NULL_KEY), salt))


def may_have_hot_key(df: DataFrame, hot_bytes: int = HOT_BYTES) -> bool:
    """Whether the rows of one key can be too many for a task: no key has more bytes than the whole frame."""
    return estimated_bytes(df) >= hot_bytes


def left_fan_out(
    parents: DataFrame, children: DataFrame, on: Keys, child_keys: DataFrame | None = None, hot: bool | None = None,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """Left join of parents to many children, where one parent may own a large part of the children.

    Where a parent may be hot it is the inner join, of which either side can be split, plus the childless parents.
    ``child_keys`` may name a cheaper frame with the same set of keys as ``children``; ``hot`` is given where it is known.
    """
    names = _names(on)
    keys = (children if child_keys is None else child_keys).select(*names)
    if hot is None:
        hot = may_have_hot_key(keys, hot_bytes)
    if not hot:
        return parents.join(children, names, "left")
    matched = skew_join(parents, children, names, "inner")
    childless = parents.join(keys.distinct(), names, "left_anti")
    return matched.unionByName(childless, allowMissingColumns=True)


def _all_present(names: Sequence[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(n).isNotNull()
    return out


def full_outer(
    left: DataFrame, right: DataFrame, on: Keys, left_keys: DataFrame | None = None,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """Full outer join (USING) of many rows to a side with few rows per key.

    Where the left may have a hot key, the keys only the right has are first added to the left as empty rows; a left join, of
    which the left can be split, then finds every partner. ``left_keys`` may name a cheaper frame with the same set of
    keys as ``left``.
    """
    names = _names(on)
    keys = (left if left_keys is None else left_keys).select(*names)
    if not may_have_hot_key(keys, hot_bytes):
        return left.join(right, names, "full_outer")
    orphans = right.select(*names).where(_all_present(names)).distinct().join(keys.distinct(), names, "left_anti")
    matched = skew_join(left.unionByName(orphans, allowMissingColumns=True), right, names, "left")
    unkeyed = right.where(~_all_present(names))  # a null matches nothing
    return matched.unionByName(unkeyed, allowMissingColumns=True)


def split_by_match(rows: DataFrame, other: DataFrame, on: Keys) -> tuple[DataFrame, DataFrame]:
    """(rows joined to their matches, rows without a match): together they hold every row."""
    names = _names(on)
    return (
        skew_join(rows, other, names, "inner"),
        skew_join(rows, other.select(*names).distinct(), names, "left_anti"),
    )
