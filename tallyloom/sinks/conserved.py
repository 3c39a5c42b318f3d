"""Writing an allocation with proof that its pool was handed out: what goes in and what comes out is summed in the write itself.

Pool and allocation are observed while the job runs, so the check costs no pass of its own. Sums that differ are not believed at
once, since a task that ran again after a lost executor may have been counted twice: the written rows are then read back and
compared with the pool group by group. Only what differs there is reported, and by which group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.operators.aggregate import sum_by
from tallyloom.operators.joins import full_outer

#: Relative difference that rounding may leave; sums of doubles depend on the order of their rows.
TOLERANCE = 1e-9


class Conservation(NamedTuple):
    """``sums``: pool and allocated sum per amount; ``differences``: the groups that do not balance, None if all do."""

    sums: dict[str, tuple[float, float]]
    differences: DataFrame | None

    @property
    def balanced(self) -> bool:
        return self.differences is None


def _beyond(pool: Column, allocated: Column, tolerance: float) -> Column:
    # A sum that is no number never passes for balanced.
    return F.isnan(pool - allocated) | (F.abs(pool - allocated) > F.greatest(F.abs(pool), F.lit(1.0)) * tolerance)


def differences(
    pool: DataFrame, allocated: DataFrame, keys: Sequence[str], amounts: Mapping[str, str], tolerance: float = TOLERANCE
) -> DataFrame:
    """Groups whose pool was not handed out: ``keys, amount, pool, allocated, difference``, one row per group and amount."""
    given = sum_by(pool, keys, {f"_pool_{i}": F.col(c).cast("double") for i, c in enumerate(amounts)})
    taken = sum_by(allocated, keys, {f"_out_{i}": F.col(c).cast("double") for i, c in enumerate(amounts.values())})
    # Null keys are groups too, and match each other.
    marked = [t.withColumn("_group", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})) for t in (given, taken)]
    both = full_outer(marked[0], marked[1].withColumnsRenamed({k: f"_{k}_out" for k in keys}), "_group")
    none = F.lit(0.0)
    sides = F.explode(F.array(*[
        F.struct(F.lit(c).alias("amount"), F.coalesce(f"_pool_{i}", none).alias("pool"), F.coalesce(f"_out_{i}", none).alias("allocated"))
        for i, c in enumerate(amounts)]))
    rows = both.select(*[F.coalesce(k, f"_{k}_out").alias(k) for k in keys], sides.alias("s")).select(*keys, "s.*")
    return rows.withColumn("difference", F.col("pool") - F.col("allocated")).where(_beyond(F.col("pool"), F.col("allocated"), tolerance))


def write_conserved(
    pool: DataFrame,
    job: Callable[[DataFrame], DataFrame],
    amounts: Mapping[str, str],
    keys: Sequence[str],
    write: Callable[[DataFrame], None],
    read_back: Callable[[], DataFrame],
    tolerance: float = TOLERANCE,
) -> Conservation:
    """Write ``job(pool)`` and compare what was handed out with the pool.

    ``amounts`` maps each column of the pool to the column of the allocation that hands it out; ``keys`` are columns of both within
    which the pool has to be handed out. ``read_back`` reads what ``write`` wrote, and runs only when the sums differ.
    """
    seen, shared = Observation(), Observation()
    summed = lambda columns: [F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in columns]
    write(job(pool.observe(seen, *summed(amounts))).observe(shared, *summed(amounts.values())))
    sums = {c: (float(seen.get[c]), float(shared.get[out])) for c, out in amounts.items()}
    if all(abs(a - b) <= max(abs(a), 1.0) * tolerance for a, b in sums.values()):
        return Conservation(sums, None)
    found = differences(pool, read_back(), keys, amounts, tolerance)
    return Conservation(sums, None if found.isEmpty() else found)


def must_balance(result: Conservation, most: int = 10) -> Conservation:
    """``result``, unless a group does not balance: then an error that names the largest differences, ``most`` of them."""
    if not result.balanced:
        worst = result.differences.orderBy(F.desc(F.abs("difference"))).limit(most).collect()
        named = "; ".join(", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in worst)
        raise RuntimeError(f"the pool was not handed out: {named}")
    return result
