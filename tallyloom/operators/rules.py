"""Rule tables as joins.

A long CASE over hundreds of rules is evaluated rule by rule for every row. The same rules, kept as a table and joined on
their key columns, cost one hash probe per row whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.cases import case_first, all_hold
from tallyloom.operators.joins import MAX_BROADCAST_BYTES, fits_broadcast, lookup, skew_join
from tallyloom.operators.shape import MISSING

IS, NOT = "_is", "_not"


def guard_columns(rules: DataFrame, keys: Sequence[str]) -> list[str]:
    """Rule columns ``<event column>_is`` / ``<event column>_not``: extra conditions, null when the rule has none."""
    return [c for c in rules.columns if c not in keys and (c.endswith(IS) or c.endswith(NOT))]


def _guard_holds(event_column: Column, wanted: Column, negate: bool) -> Column:
    hit = (event_column != wanted) if negate else (event_column == wanted)
    return wanted.isNull() | F.coalesce(hit, F.lit(False))


def rule_slots(rules: DataFrame, keys: Sequence[str], targets: Sequence[str]) -> tuple[DataFrame, int]:
    """One row per key tuple. Slot i of a target holds its i-th rule by priority, as plain columns.

    Rules with the same key and guards can never be told apart, so only the one with the lowest priority is kept; the
    number of slots is then the largest number of differently guarded rules any key has (1 or 2 in practice).
    """
    guards = guard_columns(rules, keys)
    kept = rules.groupBy("target", *keys, *guards).agg(
        F.min_by("value", "priority").alias("value"), F.min("priority").alias("priority")
    )
    order = Window.partitionBy("target", *keys).orderBy("priority")
    ranked = kept.withColumn("_slot", F.row_number().over(order) - 1)
    slots = (ranked.agg(F.max("_slot")).first()[0] or 0) + 1 if guards else 1
    picks = [
        F.max(F.when((F.col("target") == t) & (F.col("_slot") == i), F.col(c))).alias(f"_{n}_{i}_{c}")
        for n, t in enumerate(targets)
        for i in range(slots)
        for c in ["value", *guards]
    ]
    return ranked.groupBy(*keys).agg(*picks), slots


def classify(
    events: DataFrame,
    rules: DataFrame,
    keys: Sequence[str],
    targets: Sequence[str],
    default: str = MISSING,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add one column per target: the value of the first rule (lowest ``priority``) that holds, else ``default``.

    ``rules`` is a long table: ``target``, ``priority``, the key columns, optional guard columns, ``value``. All
    targets are answered by a single join.
    """
    guards = guard_columns(rules, keys)
    if fits_broadcast(rules, max_bytes):
        # A measured small table is prepared in one task, without a shuffle, and its events stay where they are.
        table, slots = rule_slots(rules.coalesce(1), keys, targets)
        joined = events.join(F.broadcast(table), list(keys), "left")
    else:
        table, slots = rule_slots(rules, keys, targets)
        joined = skew_join(events, table, list(keys), "left")
    answers = {}
    for n, t in enumerate(targets):
        tries = []
        for i in range(slots):
            hit = F.col(f"_{n}_{i}_value").isNotNull()
            for g in guards:
                negate = g.endswith(NOT)
                column = F.col(g.removesuffix(NOT) if negate else g.removesuffix(IS))
                hit = hit & _guard_holds(column, F.col(f"_{n}_{i}_{g}"), negate)
            tries.append((hit, F.col(f"_{n}_{i}_value")))
        answers[t] = case_first(tries, default)
    return joined.select(*[F.col(c) for c in events.columns], *[a.alias(t) for t, a in answers.items()])


def rules_as_case(
    rules: Sequence[Mapping], keys: Sequence[str], target: str, default: str = MISSING
) -> Column:
    """The same rules as one CASE expression: the reading ``classify`` must agree with."""
    chain = []
    for r in sorted((r for r in rules if r["target"] == target), key=lambda r: r["priority"]):
        hit = all_hold({k: r[k] for k in keys})
        for name, wanted in r.items():
            if wanted is None or name in keys:
                continue
            if name.endswith(IS):
                hit = hit & (F.col(name.removesuffix(IS)) == F.lit(wanted))
            elif name.endswith(NOT):
                hit = hit & (F.col(name.removesuffix(NOT)) != F.lit(wanted))
        chain.append((hit, r["value"]))
    return case_first(chain, default)


def classify_by_key(
    events: DataFrame, table: DataFrame, parts: Sequence[str], table_key: str, separator: str = "-"
) -> DataFrame:
    """Look the events up in a list keyed by their joined columns; unmatched events keep nulls."""
    keyed = events.withColumn(table_key, F.concat_ws(separator, *[F.col(p) for p in parts]))
    return lookup(keyed, table, table_key)


def rules_schema(keys: Sequence[str], guards: Sequence[str] = ()) -> str:
    """DDL of a rule table, for reading one from CSV."""
    text = ", ".join(f"`{c}` string" for c in [*keys, *guards])
    return f"target string, priority int, {text}, value string"
