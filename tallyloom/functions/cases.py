"""Ordered rules as CASE expressions: first match wins, or last match wins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[Column, Any]


def _value(v: Any) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def case_first(rules: Sequence[Rule], default: Any = None) -> Column:
    """The value of the first rule whose condition holds."""
    if not rules:
        return _value(default)
    (cond, value), *rest = rules
    out = F.when(cond, _value(value))
    for cond, value in rest:
        out = out.when(cond, _value(value))
    return out.otherwise(_value(default))


def case_last(rules: Sequence[Rule], default: Any = None) -> Column:
    """The value of the last rule whose condition holds, as a chain of overwriting assignments leaves it."""
    return case_first(list(reversed(rules)), default)


def contains_rules(text: Column, needles: Iterable[tuple[str, Any]]) -> list[Rule]:
    return [(text.contains(needle), value) for needle, value in needles]


def like_rules(text: Column, patterns: Iterable[tuple[str, Any]]) -> list[Rule]:
    return [(text.like(p), value) for p, value in patterns]


class Like(NamedTuple):
    """Marks a rule value as a LIKE pattern."""

    text: str


def pattern(text: str) -> Like:
    return Like(text)


def all_hold(conditions: Mapping[str, Any]) -> Column:
    """AND over columns; a list means IN, a ``pattern`` means LIKE, anything else equality. No column: always true."""
    out = F.lit(True)
    for name, wanted in conditions.items():
        c = F.col(name)
        if isinstance(wanted, Like):
            hit = c.like(wanted.text)
        elif isinstance(wanted, (list, tuple, set, frozenset)):
            hit = c.isin(sorted(wanted))
        else:
            hit = c == F.lit(wanted)
        out = out & hit
    return out
