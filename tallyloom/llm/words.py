"""Words, hashed n-grams and small expression helpers, all built-in functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"


def carried(names: list[str], results: Sequence[str]) -> list[str]:
    """The columns that an operator hands on: all but those named like a result, in whatever case."""
    taken = {r.lower() for r in results}
    return [n for n in names if n.lower() not in taken]


def set_aside(docs: DataFrame, results: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its own columns of these names under other ones, and how to name them back."""
    own = set(docs.columns) - set(carried(docs.columns, results))
    return docs.withColumnsRenamed({c: f"__own_{c}" for c in own}), {f"__own_{c}": c for c in own}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it inside another lambda."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The runs of characters other than space and U+0009 to U+000D; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def paired(hashes: Column, apart: int, count: Column) -> Column:
    """``count`` hashes, each of the element at a place and the one ``apart`` places later; none if there are too few."""
    runs = F.zip_with(F.slice(hashes, 1, count), F.slice(hashes, apart + 1, count), lambda a, b: F.xxhash64(a, b))
    return F.when(count >= 1, runs).otherwise(F.array().cast("array<bigint>"))


def bigram_hashes(hashes: Column) -> Column:
    """One hash for each two neighbouring words, in their order."""
    return paired(hashes, 1, F.size(hashes) - 1)


def bucket(hashed: Column, bits: int) -> Column:
    return hashed.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
