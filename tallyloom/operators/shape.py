"""Schema repair, renames and null filling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING = "N/A"


def ensure_columns(df: DataFrame, names: Iterable[str], default: Any = MISSING) -> DataFrame:
    """Add each absent column as a constant."""
    return df.withColumns({n: F.lit(default) for n in names if n not in df.columns})


def fill_text(df: DataFrame, default: str = MISSING) -> DataFrame:
    """Fill nulls in every text column; numbers and times stay null."""
    return df.fillna(default)


def fill_zero(df: DataFrame, *columns: str) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def fill_by_column(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    return df.fillna(dict(defaults))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def prefix_columns(df: DataFrame, prefix: str, *keep: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keep})


def clean_names(df: DataFrame, old: str = " ", new: str = "_") -> DataFrame:
    """Replace characters in column names."""
    return df.toDF(*[c.replace(old, new) for c in df.columns])


def union_by_name(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """UNION ALL by name; a column only one side has is null on the other."""
    out = first
    for df in rest:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
