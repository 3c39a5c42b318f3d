"""Table scans with predicates the storage layer can use."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """Where a table lies: a path (with its format) or, without a path, a catalog name."""

    name: str
    path: str | None = None
    format: str = "parquet"
    schema: T.StructType | str | None = None
    options: Mapping[str, str] | None = None


def scan(
    spark: SparkSession, table: Table, where: Column | str | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Read a table; the predicate and the columns reach the file scan."""
    if table.path is None:
        df = spark.table(table.name)
    else:
        reader = spark.read.format(table.format).options(**(table.options or {}))
        if table.schema is not None:
            reader = reader.schema(table.schema)
        df = reader.load(table.path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def process_day(lag_days: int, today: date | None = None) -> str:
    """The day a job run ``lag_days`` late has to process."""
    return ((today or date.today()) - timedelta(days=lag_days)).isoformat()


def padded_days(day: str, pad: int = 1) -> tuple[str, str]:
    """First and last day of the window around ``day`` that covers it in every time zone."""
    middle = date.fromisoformat(day)
    return (middle - timedelta(days=pad)).isoformat(), (middle + timedelta(days=pad)).isoformat()


def day_slice(
    time: str, first_day: str, last_day: str | None = None, first_hour: int = 0, last_hour: int = 23
) -> Column:
    """Whole days from first to last, optionally only the hours from first to last of each day.

    The day bounds are half-open on the bare column: statistics, partitions and pushdown can use them, which a
    function wrapped around the column would prevent.
    """
    c = F.col(time)
    until = F.date_add(F.lit(last_day or first_day).cast("date"), 1)
    out = (c >= F.lit(first_day).cast("date")) & (c < until)
    if (first_hour, last_hour) != (0, 23):
        out = out & F.hour(c).between(first_hour, last_hour)
    return out


def by_environment(
    spark: SparkSession, tables: Mapping[str, Table], environment: str, where: Column | str | None = None,
    column: str = "environment",
) -> DataFrame:
    """Scan the table of an environment and carry its code as a column."""
    if environment not in tables:
        raise KeyError(f"no table for environment {environment!r}; known: {', '.join(sorted(tables))}")
    return scan(spark, tables[environment], where).withColumn(column, F.lit(environment))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options: str) -> DataFrame:
    """CSV with a header row and a given schema; both line endings are understood. Empty cells are nulls."""
    return spark.read.options(header=True, **options).schema(schema).csv(path)


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame], **values: object) -> DataFrame:
    """A SQL text over frames, named ``{table}`` in it, and over values, named ``:value``."""
    return spark.sql(text, args=values, **tables)
