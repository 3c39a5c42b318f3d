"""What was read: rows, columns and status per source."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.shape import union_by_name
from tallyloom.sinks.tables import failure


def load_audit(spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], day: str | None = None) -> DataFrame:
    """One row per source. A source that cannot be opened is reported with 0 and its error, the others go on.

    All counts belong to one plan, so they run as one job over file metadata and empty projections.
    """
    parts = []
    for name, opener in sources.items():
        try:
            df = opener()
            counted = df.agg(F.count(F.lit(1)).alias("table_rows"))
            columns, status = len(df.columns), "ok"
        except (PySparkException, Py4JError) as e:
            counted = spark.range(1).select(F.lit(0).cast("bigint").alias("table_rows"))
            columns, status = 0, failure(e)
        parts.append(counted.select(
            F.lit(day).cast("string").alias("date"), F.lit(name).alias("table_name"), "table_rows",
            F.lit(columns).alias("table_columns"), F.lit(status).alias("status"),
        ))
    return union_by_name(*parts)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass while the frame is written, instead of reading it once more to count."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
