"""The hourly event count over files as they land, with the same two days of grace the daily job allows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LATENESS = "2 days"


def read_landed(spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def hourly_counts_stream(
    events: DataFrame, time: str, dims: Sequence[str], lateness: str = LATENESS, name: str = "event_count"
) -> DataFrame:
    """Events per UTC hour and dimensions. State is one row per open hour and dimensions, dropped past the lateness."""
    instants = events.withColumn(time, F.col(time).cast("timestamp"))
    counted = instants.withWatermark(time, lateness).groupBy(F.window(time, "1 hour"), *dims)
    return counted.agg(F.count(F.lit(1)).alias(name)).select(F.col("window.start").alias("datetime_h"), *dims, name)
