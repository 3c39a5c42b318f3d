"""Tables laid out by a key: written once in buckets, so that joins and groupings on the key read without a shuffle.

Each write deals its rows into the buckets by one shuffle, which every later join of the table on the key is spared. The rows of
one key are one task's work in such a join, so this layout is for keys that are identities, or for rows that were aggregated
by the key before they are written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sinks.tables import conform


@dataclass(frozen=True)
class BucketedTable:
    """A catalog name over files at ``path``; ``schema`` is DDL and names every column, those of ``partition_by`` as well."""

    name: str
    path: str
    schema: str
    keys: Sequence[str]
    buckets: int
    partition_by: Sequence[str] = ()


def _create(spark: SparkSession, table: BucketedTable) -> None:
    fields = T.StructType.fromDDL(table.schema).fields
    unknown = [c for c in (*table.keys, *table.partition_by) if c not in [f.name for f in fields]]
    if unknown:
        raise ValueError(f"{table.name} has no column {', '.join(unknown)}")
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    partitioned = f"PARTITIONED BY ({quoted(table.partition_by)})" if table.partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table.name} ({columns}) USING parquet {partitioned} CLUSTERED BY ({quoted(table.keys)}) "
        f"SORTED BY ({quoted(table.keys)}) INTO {table.buckets} BUCKETS LOCATION '{table.path}'"
    )


def declare(spark: SparkSession, table: BucketedTable) -> DataFrame:
    """Make a written table known to the session, with all partitions that lie at its path, and read it."""
    _create(spark, table)
    if table.partition_by:
        spark.catalog.recoverPartitions(table.name)
    return spark.table(table.name)


def replace_bucketed(df: DataFrame, table: BucketedTable) -> None:
    """Write ``df``: its partitions replace those of the table (all of it, without partitions), so a re-run does not double.

    Rows are dealt out by the key to as many tasks as there are buckets: one file per bucket and partition.
    """
    spark = df.sparkSession
    _create(spark, table)
    fields = T.StructType.fromDDL(table.schema)
    for name in table.partition_by:
        refused = F.raise_error(F.lit(f"{name} is a partition and null")).cast(fields[name].dataType)
        df = df.withColumn(name, F.coalesce(name, refused))
    # Partition columns come last in a catalog table.
    order = [f for f in fields if f.name not in table.partition_by] + [fields[name] for name in table.partition_by]
    dealt = conform(df, T.StructType(order)).repartition(table.buckets, *table.keys)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic" if table.partition_by else "static")
    try:
        dealt.write.insertInto(table.name, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    declare(spark, table)
    spark.catalog.refreshTable(table.name)
