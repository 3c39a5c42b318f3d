"""Sharding: a two-pass external shuffle into shards of equal row counts.

The first pass scatters the records over memory-sized buckets by a seeded hash of the whole record. The second shuffles each
bucket (Fisher-Yates, seeded by seed and bucket) and writes it. A record's place in the whole order is its bucket's start plus
its place in the bucket; shard s holds the s-th of ``shards`` equal ranges of places, so counts differ by one at most.

Defined results: equal seeds and records give equal shards, in whatever order the records come. Records that are equal in every
column are told apart by a running number if there are many of them (``CROWD``), so that no bucket fills with them; which copy
gets which place doesn't matter. Null texts count no bytes. An empty table gives no shards. All columns are kept; those named
like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.offsets import join_offsets, running_offsets
from tallyloom.llm.words import carried
from tallyloom.session import scratch_path, settle

BUCKET_BYTES = 16 << 20
#: Records that make up more than one in ``CROWD`` of all rows, and more than ``CROWD_ROWS``, are scattered copy by copy. There
#: are fewer than ``CROWD`` of them.
CROWD, CROWD_ROWS = 4096, 1000
RESULTS = ("size", "shard", "slot")


def scatter(docs: DataFrame, seed: int, bucket_bytes: int) -> tuple[DataFrame, int, int]:
    """``docs`` with ``size``, ``__hash`` and ``__bucket``; the number of rows and of buckets."""
    columns = carried(docs.columns, RESULTS)
    # Maps have no hash of their own.
    hashed = [F.to_json(F.struct(c)) if "map<" in docs.schema[c].dataType.simpleString() else F.col(c) for c in columns]
    sized = docs.select(
        *columns, (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), *hashed).alias("__hash"))
    rows, size = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = max(1, -(-size // bucket_bytes))
    counts = sized.groupBy("__hash").count()
    crowded = [r[0] for r in counts.where(F.col("count") > max(CROWD_ROWS, rows // CROWD)).select("__hash").limit(CROWD).collect()]
    number = F.when(F.col("__hash").isin(crowded), F.monotonically_increasing_id()).otherwise(0) if crowded else F.lit(0)
    bucket = F.pmod(F.xxhash64(F.lit(seed), "__hash", number), F.lit(buckets))
    scattered = sized.withColumn("__bucket", bucket)
    # A row's number depends on the run, so it is drawn once: totals and shuffle must see the same buckets.
    return settle(scattered) if crowded else scattered, rows, buckets


def shuffled(scattered: DataFrame, seed: int) -> DataFrame:
    """Each bucket in Fisher-Yates order, with ``__place``, the place in its bucket."""

    def run(bucket: pa.Table) -> pa.Table:
        # The order in which rows arrive depends on the run; that of the hashes doesn't.
        order = np.argsort(bucket.column("__hash").to_numpy(), kind="stable")
        draw = np.random.Generator(np.random.PCG64([seed, bucket.column("__bucket")[0].as_py()]))
        for last in range(len(order) - 1, 0, -1):
            other = int(draw.integers(last + 1))
            order[last], order[other] = order[other], order[last]
        taken = bucket.take(pa.array(order))
        return taken.append_column("__place", pa.array(np.arange(len(order), dtype=np.int64)))

    schema = T.StructType([*scattered.schema.fields, T.StructField("__place", T.LongType())])
    return scattered.groupBy("__bucket").applyInArrow(run, schema)


def shard(docs: DataFrame, shards: int, seed: int = 7, bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """Writes the shards (folders ``shard=0`` and so on, below ``path``) and returns them, with ``slot``, gapless from 0."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "shards")
    scattered, rows, buckets = scatter(docs, seed, bucket_bytes)
    # The bucket is a function of the record, so the counts of this pass hold for the next one.
    totals = scattered.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    placed = join_offsets(shuffled(scattered, seed), running_offsets(totals, "__bucket", "__n", "__start"), "__bucket", buckets)
    place, n = F.col("__start") + F.col("__place"), max(rows, 1)
    placed = placed.withColumn("__at", place).withColumn("shard", F.expr(f"cast(__at * {shards} div {n} as int)"))
    # Shard s begins at the first place p with p * shards >= s * rows.
    placed = placed.withColumn("slot", F.expr(f"__at - (shard * {n}L + {shards - 1}) div {shards}"))
    placed.drop("__hash", "__bucket", "__place", "__start", "__at").write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return spark.read.schema(T.StructType([docs.schema[c] for c in carried(docs.columns, RESULTS)] + [
        T.StructField("size", T.LongType()), T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])).parquet(path)
