"""Packing: concatenate and cut. Two passes of prefix sums place every document in one long row of ids, cut at fixed windows.

Each document's ids end with ``end_id``. The first pass writes the ids once to the shared folder, each with its start inside
its partition, and so fixes the order; the partition totals then give each partition's start. A document that crosses a
window's edge becomes a piece in each window it touches (the boundary records). Only the last window is not full.

Defined results: null and empty texts are one id, the end. Repeated rows are packed as often as they occur. An empty table gives
no pieces. Other columns of the documents are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.bpe_codec import column_batches
from tallyloom.llm.offsets import join_offsets, running_offsets
from tallyloom.llm.word_bpe import Encoder, loaded
from tallyloom.session import scratch_path

WINDOW = 2048
END_ID = 1
PLACED = "doc_id bigint, part bigint, start_in_part bigint, doc_tokens bigint, ids binary"


def place(docs: DataFrame, shared, end_id: int = END_ID) -> DataFrame:
    """First pass: ids of every document, and where they start among the ids of the same partition."""
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encoder, part, at = Encoder(loaded(shared.value)), TaskContext.get().partitionId(), 0
        for batch, texts in column_batches(batches, "text"):
            ids = [i + end for i in encoder.encode(texts)]
            sizes = np.array([len(i) // 4 for i in ids], np.int64)
            starts = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([part] * len(ids), pa.int64()), pa.array(starts), pa.array(sizes), pa.array(ids, pa.binary())],
                ["doc_id", "part", "start_in_part", "doc_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PLACED)


def pack(docs: DataFrame, shared, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: where it lies in its document and in its window, with its ``ids`` (binary)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "packing")
    place(docs, shared, end_id).write.option("compression", "zstd").parquet(path)
    placed = spark.read.schema(PLACED).parquet(path)
    totals = placed.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    offsets = running_offsets(totals, "part", "tokens", "part_start")
    found = join_offsets(placed, offsets, "part", totals.count())
    found = found.withColumn("global_start", F.col("part_start") + F.col("start_in_part"))
    end = F.col("global_start") + F.col("doc_tokens")
    windows = F.sequence(F.expr(f"global_start div {window}"), F.expr(f"(global_start + doc_tokens - 1) div {window}"))
    pieces = found.select("*", F.explode(windows).alias("sequence_id"))
    begin = F.greatest("global_start", F.col("sequence_id") * window)
    pieces = pieces.withColumn("start", begin - F.col("global_start")).withColumn(
        "length", F.least(end, (F.col("sequence_id") + 1) * window) - begin)
    return pieces.select(
        "doc_id", "start", "length", "doc_tokens", "sequence_id",
        (F.col("global_start") + F.col("start") - F.col("sequence_id") * window).alias("offset"),
        (F.col("start") > 0).alias("continues_document"), (F.col("start") + F.col("length") < F.col("doc_tokens")).alias("continued"),
        F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids"),
    )


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The packed sequences: ids of each window, padded at its end. A group holds ``window`` ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))")
    full = pieces.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("n_tokens")).withColumn("ids", whole)
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), (window - F.col("n_tokens")).cast("int")))
    return full.select("sequence_id", "n_tokens", F.concat("ids", pad).alias("ids"))
