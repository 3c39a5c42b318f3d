"""Importance resampling towards a target distribution, on n-grams that an overlapped regular expression finds.

A text is lower-cased in A-Z, and every run of separators becomes one space, with a space at each end. For each size n the
pattern of a space and n words, with a lookahead for the boundary after them, is then searched with ``overlapped=True``: the
next match may begin one place after the last one began, so every word begins one, and its span is the n-gram as it is hashed.
No list of words and no joined string is built. The space before a span is taken out of its CRC by the value the CRC starts
from. Texts are scanned once: the buckets of their n-grams are written, and counting and weighing read those.

With S n-grams in all documents, s of them in a bucket, and T and t in the target texts, the bucket's gain is
``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` for B buckets. A document's weight is the floored mean of the gains of its
n-grams, its score the weight plus Gumbel noise from a hash of its id, and the highest scores among the documents of
``least_words`` words are drawn, without replacement. Counts cover all documents; the gains are B numbers whatever the input.

Defined results: words are runs of 0-9, A-Z, a-z and all characters beyond U+007F. A null or empty text, or one without words, has no n-grams and
weight 0. A null id draws its noise from the empty id; ids tied in score come null first, then by value, repeated rows in any
order, each with a rank of its own. Without target texts T and t are 0. An empty table gives an empty table. Columns of the
input are kept; those named like a result, in whatever case, are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.bpe_codec import column_batches
from tallyloom.llm.words import carried, set_aside
from tallyloom.operators.aggregate import positions
from tallyloom.session import scratch_path

SIZES, BUCKETS, UNIT, SEED = (1, 2), 10_000, 1000, 7
LEAST_WORDS, PERCENT = 20, 25
RESULTS = ("n_words", "n_features", "weight", "score", "rank")
#: Upper-case letters to lower-case ones, and every other byte of ASCII that is no digit or letter to a space.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def before_space() -> int:
    """The CRC that a space turns into that of nothing."""
    top = next(i for i in range(256) if (crc32(bytes([i]), 0xFFFFFFFF) ^ 0xFFFFFFFF) >> 24 == 0xFF)
    # From state 0 the byte i leads to entry i of the CRC's table, whose top byte is unique.
    entry = crc32(bytes([top]), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return ((((entry ^ 0xFFFFFFFF) << 8) | (top ^ 32)) & 0xFFFFFFFF) ^ 0xFFFFFFFF


START = before_space()


def pattern(size: int) -> regex.Pattern:
    return regex.compile(rb" [^ ]++" * size + rb"(?= )")


def collapsed(text: str | None) -> bytes:
    """The words of a text, a space before and after each."""
    words = (text or "").encode().translate(PLAIN).split()
    return b" %s " % b" ".join(words) if words else b""


def ngram_crcs(plain: bytes, patterns: Sequence[regex.Pattern]) -> np.ndarray:
    """CRC-32 of every n-gram of a collapsed text, by size, then by place."""
    found = (crc32(m[0], START) for p in patterns for m in p.finditer(plain, overlapped=True))
    return np.fromiter(found, np.uint32)


def scan(docs: DataFrame, sizes: Sequence[int] = SIZES, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``n_features`` and ``__buckets``, those of its n-grams (binary, two bytes each)."""
    if buckets > 2**16:
        raise ValueError("a bucket is written in two bytes")
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([
        *kept, T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()), T.StructField("__buckets", T.BinaryType())])

    def run(batches):
        patterns = [pattern(n) for n in sizes]
        for batch, texts in column_batches(batches, "text"):
            words, features, found = [], [], []
            for text in texts:
                plain = collapsed(text)
                crcs = ngram_crcs(plain, patterns)
                words.append(max(plain.count(b" ") - 1, 0))
                features.append(len(crcs))
                found.append((crcs % buckets).astype("<u2").tobytes())
            columns = [*(batch.column(f.name) for f in kept), pa.array(words, pa.int64()), pa.array(features, pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(*(f.name for f in kept), "text").mapInArrow(run, schema)


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams each bucket has; ``buckets`` numbers whatever the input, a row for each from every task."""

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in batch.column("__buckets"):
                counts += np.bincount(np.frombuffer(found.as_buffer(), "<u2"), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    parts = scanned.select("__buckets").mapInArrow(run, "bucket int, n bigint")
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """How much likelier a bucket is in the target than in the corpus: smoothed log ratio in thousandths, rounded down."""
    all_raw, all_target = float(raw.sum() + len(raw)), float(target.sum() + len(raw))
    return np.array([
        math.floor(UNIT * math.log((t + 1.0) * all_raw / ((s + 1.0) * all_target))) for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def weigh(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    """``scanned`` with ``weight`` in place of its buckets."""
    kept = [f for f in scanned.schema.fields if f.name != "__buckets"]
    schema = T.StructType([*kept, T.StructField("weight", T.LongType())])

    def run(batches):
        for batch in batches:
            found = (np.frombuffer(b.as_buffer(), "<u2") for b in batch.column("__buckets"))
            weights = [int(gain[b].sum()) // len(b) if len(b) else 0 for b in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(weights, pa.int64())], schema.names)

    return scanned.select(*(f.name for f in kept), "__buckets").mapInArrow(run, schema)


def noise(seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of the seed and ``doc_id``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-UNIT * F.log(-F.log((drawn + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, sizes: Sequence[int] = SIZES,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """``docs`` without ``text``, with ``RESULTS``; ``rank`` counts the drawn documents from 1 and is null for the others.

    ``percent`` of the documents of ``least_words`` words or more are drawn; ``target`` has a column ``text``.
    """
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "ngrams")
    own = docs.select(*carried(docs.columns, RESULTS))
    scanned = scan(own, sizes, buckets)
    scanned.write.option("compression", "zstd").parquet(path)
    scanned = spark.read.schema(scanned.schema).parquet(path)
    gain = gains(bucket_counts(scanned, buckets), bucket_counts(scan(target.select("text"), sizes, buckets), buckets))

    weighed = weigh(scanned, gain).withColumn("score", F.col("weight") + noise(seed)).withColumn("__row", F.monotonically_increasing_id())
    path = scratch_path(spark, "scores")
    weighed.write.option("compression", "zstd").parquet(path)
    weighed = spark.read.schema(weighed.schema).parquet(path)
    able = weighed.where(F.col("n_words") >= least_words)
    # The row's number last, so that even rows that are equal in id and score can be dealt to several tasks.
    placed = positions(able.select((-F.col("score")).alias("__down"), "doc_id", "__row"), ["__down", "doc_id", "__row"], "rank", few=False)
    drawn = placed.where(F.col("rank") < able.agg(F.floor(F.count(F.lit(1)) * percent / 100)).scalar())
    ranks = drawn.select("__row", (F.col("rank") + 1).alias("rank"))
    kept = [c for c in weighed.columns if c not in (*RESULTS, "__row")]
    return weighed.join(ranks, "__row", "left").select(*kept, *RESULTS)


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents themselves, texts and all, with the columns they came with."""
    ours, back = set_aside(docs, RESULTS)
    drawn = resample(ours.withColumn("__text", F.col("text")), target, **options).where("rank is not null")
    return drawn.withColumnRenamed("__text", "text").drop(*RESULTS).withColumnsRenamed(back).select(*docs.columns)
