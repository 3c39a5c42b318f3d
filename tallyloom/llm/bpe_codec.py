"""BPE encoding and decoding with a transducer lexicon of frequent words; unseen words are merged exactly.

``fit_lexicon`` counts the words of all documents with a bounded summary per task, takes the most frequent ones and compiles
them with their ids into a minimal acyclic transducer (``lexicon``). ``encode`` looks words up there and merges all others
(``word_bpe``), so the choice of words changes the speed and never the ids. Vocabulary and lexicon reach the executors as
broadcast bytes: the first is a file of checked size, the second has ``LEXICON_WORDS`` words at most; each worker maps the
lexicon into memory from an unnamed file.

Defined results: a null text encodes as the empty one, which has no ids and decodes to the empty text; null ids decode to
null. Special tokens written in a text are those tokens. Columns of the input are kept; those named like a result are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.lexicon import Lexicon, compile_words
from tallyloom.llm.word_bpe import Encoder, loaded, slices
from tallyloom.llm.words import carried
from tallyloom.session import settle

LEXICON_WORDS = 65_536
#: Words that one task's summary holds. A word's count is short by at most the task's words divided by half of this.
SUMMARY = 200_000
VOCABULARY_BYTES = 64 << 20
#: Ranges that one counting pass of ``frequency_cut`` tells apart.
FAN_OUT = 4096


def vocabulary(spark: SparkSession, path: str):
    """The vocabulary file (on the driver's machine) as a broadcast value."""
    with open(path, "rb") as file:
        data = file.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(data)


def column_batches(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of the batches, of bounded text size, with the values of one column. Arrow's memory is given back at the end."""
    try:
        for batch in batches:
            at = 0
            for run in slices(batch.column(name).to_pylist()):
                yield batch.slice(at, len(run)), run
                at += len(run)
    finally:
        pa.default_memory_pool().release_unused()


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    kept = carried(batch.schema.names, list(columns))
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + list(columns.values()), [*kept, *columns])


def extended(docs: DataFrame, *fields: T.StructField) -> T.StructType:
    kept = carried(docs.columns, [f.name for f in fields])
    return T.StructType([docs.schema[name] for name in kept] + list(fields))


def word_counts(docs: DataFrame, shared, summary: int = SUMMARY) -> DataFrame:
    """``word`` and ``n``: words of each task's summary, counted over all of its documents."""

    def count(batches):
        bpe, counts = loaded(shared.value), Counter()
        for _, texts in column_batches(batches, "text"):
            for text in texts:
                for special, part in bpe.segments(text or ""):
                    if special is None:
                        counts.update(bpe.chunks(part))
            if len(counts) > summary:
                # Frequent-items summary: take the same from every count until half of the places are free.
                least = sorted(counts.values(), reverse=True)[summary // 2]
                counts = Counter({w: n - least for w, n in counts.items() if n > least})
        alone, words, rest = bpe.pieces(list(counts))
        found = Counter()
        for chunk, word in zip(alone, words):
            found[word] += counts[chunk]
        for chunk, pieces in rest:
            for piece in pieces:
                found[piece] += counts[chunk]
        if found:
            yield pa.RecordBatch.from_pydict({"word": list(found), "n": list(found.values())})

    return docs.select("text").mapInArrow(count, "word string, n bigint")


def frequency_cut(counts: DataFrame, words: int) -> int:
    """The largest n such that more than ``words`` words occur n times or oftener, 0 if there are no more words than that.

    Found by counting ranges that narrow: each pass returns ``FAN_OUT`` numbers at most, whatever the number of words.
    """
    low, high = counts.agg(F.min("n"), F.max("n")).first()
    if low is None or counts.count() <= words:
        return 0
    above = 0
    while high > low:
        step = -(-(high - low + 1) // FAN_OUT)
        inside = counts.where(F.col("n").between(low, high)).groupBy(F.expr(f"(n - {low}L) div {step}L").alias("r")).count()
        for r, found in sorted(((r["r"], r["count"]) for r in inside.collect()), reverse=True):
            if above + found > words:
                low, high = low + r * step, min(high, low + r * step + step - 1)
                break
            above += found
    return low


def fit_lexicon(docs: DataFrame, shared, words: int = LEXICON_WORDS) -> bytes:
    """The lexicon's file: the most frequent words of the corpus, ``words`` at most; of words that tie at the cut none is taken."""
    counts = settle(word_counts(docs, shared).groupBy("word").agg(F.sum("n").alias("n")))
    chosen = [r["word"].encode() for r in counts.where(F.col("n") > frequency_cut(counts, words)).select("word").collect()]
    return compile_words(list(loaded(shared.value).merge(chosen).items()))


def encode(docs: DataFrame, shared, lexicon: bytes | None = None) -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian unsigned 32-bit integers) of ``text``."""
    spread = docs.sparkSession.sparkContext.broadcast(lexicon) if lexicon is not None else None

    def run(batches):
        encoder = Encoder(loaded(shared.value), None if spread is None else Lexicon(spread.value))
        for batch, texts in column_batches(batches, "text"):
            yield with_columns(batch, ids=pa.array(encoder.encode(texts), pa.binary()))

    return docs.mapInArrow(run, extended(docs, T.StructField("ids", T.BinaryType())))


def decode(encoded: DataFrame, shared) -> DataFrame:
    """``encoded`` with ``decoded``, the text that its ``ids`` stand for, special tokens included."""

    def run(batches):
        decoder = Encoder(loaded(shared.value))
        for batch, ids in column_batches(batches, "ids"):
            yield with_columns(batch, decoded=pa.array([None if i is None else decoder.decode(i) for i in ids], pa.string()))

    return encoded.mapInArrow(run, extended(encoded, T.StructField("decoded", T.StringType())))
