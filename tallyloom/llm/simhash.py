"""SimHash near-duplicates by covering locality-sensitive hashing: no pair within the radius is missed.

A text's features are its runs of ``SHINGLE`` words, repeats included, hashed with XXH64; a fingerprint bit is 1 if it is set in
over half of them. Every bit has a vector of ``RADIUS + 1`` bits, not all 0. For each such vector v there is a mask: the bits whose
vector has an odd inner product with v. Up to ``RADIUS`` differing bits span less than the whole space, so some v is orthogonal to
all of them, its mask holds none of them, and the two fingerprints agree under it: with 15 masks of about 34 of the 64 bits every
pair within 3 bits meets in some bucket.

Only distinct fingerprints are compared, so copies cost nothing. A bucket of more than ``MOST`` of them is divided again by
the masks of the bits that its own mask leaves free; the argument is the same. Distinct fingerprints that agree under both masks
differ in the 16 bits left at most, so a bucket of the second level has a proven bound, and no bucket is multiplied by its size.
A bucket gives an edge from each fingerprint to the smallest it is connected with, never its pairs.

Defined results: words are separated by space and U+0009 to U+000D, A-Z are lower-cased, other letters are not. A text of fewer
words than a shingle is one feature; one without words, or null, has fingerprint zero and is linked like any other. Null ids are
in components; a component's id is its smallest id that is not null. Repeated rows are copies of each other. Other columns
play no part. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.bpe_codec import column_batches
from tallyloom.llm.ngram_join import components
from tallyloom.operators.joins import skew_join
from tallyloom.session import settle

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
TABLES = 2 ** (RADIUS + 1) - 1
#: Fingerprints of a bucket that are compared without dividing it again.
MOST = 512
#: Features whose bits are counted at once.
AT_ONCE = 65_536


def covering_masks(bits: Sequence[int]) -> list[int]:
    """Masks over the bits numbered ``bits``, such that any ``RADIUS`` of them lie outside one of the masks."""
    vectors = [(bit, 1 + place % TABLES) for place, bit in enumerate(bits)]
    return [sum(1 << bit for bit, vector in vectors if (vector & v).bit_count() % 2) for v in range(1, TABLES + 1)]


MASKS = covering_masks(range(BITS))
#: For each mask the masks of the second level, each with the bits of the first.
SECOND = [[mask | more for more in covering_masks([i for i in range(BITS) if not mask >> i & 1])] for mask in MASKS]


def signed(value: int) -> int:
    return value - 2**BITS if value >= 2 ** (BITS - 1) else value


def fingerprint(text: str | None) -> int:
    """The SimHash of one text, as a signed number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    width = min(SHINGLE, len(words))
    first, last = (ends - lengths)[: len(words) - width + 1], ends[width - 1 :]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(first), AT_ONCE):
        spans = zip(first[at : at + AT_ONCE].tolist(), last[at : at + AT_ONCE].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(first), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``th`` (hash of the text) and the fingerprint ``fp`` of each row."""

    def run(batches):
        for batch, texts in column_batches(batches, "text"):
            found = pa.array([fingerprint(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), found], ["doc_id", "th", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(run, "doc_id bigint, th bigint, fp bigint")


def numbers(values: Sequence[int]) -> Column:
    return F.array(*(F.lit(signed(v)) for v in values))


def buckets(classes: DataFrame, most: int = MOST) -> DataFrame:
    """``bucket`` (mask), ``key`` (the bits under it) and ``fp``, for all buckets that can hold a pair."""
    places = F.posexplode(F.transform(numbers(MASKS), lambda mask: F.col("fp").bitwiseAND(mask)))
    placed = classes.select("fp", places.alias("bucket", "key"))
    sizes = placed.groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = skew_join(placed, sizes, ["bucket", "key"])
    second = F.array(*(numbers(masks) for masks in SECOND))[F.col("bucket")]
    own = F.array(F.struct(F.col("bucket").alias("bucket"), F.col("key").alias("key")))
    divided = F.transform(second, lambda mask, i: F.struct((TABLES * (F.col("bucket") + 1) + i).alias("bucket"), F.col("fp").bitwiseAND(mask).alias("key")))
    return met.select("fp", F.inline(F.when(F.col("members") > most, divided).otherwise(own)))


def edges(bucket: np.ndarray, key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints that are connected with a smaller one in their bucket, and the smallest; rows sorted by bucket, key and ``fp``."""
    group = np.cumsum(np.r_[False, (bucket[1:] != bucket[:-1]) | (key[1:] != key[:-1])])
    root, left, apart = np.arange(len(fp)), np.arange(len(fp)), 0

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    while len(left):
        apart += 1  # each fingerprint meets the one so many places on, in all buckets at once
        left = left[left + apart < len(fp)]
        left = left[group[left] == group[left + apart]]
        near = left[np.bitwise_count(fp[left] ^ fp[left + apart]) <= RADIUS]
        for i in near[root[near] != root[near + apart]].tolist():
            a, b = sorted((top(i), top(i + apart)))
            root[b] = a
    while (root[root] != root).any():
        root = root[root]
    found = np.flatnonzero(root != np.arange(len(fp)))
    return fp[found], fp[root[found]]


def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``edges`` of a sorted partition, read in batches; a bucket cut by their border waits for its rest."""
    held = [np.empty(0, np.int64)] * 3
    for batch in batches:
        held = [np.r_[h, batch.column(n).to_numpy().astype(np.int64)] for h, n in zip(held, ("bucket", "key", "fp"))]
        if not len(held[0]):
            continue
        other = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
        whole = other[-1] + 1 if len(other) else 0
        yield _edge_batch(*(h[:whole] for h in held))
        held = [h[whole:] for h in held]
    yield _edge_batch(*held)


def _edge_batch(bucket: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    found, roots = edges(bucket, key, fp) if len(fp) else (fp, fp)
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(roots)], ["cls", "root"])


def near_duplicates(docs: DataFrame, most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``th`` (hash of the text), ``fp`` and ``component_id``."""
    rows = settle(fingerprints(docs))
    classes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    met = buckets(classes, most).repartition("bucket", "key").sortWithinPartitions("bucket", "key", "fp")
    groups = components(met.mapInArrow(links, "cls bigint, root bigint"))
    of_class = classes.join(groups, classes["fp"] == groups["cls"], "left").select("fp", "first", F.coalesce("root", "fp").alias("grp"))
    of_class = settle(of_class)
    smallest = of_class.groupBy("grp").agg(F.min("first").alias("component_id"))
    of_class = skew_join(of_class, smallest, "grp").select("fp", "component_id")
    return skew_join(rows, of_class, "fp").select("doc_id", "th", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the one of smallest id; all without an id where the component has none. Columns as they came."""
    rows = near_duplicates(docs).where("doc_id <=> component_id").groupBy("doc_id", "fp").agg(F.min("th").alias("th"), F.count(F.lit(1)).alias("n"))
    chosen = settle(rows.select(F.col("doc_id").alias("__id"), F.col("th").alias("__chosen"), ((F.col("n") > 1) & F.col("doc_id").isNotNull()).alias("__many")))
    own = docs.withColumn("__th", F.xxhash64("text"))
    kept = own.join(chosen, own["doc_id"].cast("long").eqNullSafe(chosen["__id"]) & (own["__th"] == chosen["__chosen"]))
    # Only rows that may occur again are gathered, to keep one of them.
    once = kept.where("not __many").unionByName(kept.where("__many").dropDuplicates(["doc_id", "__th"]))
    return once.select(*docs.columns)
