"""Two hashed n-gram multinomials, one of trusted documents and one of the whole corpus, and their log ratio per bucket.

Words and word pairs are hashed into ``2**BITS`` buckets. The counts are sums over every document, so they grow with the
corpus, while the model is one array of fixed size: 2**16 whole numbers, log ratios in thousandths. Whole numbers make the sum
over a document exact in any order. Trusted documents are labelled rows, all of them: their ids are broadcast within the bound of
``lookup`` and joined shuffled beyond, and cuts are found by counting (``ranks``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.ranks import quantile
from tallyloom.llm.words import bigram_hashes, bucket, hashes_of, let, words_of
from tallyloom.operators.joins import MAX_BROADCAST_BYTES, lookup
from tallyloom.session import settle

BITS = 16
UNIT = 1000
SMOOTHING = 1.0
#: The toxic ratios: n-grams of prior, the log ratio from which a bucket counts, n-grams added to a document's length.
PRIOR, TELLING, LEAST_GRAMS = 5.0, 1.5, 100
#: Share of held-out trusted documents that the toxic ratio may reject.
CLEAN_LOSS = 0.005


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled good and never labelled bad or toxic."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    ids = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.coalesce(good, F.lit(False))).alias("good"))
    return ids.where("good").select("doc_id")


def toxic_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled toxic."""
    return labels.where(F.col("doc_id").isNotNull() & (F.col("toxic") == 1)).select("doc_id").distinct()


def mark_trusted(docs: DataFrame, trusted: DataFrame, name: str, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``docs`` with the boolean ``name``: whether the document is among the trusted ones."""
    known = trusted.select(F.col("doc_id").try_cast(docs.schema["doc_id"].dataType), F.lit(True).alias(name))
    return lookup(docs, known, "doc_id", max_bytes=max_bytes).withColumn(name, F.coalesce(name, F.lit(False)))


def bucket_counts(docs: DataFrame, trusted: DataFrame, bits: int = BITS) -> DataFrame:
    """For each bucket: n-grams of all documents (``raw``) and of the trusted ones (``target``).

    Each task sums before the shuffle, so it sends one row per bucket at most, whatever its documents.
    """
    marked = mark_trusted(docs.select("doc_id", "text"), trusted, "__trusted").select("__trusted", words_of(F.col("text")).alias("a"))
    pairs = marked.select("__trusted", F.explode(F.arrays_zip("a", F.slice("a", 2, F.size("a")).alias("b"))).alias("s"))
    second = F.when(F.col("s.b").isNotNull(), F.xxhash64(F.xxhash64("s.a"), F.xxhash64("s.b")))
    found = pairs.select("__trusted", F.explode(F.array(bucket(F.xxhash64("s.a"), bits), bucket(second, bits))).alias("b"))
    return found.where(F.col("b").isNotNull()).groupBy("b").agg(
        F.count(F.lit(1)).alias("raw"), F.count(F.when(F.col("__trusted"), 1)).alias("target"))


def fit(docs: DataFrame, trusted: DataFrame, bits: int = BITS) -> list[int]:
    """Log ratios log p(bucket | trusted) - log p(bucket | corpus), smoothed, in thousandths; all 0 without trusted text.

    This runs a job over the whole corpus; what comes back to the driver is ``2**bits`` rows whatever the input.
    """
    size, counts = 1 << bits, {r["b"]: (r["raw"], r["target"]) for r in bucket_counts(docs, trusted, bits).collect()}
    all_raw, all_target = (sum(c[i] for c in counts.values()) + SMOOTHING * size for i in (0, 1))
    if all_target == SMOOTHING * size:
        return [0] * size
    return [
        round(UNIT * (math.log((target + SMOOTHING) / all_target) - math.log((raw + SMOOTHING) / all_raw)))
        for raw, target in (counts.get(b, (0, 0)) for b in range(size))
    ]


def fit_toxic(docs: DataFrame, labels: DataFrame, bits: int = BITS, loss: float = CLEAN_LOSS) -> tuple[list[int], float] | None:
    """Log ratios log p(bucket | toxic) - log p(bucket | trusted) in thousandths, and the ``toxicity`` that is still kept.

    Fitted to one half of the labelled documents; the cut is the ``1 - loss`` quantile of the trusted ones of the other half.
    Buckets under ``TELLING`` are 0, since the noise of a long text would hide the few words that tell. None without labels
    of both kinds in the first half, or without trusted documents in the other.
    """
    half = F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(2))
    trusted, toxic = trusted_ids(labels), toxic_ids(labels)
    fitted = mark_trusted(docs.select("doc_id", "text"), trusted.unionByName(toxic).where(half == 0), "__fitted").where("__fitted")
    size, counts = 1 << bits, {r["b"]: (r["raw"] - r["target"], r["target"]) for r in bucket_counts(fitted, toxic, bits).collect()}
    clean, bad = (sum(c[i] for c in counts.values()) for i in (0, 1))
    if not clean or not bad:
        return None
    ratios = [0] * size
    for b, (n_clean, n_bad) in counts.items():
        prior = PRIOR * size * (n_clean + SMOOTHING) / (clean + SMOOTHING * size)
        ratio = math.log((n_bad + prior) / (bad + PRIOR * size)) - math.log((n_clean + prior) / (clean + PRIOR * size))
        ratios[b] = round(UNIT * ratio) if ratio > TELLING else 0
    held_out = mark_trusted(docs.select("doc_id", "text"), trusted.where(half == 1), "__held").where("__held")
    scores = held_out.select(let(let(words_of(F.col("text")), hashes_of), lambda h: let(bigram_hashes(h), lambda g: toxicity(h, g, ratios))).alias("x"))
    cut = quantile(settle(scores), "x", 1 - loss)
    return None if cut is None else (ratios, cut)


def toxicity(hashes: Column, bigrams: Column, ratios: list[int]) -> Column:
    """The telling ratios of a document per n-gram, in nats."""
    return ratio_sum(hashes, bigrams, ratios) / (UNIT * (grams(hashes) + LEAST_GRAMS))


def ratio_sum(hashes: Column, bigrams: Column, ratios: list[int]) -> Column:
    """Sum of the ratios of all words and word pairs, in thousandths."""
    bits = (len(ratios) - 1).bit_length()
    # One string that Spark folds into one constant array; a literal per number would make the plan huge.
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")
    return F.aggregate(F.concat(hashes, bigrams), F.lit(0).cast("long"), lambda total, h: total + F.get(table, bucket(h, bits)))


def grams(hashes: Column) -> Column:
    return F.size(hashes) + F.greatest(F.size(hashes) - 1, F.lit(0))


