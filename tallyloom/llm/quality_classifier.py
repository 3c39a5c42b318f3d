"""Quality classifier: importance resampling with hashed n-gram models, the sample drawn by Gumbel top-k.

A document's log weight is the sum, over its words and word pairs, of log p(trusted) - log p(corpus) (``ngram_model``), tempered
by ``HORIZON / (HORIZON + n-grams)`` so that it does not grow without bound with length. Its key is the log weight plus Gumbel
noise drawn from a seeded hash of its id and text; the documents with the k largest keys are a sample without replacement,
proportional to the weights. Either k is given, or k is the number of keys that reach the ``1 - keep`` quantile of trusted
documents held out from the fit, which keeps that share of documents like them.

Defined results: texts without words have log weight 0. Equal rows have equal keys, and all rows tied at the k-th key are
taken. Without held-out trusted documents nothing is rejected. Columns of the input are kept; those named like a result are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import ngram_model as model
from tallyloom.llm.ranks import quantile
from tallyloom.llm.words import bigram_hashes, carried, hashes_of, let, set_aside, words_of
from tallyloom.session import settle

SEED = 20
HORIZON = 100
KEEP = 0.995
RESULTS = ("n_grams", "log_weight", "sample_key", "selected")
DIGITS = 6
#: Ranges that one counting pass of ``kth_key`` tells apart.
FAN_OUT = 4096


def gumbel(*keys: Column, seed: int) -> Column:
    """Standard Gumbel noise that depends on the seed and the keys alone."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11).cast("double") + 0.5) * F.lit(2.0**-53)
    return -F.log(-F.log(uniform))


def weigh(docs: DataFrame, ratios: list[int], seed: int = SEED) -> DataFrame:
    """``docs`` with the number of n-grams, the tempered log weight and the sample key, all from the row itself."""
    kept = carried(docs.columns, RESULTS)

    def measures(hashes: Column) -> Column:
        return F.struct(
            model.grams(hashes).cast("long").alias("n"),
            let(bigram_hashes(hashes), lambda g: model.ratio_sum(hashes, g, ratios)).alias("total"),
        )

    found = docs.select(*kept, let(let(words_of(F.col("text")), hashes_of), measures).alias("__m"))
    weight = F.col("__m.total") * HORIZON / (model.UNIT * (F.col("__m.n") + HORIZON))
    found = found.select(*kept, F.col("__m.n").alias("n_grams"), F.round(weight, DIGITS).alias("log_weight"))
    noise = F.round(gumbel(F.col("doc_id"), F.col("text"), seed=seed), DIGITS)
    return found.withColumn("sample_key", F.round(F.col("log_weight") + noise, DIGITS))


def kth_key(weighed: DataFrame, k: int) -> float | None:
    """The k-th largest key, found by counting ranges that narrow: each pass returns ``FAN_OUT`` counts at most.

    None if there are no more than ``k`` rows, so that all of them are taken.
    """
    scaled = weighed.select(F.round(F.col("sample_key") * 10**DIGITS).cast("long").alias("x"))
    low, high, rows = scaled.agg(F.min("x"), F.max("x"), F.count("x")).first()
    if k >= rows:
        return None
    above = 0
    while high > low:
        step = -(-(high - low + 1) // FAN_OUT)
        inside = scaled.where(F.col("x").between(low, high)).groupBy(F.expr(f"(x - {low}L) div {step}L").alias("r")).count()
        for r, n in sorted(((r["r"], r["count"]) for r in inside.collect()), reverse=True):
            if above + n >= max(k, 1):
                low, high = low + r * step, min(high, low + r * step + step - 1)
                break
            above += n
    return low / 10**DIGITS


def sample_size(keys: DataFrame, keep: float) -> int:
    """How many keys reach the ``1 - keep`` quantile of those held out; all, if none is."""
    cut = quantile(keys.where("__held"), "sample_key", 1 - keep)
    return (keys if cut is None else keys.where(F.col("sample_key") >= F.lit(cut))).count()


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, keep: float = KEEP, seed: int = SEED) -> DataFrame:
    """``docs`` with ``RESULTS``; ``selected`` marks the sample."""
    trusted = model.trusted_ids(labels)
    half = F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(2))
    ratios = model.fit(docs, trusted if k is not None else trusted.where(half == 0))
    marked = model.mark_trusted(docs.select("doc_id", "text"), trusted.where(half == 1), "__held")
    # One number and one mark for each document, which several passes read.
    keys = settle(weigh(marked, ratios, seed).select("sample_key", "__held"))
    least = kth_key(keys, sample_size(keys, keep) if k is None else k)
    chosen = F.lit(True) if least is None else F.col("sample_key") >= F.lit(least)
    return weigh(docs, ratios, seed).withColumn("selected", chosen)


def keep_selected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents of the sample, with the columns they came with."""
    ours, back = set_aside(docs, RESULTS)
    return resample(ours, labels).where("selected").drop(*RESULTS).withColumnsRenamed(back)
