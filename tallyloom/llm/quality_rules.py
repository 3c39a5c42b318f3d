"""Quality rules: counts over the whole text, then a length-normalised log-likelihood ratio with one fixed threshold.

The ratio compares two multinomials over hashed words and word pairs, one of trusted documents and one of the raw corpus
(``ngram_model``). A document that passes the base rules is kept if its mean ratio per n-gram reaches ``THRESHOLD`` and if its
toxicity, a ratio of the labelled toxic documents and the trusted ones, is within a cut taken from held-out trusted documents:
the first ratio hardly sees a few insults in a long text. All of it is computed inside the row from built-in functions; only
the bucket counts are shuffled.

Defined results: null and empty texts have no words, so they fail the base rule and are not kept. Repeated rows are judged
alike. Columns of the input are kept; those named like a result are replaced. Without trusted labels all ratios are 0 and the
base rules decide alone; without toxic labels the toxicity is 0. Windows and lines are compared by 64-bit hashes and by value respectively.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import ngram_model as model
from tallyloom.llm.words import bigram_hashes, carried, hashes_of, let, paired, set_aside, words_of

WINDOW = 8
FEW_WORDS = 20
REPEATED_PERCENT = 30
#: Mean log ratio per n-gram, in nats, under which a document is rejected: it looks unlike the trusted text.
THRESHOLD = -0.15
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "toxicity", "base_failed", "kept")


def repeated_words(hashes: Column, bigrams: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the text."""

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def again(p: Column) -> Column:
            same = lambda k, x: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
            return F.filter(p, lambda x, k: same(k - 1, x) | same(k + 1, x))

        starts = F.sort_array(F.transform(let(placed, again), lambda x: x["i"]))
        # Starts rise, so each adds the words that lie beyond the end reached so far.
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda a, i: F.struct(
            (a["n"] + (i + WINDOW) - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end"))
        return F.aggregate(starts, zero, step, lambda a: a["n"].cast("long"))

    def count(fours: Column) -> Column:
        # A window found again repeats its five runs of four words; most texts have too few such runs to look further.
        none = F.size(fours) - F.size(F.array_distinct(fours)) < WINDOW // 2 + 1
        return F.when(none, F.lit(0).cast("long")).otherwise(let(paired(fours, 4, F.size(hashes) - (WINDOW - 1)), covered))

    return let(paired(bigrams, 2, F.size(hashes) - 3), count)


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda found: (F.size(found) - F.size(F.array_distinct(found))).cast("long"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the counts, ``llr``, ``base_failed`` and ``kept`` of every row."""
    ratios = model.fit(docs, model.trusted_ids(labels))
    ratios_toxic, most = model.fit_toxic(docs, labels) or (None, 0.0)
    text = F.coalesce(F.col("text"), F.lit(""))

    def measures(words: Column) -> Column:
        def of(hashes: Column, bigrams: Column) -> Column:
            return F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                repeated_words(hashes, bigrams).alias("n_repeat_words"),
                F.when(F.size(hashes) > 0, model.ratio_sum(hashes, bigrams, ratios) / (model.UNIT * model.grams(hashes)))
                .otherwise(F.lit(0.0)).alias("llr"),
                (F.lit(0.0) if ratios_toxic is None else model.toxicity(hashes, bigrams, ratios_toxic)).alias("toxicity"),
            )

        return let(hashes_of(words), lambda h: let(bigram_hashes(h), lambda g: of(h, g)))

    def judged(m: Column) -> Column:
        n, repeats = m["n_words"], m["n_repeat_words"]
        failed = (n < FEW_WORDS) | (100 * repeats > REPEATED_PERCENT * n)
        return F.struct(
            *(m[name].alias(name) for name in ("n_words", "word_chars", "n_repeat_words", "llr", "toxicity")),
            failed.alias("base_failed"), (~failed & (m["llr"] >= threshold) & (m["toxicity"] <= most)).alias("kept"),
        )

    # The verdict is read from one value: a filter on it has the model's tables in the plan once, not for each count it looks at.
    kept = carried(docs.columns, RESULTS)
    found = docs.select(*kept, let(let(words_of(text), measures), judged).alias("__m"))
    return found.select(
        *kept, "__m.n_words", "__m.word_chars",
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"), "__m.n_repeat_words", "__m.llr", "__m.toxicity",
        "__m.base_failed", "__m.kept",
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    ours, back = set_aside(docs, RESULTS)
    return judge(ours, labels).where("kept").drop(*RESULTS).withColumnsRenamed(back)
