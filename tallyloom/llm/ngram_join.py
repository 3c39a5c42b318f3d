"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification.

A text's set are the hashes of its runs of ``SHINGLE`` words (of all its words, if they are fewer). Texts with equal sets are one
class, joined once for all copies. Classes that agree in a whole band of MinHash values are candidates. A pair's values are then
compared in steps; after each step it is dropped if, under a flat prior, the posterior probability that its similarity reaches
``THRESHOLD`` is below ``TOLERANCE``. The Jaccard similarity of the rest is computed exactly from the sets.

A band's bucket is cut into cells of two bounded blocks, so a hot bucket is many tasks' work. Pairs never leave a cell: it
returns, for each class, how many documents it links to and one edge to the smallest class it is connected with. Buckets
with the same members are compared once, and a pair only in the first band where it agrees. With ``BANDS`` bands of ``ROWS``
values a pair of similarity 0.8 is missed with probability 3e-6, and more similar ones far less often.

Defined results: texts without words are in no group and have no links. Null ids may be in a group; a group's id is its
smallest id that is not null. Repeated rows are copies of each other. Other columns play no part.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.bpe_codec import column_batches
from tallyloom.operators.joins import skew_join
from tallyloom.session import settle

SHINGLE, THRESHOLD = 5, (4, 5)
BANDS, ROWS = 32, 5
STEP, TOLERANCE = 32, 1e-7
#: Classes and shingles that one block of a cell holds, on average.
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 2_000_000
BROADCAST_ROWS = 500_000
SKETCH = "doc_id bigint, th bigint, cls binary, n bigint, sig binary"
_RANDOM = np.random.Generator(np.random.PCG64(11))
FACTORS = _RANDOM.integers(0, 2**32, BANDS * ROWS, np.uint32) | np.uint32(1)
SHIFTS = _RANDOM.integers(0, 2**32, BANDS * ROWS, np.uint32)
POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 2**64)) for k in range(SHINGLE)]


class WordHashes(dict):
    """Remembers the hash of each word, for so many words."""

    MOST = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray, shift: int = 0) -> np.ndarray:
    x = x + np.uint64((0x9E3779B97F4A7C15 * (shift + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of the runs of words; words are separated by space and U+0009 to U+000D."""
    words = (text or "").encode().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(h))
    last = len(h) - width + 1
    total = np.full(last, np.uint64(width), np.uint64)
    for k in range(width):
        total += h[k : k + last] * POWERS[k]
    return np.unique(mixed(total))


def minhashes(found: np.ndarray) -> np.ndarray:
    low = (found >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(FACTORS), 2**32 - 1, np.uint32)
    for at in range(0, len(low), 512):
        part = low[at : at + 512] * FACTORS[:, None]
        part += SHIFTS[:, None]
        np.minimum(best, part.min(1), out=best)
    return best


def digest(found: np.ndarray) -> bytes:
    """128 bits of the whole set."""
    return np.array([mixed(found).sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(found, 1))], ">u8").tobytes()


def sketches(docs: DataFrame) -> DataFrame:
    """For each row: hash of the text, class, size of the set and MinHash values; class null without words."""

    def run(batches):
        hashes = WordHashes()
        for batch, texts in column_batches(batches, "text"):
            cls, n, sig = [], [], []
            for text in texts:
                found = shingles(text, hashes)
                n.append(len(found))
                cls.append(digest(found) if len(found) else None)
                sig.append(minhashes(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(cls, pa.binary()), pa.array(n, pa.int64()), pa.array(sig, pa.binary())],
                ["doc_id", "th", "cls", "n", "sig"])

    return keyed(docs).select("doc_id", "th", "text").mapInArrow(run, SKETCH)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("th", F.xxhash64("text"))


def least_matches() -> list[int]:
    """For 1, 2, ... steps: the fewest equal values with which a pair is kept.

    With a flat prior and m of k values equal, the similarity is Beta(m + 1, k - m + 1), so the chance that it reaches t is
    that of at most m successes in k + 1 trials of probability t.
    """
    t, out = THRESHOLD[0] / THRESHOLD[1], []
    for k in range(STEP, BANDS * ROWS + 1, STEP):
        below, m = 0.0, -1
        while below < TOLERANCE:
            m += 1
            below += comb(k + 1, m) * t**m * (1 - t) ** (k + 1 - m)
        out.append(m)
    return out


LEAST = least_matches()


def links_of(sig: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, band: int):
    """Linked pairs (i, j) between the rows ``left`` and ``right`` (the same rows: each pair once) that first agree in ``band``."""
    same = left is right
    sizes = np.array([len(s) for s in sets], np.int64)
    for place, i in enumerate(left):
        alive = right[place + 1 :] if same else right
        matches = np.zeros(len(alive), np.int64)
        for step, least in enumerate(LEAST):
            if not len(alive):
                break
            part = slice(step * STEP, (step + 1) * STEP)
            matches += (sig[alive, part] == sig[i, part]).sum(1)
            keep = matches >= least
            alive, matches = alive[keep], matches[keep]
        if not len(alive):
            continue
        agree = (sig[alive] == sig[i]).reshape(len(alive), BANDS, ROWS).all(2)
        alive = alive[agree.argmax(1) == band]
        few, many = np.minimum(sizes[alive], sizes[i]), np.maximum(sizes[alive], sizes[i])
        alive = alive[few * THRESHOLD[1] >= many * THRESHOLD[0]]
        if not len(alive):
            continue
        values = np.concatenate([sets[j] for j in alive])
        at = np.minimum(np.searchsorted(sets[i], values), len(sets[i]) - 1)
        starts = np.cumsum(sizes[alive]) - sizes[alive]
        common = np.add.reduceat((sets[i][at] == values).astype(np.int64), starts)
        linked = common * THRESHOLD[1] >= (sizes[alive] + sizes[i] - common) * THRESHOLD[0]
        for j in alive[linked]:
            yield i, int(j)


def compare(cell: pa.Table) -> pa.Table:
    """For each class of the cell that has links: ``links`` (documents) and ``root``, the smallest class it is connected with."""
    order = np.argsort(np.array(cell.column("cls").to_pylist(), object), kind="stable")
    cell = cell.take(pa.array(order))
    cls, copies = cell.column("cls").to_pylist(), cell.column("copies").to_numpy()
    block = cell.column("block").to_numpy()
    sig = np.array([np.frombuffer(s, np.uint32) for s in cell.column("sig").to_pylist()])
    sets = [np.frombuffer(s, np.uint64) for s in cell.column("shingles").to_pylist()]
    lo, hi = cell.column("lo")[0].as_py(), cell.column("hi")[0].as_py()
    left = np.flatnonzero(block == lo)
    right = left if lo == hi else np.flatnonzero(block == hi)
    links, root = np.zeros(len(cls), np.int64), list(range(len(cls)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i, j in links_of(sig, sets, left, right, cell.column("band")[0].as_py()):
        links[i] += copies[j]
        links[j] += copies[i]
        a, b = sorted((top(i), top(j)))
        root[b] = a
    found = np.flatnonzero(links)
    return pa.table({
        "cls": pa.array([cls[i] for i in found], pa.binary()), "links": pa.array(links[found], pa.int64()),
        "root": pa.array([cls[top(i)] for i in found], pa.binary()),
    })


def small(rows: DataFrame) -> DataFrame:
    """Broadcast if there are few rows (some 100 bytes each); the same join runs shuffled beyond that."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def components(edges: DataFrame) -> DataFrame:
    """``cls`` and ``root``, the smallest class connected with it, for all classes in ``edges`` (columns ``cls``, ``root``).

    Alternating stars: every class points its larger neighbours, then its smaller ones, to the smallest it knows, until nothing
    changes. Every round is cut off by a checkpoint. A class may have any number of neighbours: the joins can be split.
    """
    state = settle(edges.where("cls <> root").distinct())
    mark = None
    while True:
        both = state.select(F.col("cls").alias("u"), F.col("root").alias("v")).unionByName(
            state.select(F.col("root").alias("u"), F.col("cls").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = skew_join(both.where("v > u"), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = skew_join(large, least, "u").where("v <> m").select(F.col("v").alias("cls"), F.col("m").alias("root"))
        state = settle(small.unionByName(least.select(F.col("u").alias("cls"), F.col("m").alias("root"))).distinct())
        now = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("cls", "root"))).first()
        if now == mark:
            return state
        mark = now


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``th`` (hash of the text), ``grp`` (null without words), ``class_id``, ``n_links``."""
    rows = settle(sketches(docs))
    known = rows.where("cls is not null")
    classes = known.groupBy("cls").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "th")).alias("rep"),
        F.min("sig").alias("sig"), F.min("n").alias("n"))

    place = F.posexplode(F.expr(f"transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, substring(sig, b * {4 * ROWS} + 1, {4 * ROWS})))"))
    bands = classes.select("cls", "n", place.alias("band", "key"))
    buckets = bands.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("size"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "cls")).alias("y"))
    # The same members in several bands: the first band alone.
    first = buckets.where("members > 1").groupBy("members", "size", "x", "y").agg(F.min(F.struct("band", "key")).alias("b"))
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK_CLASSES, F.col("size") / BLOCK_SHINGLES)).cast("int")
    kept = first.select("b.band", "b.key", blocks.alias("blocks"))
    members = bands.join(kept, ["band", "key"]).select(
        "cls", "band", "key", F.pmod(F.xxhash64(F.lit(2), "cls"), F.col("blocks")).cast("int").alias("block"), "blocks")
    members = settle(members)

    # Texts of the classes that have a candidate; set and values are computed again from the text, and the class with them.
    wanted = members.select("cls").distinct().join(classes.select("cls", "rep", "copies"), "cls")
    wanted = settle(wanted.select(F.col("rep.doc_id").alias("__id"), F.col("rep.th").alias("__th"), "cls", "copies"))
    texts = keyed(docs).select("doc_id", "th", "text")
    texts = texts.join(small(wanted), texts["doc_id"].eqNullSafe(wanted["__id"]) & (texts["th"] == wanted["__th"]))

    def sets(batches):
        hashes = WordHashes()
        for batch, texts in column_batches(batches, "text"):
            found = [shingles(t, hashes) for t in texts]
            right = [digest(s) == c for s, c in zip(found, batch.column("cls").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls"), batch.column("copies"), pa.array([minhashes(s).tobytes() for s in found], pa.binary()),
                 pa.array([s.tobytes() for s in found], pa.binary())],
                ["cls", "copies", "sig", "shingles"]).filter(pa.array(right, pa.bool_()))

    full = texts.select("text", "cls", "copies").mapInArrow(sets, "cls binary, copies bigint, sig binary, shingles binary")
    full = full.dropDuplicates(["cls"])
    cells = members.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("cls", "band", "key", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    linked = settle(cells.join(full, "cls").groupBy("band", "key", "lo", "hi").applyInArrow(compare, "cls binary, links bigint, root binary"))

    groups = components(linked.select("cls", "root"))
    totals = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    of_class = classes.select("cls", "copies", "first").join(totals, "cls", "left").join(groups, "cls", "left").select(
        "cls", "first", F.coalesce("root", "cls").alias("grp"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    of_class = settle(of_class)
    smallest = of_class.groupBy("grp").agg(F.min("first").alias("class_id"))
    of_class = skew_join(of_class, smallest, "grp").select("cls", "grp", "class_id", "n_links")
    return rows.select("doc_id", "th", "cls").join(of_class, "cls", "left").select(
        "doc_id", "th", "grp", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, the one of smallest id, and all documents without words; columns as they came."""
    rows = near_duplicates(docs).where("grp is not null").groupBy("grp", "doc_id", "th").agg(F.count(F.lit(1)).alias("n"))
    chosen = rows.groupBy("grp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th", "n")).alias("c"))
    chosen = settle(chosen.select(F.col("c.doc_id").alias("__id"), F.col("c.th").alias("__chosen"), (F.col("c.n") > 1).alias("__many")))
    own = docs.withColumn("__th", F.xxhash64("text")).withColumn("__words", F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    kept = own.where("__words").join(small(chosen), own["doc_id"].cast("long").eqNullSafe(chosen["__id"]) & (own["__th"] == chosen["__chosen"]))
    # Only rows that occur again are gathered, to keep one of them.
    once = kept.where("not __many").unionByName(kept.where("__many").dropDuplicates(["doc_id", "__th"]))
    return once.select(*docs.columns).unionByName(own.where("not __words").select(*docs.columns))
