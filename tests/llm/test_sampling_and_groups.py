"""Resampling towards a target, centroid clustering and SimHash groups, against plain readings."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import centroids, resampling, simhash
from tallyloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
EMPTY_VECTORS = "vec_id bigint, embedding array<float>, label int"


@pytest.fixture(scope="module")
def rows(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# -- resampling ------------------------------------------------------------------------------------------------------------

def plain_grams(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain_resample(given, target):
    """Sorted rows (doc_id, n_features, weight, score, rank); rows equal in score and id in any order."""
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    s = Counter(bucket(g) for _, t in given for g in plain_grams(t)[1])
    t = Counter(bucket(g) for x in target for g in plain_grams(x)[1])
    alls, allt = sum(s.values()) + 10000, sum(t.values()) + 10000
    out = []
    for key, text in given:
        n, grams = plain_grams(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * alls / ((s[b] + 1) * allt))) for b in map(bucket, grams)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0]))
    for rank, r in enumerate(able[: 25 * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def as_resampled(frame):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in frame.collect()), key=str)


def test_resampling_against_plain_counts(spark, docs, clashing, rows):
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert as_resampled(QUERIES["op11_target_resampling"](spark, SF)) == plain_resample(rows, target)
    bench = spark.createDataFrame([(t,) for t in (None, "", "The lazy dog!", "lorem-ipsum DOLOR")], "text string")
    given, texts = [(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in bench.collect()]
    out = resampling.resample(clashing.withColumn("Weight", F.lit("own")).withColumn("tags", F.create_map(F.lit("a"), F.lit(1))), bench)
    assert as_resampled(out) == plain_resample(given, texts)
    assert {"kept", "lang", "tags"} < set(out.columns) and out.columns.count("weight") == 1 and "Weight" not in out.columns


def test_spans_are_those_of_overlapped_ngrams():
    draw = random.Random(2)
    pool = ["a", "Z", "9", "é", "Ⅳ", " ", "-", "\n", "\x00", "_", "ß", "🙂", "\x7f"]
    for _ in range(500):
        text = "".join(draw.choice(pool) for _ in range(draw.randint(0, 30)))
        found = resampling.ngram_crcs(resampling.collapsed(text), [resampling.pattern(n) for n in (1, 2)])
        assert found.tolist() == [zlib.crc32(g.encode()) for g in plain_grams(text)[1]], text
    three = resampling.ngram_crcs(resampling.collapsed("a b c d"), [resampling.pattern(3)])
    assert three.tolist() == [zlib.crc32(b"a b c"), zlib.crc32(b"b c d")]


def test_resampling_without_target_or_rows(spark, docs, no_docs):
    none = spark.createDataFrame([], "text string")
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert as_resampled(resampling.resample(docs, none)) == plain_resample(given, [])
    assert resampling.resample(no_docs, none).count() == 0


def test_ties_have_ranks_of_their_own(spark):
    same = spark.range(40).selectExpr("5L as doc_id", "repeat('one two ', 20) as text", "id as n")
    out = resampling.resample(same, same.limit(1))
    assert sorted(r["rank"] for r in out.where("rank is not null").collect()) == list(range(1, 11))
    drawn = resampling.draw(same, same.limit(1))
    assert drawn.columns == same.columns and drawn.count() == 10 and drawn.select("n").distinct().count() == 10


def test_the_sample_moves_towards_the_target(spark):
    draw = random.Random(8)
    text = lambda words: " ".join(draw.choice(words) for _ in range(60))
    near, far = [f"near{i}" for i in range(50)], [f"far{i}" for i in range(50)]
    docs = spark.createDataFrame([(i, text(near if i % 4 == 0 else far)) for i in range(400)], "doc_id bigint, text string")
    drawn = resampling.draw(docs, spark.createDataFrame([(text(near),) for _ in range(30)], "text string")).collect()
    assert len(drawn) == 100 and sum(r["doc_id"] % 4 == 0 for r in drawn) > 50


# -- clustering ------------------------------------------------------------------------------------------------------------

def plain_clusters(vectors, clusters, rounds, dims, scale=256):
    kept = []
    for key, v in vectors:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((key, tuple(math.floor(scale * x) for x in v)))
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    named = sorted((hashlib.sha256(f"2:{k}".encode()).hexdigest(), k, v) for k, v in kept if k is not None)
    centers = [v for _, _, v in named[:clusters]]
    if not centers:
        return []
    nearest = lambda v: min((far(v, c), i) for i, c in enumerate(centers))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centers = [tuple(sum(x) // len(groups[i]) for x in zip(*groups[i])) if i in groups else c for i, c in enumerate(centers)]
    out = [(k, *nearest(v)[::-1]) for k, v in kept]
    of = Counter()
    for _, i, d in out:
        of[i] += d
    return sorted(((k, i, d, of[i], sum(of.values()), centers[i]) for k, i, d in out), key=str)


def as_clusters(frame):
    return sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"])) for r in frame.collect()), key=str)


def test_clusters_against_plain_rounds(spark):
    draw = random.Random(6)
    middles = [[draw.uniform(-1, 1) for _ in range(4)] for _ in range(6)]
    vectors = [(i, [x + draw.gauss(0, 0.1) for x in draw.choice(middles)]) for i in range(300)]
    vectors += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0]), (303, [float("nan"), 0.0, 0.0, 0.0]), (304, [float("inf")] * 4),
                (305, [0.5] * 3), (None, [0.5] * 4), (7, vectors[7][1]), (7, vectors[7][1]), (8, [-0.0] * 4), (306, [2000.0, -2000.0, 0.0, 1.0])]
    frame = spark.createDataFrame([(*v, "own") for v in vectors], "vec_id bigint, embedding array<double>, cluster string").repartition(3)
    for clusters, rounds, pivots in ((9, 3, 8), (9, 0, 3), (1, 2, 8), (500, 1, 8), (9, 3, 1)):
        got = as_clusters(centroids.cluster(frame, clusters, rounds, dims=4, pivots=pivots))
        assert got == plain_clusters(vectors, clusters, rounds, 4), (clusters, rounds)


def test_clusters_of_equal_vectors_and_of_nothing(spark):
    same = [(i % 3, [0.25, -0.25]) for i in range(20)]
    frame = spark.createDataFrame(same, "vec_id bigint, embedding array<float>")
    assert as_clusters(centroids.cluster(frame, 4, 2, dims=2)) == plain_clusters(same, 4, 2, 2)
    assert centroids.cluster(spark.createDataFrame([], EMPTY_VECTORS)).count() == 0
    assert centroids.cluster(spark.createDataFrame([(None, [0.1] * 64, 1)], EMPTY_VECTORS)).count() == 0


def test_bounds_are_never_above_the_distance():
    draw = np.random.Generator(np.random.PCG64(3))
    for size in (1, 40, 5000, 2**24):
        x, c = draw.integers(-size, size, (200, 8)), draw.integers(-size, size, (20, 8))
        c[:5] = x[:5]
        pivots = np.concatenate([c[:3], draw.integers(-size, size, (4, 8))])
        pivots = centroids.choose_pivots(pivots, 6)
        far = centroids.squares(x, pivots)
        between = np.sqrt(centroids.squares(pivots, pivots))
        bounds = centroids.lower_bounds(np.sqrt(far), np.sqrt(centroids.squares(c, pivots)), between)
        exact = centroids.squares(x, c)
        assert (bounds <= exact).all()
        number, least, checked = centroids.nearest(x, np.sqrt(far), c, pivots)
        assert (number == exact.argmin(1)).all() and (least == exact.min(1)).all() and len(x) <= checked <= exact.size


def test_bounds_spare_distances_where_vectors_cluster():
    draw = np.random.Generator(np.random.PCG64(4))
    middles = draw.integers(-200, 200, (20, 16))
    x = np.repeat(middles, 50, 0) + draw.integers(-3, 4, (1000, 16))
    pivots = centroids.choose_pivots(middles, 8)
    _, _, checked = centroids.nearest(x, np.sqrt(centroids.squares(x, pivots)), middles, pivots)
    assert checked < 2 * len(x)


# -- SimHash ---------------------------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    width = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(given):
    """Sorted rows (doc_id, fingerprint, component_id), by comparing all pairs."""
    prints = [plain_fingerprint(t) for _, t in given]
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(distinct, 2):
        if (a ^ b).bit_count() <= 3:
            root[top(b)] = top(a)
    smallest = {}
    for (key, _), p in zip(given, prints):
        if key is not None:
            smallest[top(p)] = min(key, smallest.get(top(p), key))
    return sorted(((key, f"{p:016x}", smallest.get(top(p))) for (key, _), p in zip(given, prints)), key=str)


def as_components(frame):
    return sorted(((r["doc_id"], f"{r['fp'] % 2**64:016x}", r["component_id"]) for r in frame.collect()), key=str)


def test_simhash_against_all_pairs(spark, docs, clashing, no_docs, rows):
    got = QUERIES["op13_simhash"](spark, SF).collect()
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == plain_components(rows)
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for most in (simhash.MOST, 1):
        assert as_components(simhash.near_duplicates(clashing.withColumn("FP", F.lit(1)), most)) == plain_components(given)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_masks_cover_every_pair_within_the_radius():
    for masks, bits in ((simhash.MASKS, range(64)), *((s, [i for i in range(64) if not m >> i & 1]) for s, m in zip(simhash.SECOND, simhash.MASKS))):
        places = list(itertools.combinations(bits, simhash.RADIUS))
        for differ in places if len(bits) < 64 else random.Random(1).sample(places, 6000):
            value = sum(1 << i for i in differ)
            assert any(not m & value for m in masks)
    # The proven bound of a bucket of the second level.
    assert max(64 - m.bit_count() for masks in simhash.SECOND for m in masks) <= 16


def test_buckets_with_many_fingerprints(spark):
    draw = random.Random(9)
    # Thousands of fingerprints that agree in 40 bits, chains among them, and others far away.
    base, prints = draw.getrandbits(64), set()
    while len(prints) < 3000:
        p = base
        for _ in range(draw.randint(0, 12)):
            p ^= 1 << draw.randrange(24)
        prints.add(p)
    prints |= {draw.getrandbits(64) for _ in range(500)}
    numbers = sorted(simhash.signed(p) for p in prints)
    classes = spark.createDataFrame([(p,) for p in numbers], "fp bigint")
    fp = np.array(numbers, np.int64)
    root = list(range(len(fp)))

    def top(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i in range(len(fp)):
        for j in i + 1 + np.flatnonzero(np.bitwise_count(fp[i + 1 :] ^ fp[i]) <= 3):
            a, b = sorted((top(i), top(int(j))))
            root[b] = a
    expected = {numbers[i]: numbers[top(i)] for i in range(len(fp)) if top(i) != i}
    for most in (100, 5000):
        met = simhash.buckets(classes, most).repartition(5, "bucket", "key").sortWithinPartitions("bucket", "key", "fp")
        if most == 100:
            assert met.where("bucket < 15").groupBy("bucket", "key").count().agg(F.max("count")).first()[0] <= most
        found = simhash.components(met.mapInArrow(simhash.links, "cls bigint, root bigint"))
        assert {r["cls"]: r["root"] for r in found.collect()} == expected


def test_one_document_of_each_component_stays(clashing, docs):
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    groups = {c for _, _, c in plain_components([(r["doc_id"], r["text"]) for r in docs.collect()])}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(groups, key=str)
