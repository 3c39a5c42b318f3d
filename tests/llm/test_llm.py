"""The operators on awkward rows, and their queries on the smallest tables, against plain readings."""

from __future__ import annotations

import hashlib
import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from tallyloom.llm import (  # noqa: E402
    bpe_codec, exact_topk, license_scan, ngram_join, ngram_model, offsets, packing, pii, quality_classifier, quality_rules, ranks, sharding,
    token_counts,
)
from tallyloom.llm.lexicon import Lexicon, compile_words  # noqa: E402
from tallyloom.llm.queries import QUERIES, VOCABULARY  # noqa: E402
from tallyloom.llm.word_bpe import Encoder, WordBpe  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def bpe():
    return WordBpe(Path(VOCABULARY).read_bytes())


@pytest.fixture(scope="module")
def rows(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def expected_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


# -- quality rules and classifier ------------------------------------------------------------------------------------------

def test_rules_count_as_plain_python_does(spark, docs, labels, rows):
    for frame, given in ((docs, labels), (spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))):
        for r in quality_rules.judge(frame, given).collect():
            for name, value in brute.rules(r["text"]).items():
                assert r[name] == value, (r["doc_id"], name)
            assert not (r["base_failed"] and r["kept"])


def test_windows_that_overlap_themselves(spark, labels):
    texts = ["a " * 9, "a b " * 6, " ".join("abcdefgh") + " x " + " ".join("abcdefgh") + " y", " ".join("abcdefg") + " x " + " ".join("abcdefg")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.judge(docs, labels).collect()}
    assert got == {i: brute.rules(t)["n_repeat_words"] for i, t in enumerate(texts)}


def test_rules_keep_columns_and_take_no_labels_and_no_rows(clashing, no_docs, labels):
    kept = quality_rules.keep_good(clashing, labels.limit(0))
    assert kept.columns == clashing.columns
    # Without labels the base rules decide alone.
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 2, 3]
    assert quality_rules.judge(no_docs, labels).count() == 0


def test_rules_reject_junk_that_labels_show(spark):
    good = [(i, " ".join(f"word{(i * 7 + j * j) % 50}" for j in range(60))) for i in range(40)]
    junk = [(100 + i, " ".join(f"word{(i * 5 + j * j) % 50}%%%" for j in range(60))) for i in range(40)]
    docs = spark.createDataFrame(good + junk, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)], "doc_id bigint, quality int, toxic int")
    ids = {r["doc_id"] for r in quality_rules.judge(docs, labels).where("kept or base_failed").collect()}
    assert ids >= set(range(40)) and not ids & {k for k, t in junk if not brute.rules(t)["base_failed"]}
    selected = {r["doc_id"] for r in quality_classifier.resample(docs, labels).where("selected").collect()}
    assert len(selected & set(range(40))) >= 36 and len(selected & set(range(100, 140))) < 4


def test_rules_reject_toxic_text_that_labels_show(spark):
    draw = random.Random(4)
    text = lambda: [f"word{draw.randint(0, 40)}" for _ in range(200)]
    rows = [(i, " ".join(text())) for i in range(300)]
    for i in range(300, 360):
        words = text()
        for at in (20, 90, 150):
            words[at] = draw.choice(["zounderkite", "gobermouch"])
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, int(i >= 300)) for i in range(0, 360, 2)], "doc_id bigint, quality int, toxic int")
    # In so small a corpus the smoothing lowers the first ratio of every text, so it is left out here.
    unseen = {r["doc_id"] for r in quality_rules.judge(docs, labels, threshold=-1.0).where("kept and doc_id % 2 = 1").collect()}
    assert not [k for k in unseen if k >= 300] and len(unseen) >= 145


def test_sample_has_k_rows_of_the_largest_keys(docs, clashing, no_docs, labels, spark):
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    known = spark.read.parquet(f"{SF}/labels.parquet")
    for k in (1, 17, 150, 10_000):
        out = quality_classifier.resample(whole, known, k=k).collect()
        keys = sorted((r["sample_key"] for r in out), reverse=True)
        least = keys[min(k, len(keys)) - 1]
        assert {r["doc_id"] for r in out if r["selected"]} == {r["doc_id"] for r in out if r["sample_key"] >= least}
    assert quality_classifier.keep_selected(clashing, labels).columns == clashing.columns
    assert quality_classifier.resample(no_docs, labels, k=3).count() == 0
    # Nothing is held out without labels, so nothing is rejected.
    assert quality_classifier.resample(docs, labels.limit(0)).where("selected").count() == docs.count()


def test_the_query_draws_the_k_largest_keys(spark, monkeypatch):
    drawn, kth_key = [], quality_classifier.kth_key
    monkeypatch.setattr(quality_classifier, "kth_key", lambda keys, k: drawn.append((k, kth_key(keys, k))) or drawn[-1][1])
    out = QUERIES["op10_quality_classifier"](spark, SF).collect()
    (k, least), = drawn
    keys = sorted((r["sample_key"] for r in out), reverse=True)
    assert 0 < k < len(keys) and keys[k - 1] == least
    assert sum(r["selected"] for r in out) == k and all(r["selected"] == (r["sample_key"] >= least) for r in out)
    half = F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(2))
    held = {r[0] for r in ngram_model.trusted_ids(spark.read.parquet(f"{SF}/labels.parquet")).where(half == 1).collect()}
    cut = np.quantile([r["sample_key"] for r in out if r["doc_id"] in held], 1 - quality_classifier.KEEP)
    assert held and k == sum(x >= cut for x in keys)


def test_every_label_counts(spark, labels):
    many = spark.range(20_500).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") % 2).cast("int").alias("toxic"))
    assert ngram_model.trusted_ids(many).count() == ngram_model.toxic_ids(many).count() == 10_250
    clean = many.withColumn("toxic", F.lit(0))
    assert ngram_model.trusted_ids(clean).count() == 20_500 and ngram_model.toxic_ids(clean.withColumn("toxic", F.lit(1))).count() == 20_500
    docs = clean.select("doc_id", F.lit("a b").alias("text"))
    assert {(r["raw"], r["target"]) for r in ngram_model.bucket_counts(docs, ngram_model.trusted_ids(clean)).collect()} == {(20_500, 20_500)}
    for ids in ("bigint", "int"):  # joined shuffled
        given = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "x"), (9, "x"), (None, "x")], f"doc_id {ids}, text string")
        marked = ngram_model.mark_trusted(given, ngram_model.trusted_ids(labels), "known", max_bytes=0).collect()
        assert len(marked) == 6 and sorted((r["doc_id"], r["text"]) for r in marked if r["known"]) == [(1, "x"), (1, "y"), (3, "x")]


def test_quantiles_are_those_of_percentile(spark):
    draw = random.Random(9)
    for values in ([0.25], [1.0, 2.0], [3.0] * 50, [-1e-300, 0.0, 5e-324, 1e300, -1e300], [draw.gauss(0, 1) for _ in range(9000)] + [0.5] * 9000):
        given = spark.createDataFrame([(v,) for v in values], "x double")
        for share in (0.0, 0.005, 0.5, 0.995, 1.0):
            assert ranks.quantile(given, "x", share) == given.agg(F.percentile("x", F.lit(share))).first()[0]
    assert ranks.quantile(given.limit(0), "x", 0.5) is None


# -- encoding and packing --------------------------------------------------------------------------------------------------

def test_lexicon_is_exact_and_minimal():
    words = [w.encode() for w in ("", "a", "ab", "abc", "b", "xbc", "ybc", "é", "nation", "station", "ration")]
    entries = [(w, np.arange(i, dtype="<u4").tobytes()) for i, w in enumerate(words)]
    lexicon = Lexicon(compile_words(entries))
    assert lexicon.lookup(words[1:]) == [ids for _, ids in entries[1:]]
    assert lexicon.lookup([b"abcd", b"x", b"zz", b"natio"]) == [None] * 4
    # Shared suffixes: nation, station and ration end in the same edges.
    one = Lexicon(compile_words([(b"nation", b"")]))
    three = Lexicon(compile_words([(w, b"") for w in (b"nation", b"ration", b"station")]))
    assert len(three.keys) == len(one.keys) + 3
    assert Lexicon(compile_words([])).lookup([b"a"]) == [None]


def test_encoder_agrees_with_the_library(bpe, tokenizer, rows):
    draw = random.Random(5)
    pool = ["a", "th", "in", "'s", "'S", "İ", "Σ", "ς", "é", "é", "<|startoftext|>", "<|endof", "\x1c", "\x85", " ", "​", "1", "²", "\n",
            " ", "!", "中", "🙂", "ǅ", "\x00", "x" * 100, "Ɤ", "the" * 20]
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 30))) for _ in range(1500)] + [t for _, t in rows]
    words = sorted({w for t in texts for c in [bpe.pieces(bpe.chunks(t))] for w in c[1]})[::2]
    lexicon = Lexicon(compile_words(list(bpe.merge([w.encode() for w in words]).items())))
    for encoder in (Encoder(bpe), Encoder(bpe, lexicon)):
        for text, ids in zip(texts, encoder.encode(texts)):
            expected = expected_ids(tokenizer, text)
            assert np.frombuffer(ids, "<u4").tolist() == expected
            assert encoder.decode(ids) == tokenizer.decode(expected, skip_special_tokens=False)


def test_codec_on_awkward_rows(spark, docs, clashing, no_docs, tokenizer):
    shared = bpe_codec.vocabulary(spark, VOCABULARY)
    out = bpe_codec.decode(bpe_codec.encode(clashing, shared, bpe_codec.fit_lexicon(clashing, shared)), shared)
    assert set(out.columns) == {*clashing.columns, "decoded"}
    for r in out.collect():
        expected = expected_ids(tokenizer, r["text"])
        assert np.frombuffer(r["ids"], "<u4").tolist() == expected
        assert r["decoded"] == tokenizer.decode(expected, skip_special_tokens=False)
    assert bpe_codec.encode(no_docs, shared, bpe_codec.fit_lexicon(no_docs, shared)).count() == 0


def test_word_summary_keeps_the_frequent_words(spark):
    text = " ".join(f"rare{i} often" for i in range(2000))
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string").coalesce(1)
    shared = bpe_codec.vocabulary(spark, VOCABULARY)
    whole, short = ({r["word"]: r["n"] for r in bpe_codec.word_counts(docs, shared, n).collect()} for n in (bpe_codec.SUMMARY, 50))
    assert whole["often"] == whole["rare"] == 2000
    # Counted by chunk: 2,001 of them, of which the summary keeps those that are more than the 26th.
    assert short == {"often": 1999}


def check_pieces(pieces, given, tokenizer, window):
    """Every id of every document in exactly one piece, sequences full but the last, no gap."""
    expected = Counter()
    for key, text in given:
        expected[key, tuple([*expected_ids(tokenizer, text), packing.END_ID])] += 1
    sequences = defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] and p["length"] > 0
        sequences[p["sequence_id"]].append(p)
    assert sorted(sequences) == list(range(len(sequences)))
    row = []
    for number in sorted(sequences):
        at = 0
        for p in sorted(sequences[number], key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
            row.append(p)
        assert at == window or number == len(sequences) - 1
    got, current = Counter(), []
    for p in row:
        assert p["start"] == len(current) and p["continues_document"] == (p["start"] > 0)
        current += np.frombuffer(p["ids"], "<u4").tolist()
        assert p["continued"] == (len(current) < p["doc_tokens"])
        if not p["continued"]:
            got[p["doc_id"], tuple(current)] += 1
            current = []
    assert not current and got == expected


@pytest.mark.parametrize("window", [7, 2048])
def test_packing(spark, docs, clashing, tokenizer, rows, window):
    shared = bpe_codec.vocabulary(spark, VOCABULARY)
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    pieces = packing.pack(clashing.repartition(3), shared, window)
    check_pieces(pieces.collect(), given, tokenizer, window)
    if window == 2048:
        check_pieces(packing.pack(spark.read.parquet(f"{SF}/documents.parquet").repartition(5), shared).collect(), rows, tokenizer, window)
        whole = packing.sequences(pieces, window).collect()
        assert all(len(s["ids"]) == 4 * window for s in whole)


def test_packing_nothing(spark, no_docs):
    assert packing.pack(no_docs, bpe_codec.vocabulary(spark, VOCABULARY)).count() == 0


def test_running_offsets_over_several_groups(spark):
    n = 3 * offsets.GROUP + 5
    totals = spark.range(n).where("id % 3 <> 1").selectExpr("id as part", "id % 11 as total")
    got = {r["part"]: r["at"] for r in offsets.running_offsets(totals, "part", "total", "at").collect()}
    at = 0
    for i in range(n):
        if i % 3 != 1:
            assert got[i] == at
            at += i % 11
    assert offsets.join_offsets(totals, offsets.running_offsets(totals, "part", "total", "at"), "part", 10**9).count() == len(got)


# -- sharding --------------------------------------------------------------------------------------------------------------

def check_shards(out, total, shards):
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert sum(sizes) == total and max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())


def test_sharding(spark, docs, clashing, no_docs):
    for frame, seed in ((clashing, 1), (spark.read.parquet(f"{SF}/documents.parquet"), 2)):
        out = sharding.shard(frame, 5, seed, bucket_bytes=20_000)
        assert set(out.columns) == {*frame.columns, *sharding.RESULTS}
        check_shards(out.collect(), frame.count(), 5)
        assert out.select("doc_id", "text").exceptAll(frame.select("doc_id", "text")).isEmpty()
        again = sharding.shard(frame.repartition(7), 5, seed, bucket_bytes=20_000)
        assert out.select("doc_id", "shard", "slot").dropDuplicates().exceptAll(again.select("doc_id", "shard", "slot").dropDuplicates()).count() <= 4
    assert sharding.shard(no_docs, 5).count() == 0


def test_equal_rows_are_spread_over_buckets(spark):
    same = spark.range(3000).selectExpr("1L as doc_id", "'same' as text").unionByName(
        spark.range(6000).selectExpr("id as doc_id", "concat('t', id) as text"))
    scattered, rows, buckets = sharding.scatter(same, 3, 5000)
    most = max(r["count"] for r in scattered.groupBy("__bucket").count().collect())
    assert rows == 9000 and most < 3 * rows / buckets
    check_shards(sharding.shard(same, 24, 3, 5000).collect(), 9000, 24)


# -- n-gram join -----------------------------------------------------------------------------------------------------------

def near_copies(n, seed):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def as_found(frame):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in frame.collect()), key=str)


def test_join_against_all_pairs(spark, docs, clashing, rows, no_docs):
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert as_found(ngram_join.near_duplicates(clashing)) == sorted(brute.groups(given), key=str)
    assert as_found(ngram_join.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet"))) == sorted(brute.groups(rows), key=str)
    assert ngram_join.near_duplicates(no_docs).count() == 0


def test_a_hot_group_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 16)
    texts = near_copies(150, 1) + near_copies(3, 2) + near_copies(40, 3)
    given = list(enumerate(texts))
    docs = spark.createDataFrame(given, "doc_id bigint, text string")
    assert as_found(ngram_join.near_duplicates(docs)) == sorted(brute.groups(given), key=str)


def test_components_of_long_chains(spark):
    names = [f"{i:04d}".encode() for i in range(200)]
    edges = [(names[i + 1], names[i]) for i in range(120)] + [(names[199], names[150])]
    found = ngram_join.components(spark.createDataFrame(edges, "cls binary, root binary"))
    got = {bytes(r["cls"]): bytes(r["root"]) for r in found.collect()}
    assert got == {**{names[i]: names[0] for i in range(1, 121)}, names[199]: names[150]}


def test_one_document_of_each_group_stays(docs, clashing):
    kept = ngram_join.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 4, 5, 6, None, None, 7, 8, 9, 10, 11], key=str)


def test_pruning_table_follows_the_posterior():
    for step, least in enumerate(ngram_join.LEAST):
        k = (step + 1) * ngram_join.STEP
        assert 0 < least < 0.8 * k
        assert least <= ngram_join.LEAST[-1]


# -- personal data ---------------------------------------------------------------------------------------------------------

def spans_of(r, *kinds):
    return [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in kinds]


def test_patterns(spark, docs, rows):
    draw = random.Random(3)
    pool = ["a", "@", ".", "-", "+", " ", "1", "23", "255", "256", "4111111111111111", "(", ")", "x.y", "\t", "é"]
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 25))) for _ in range(5000)] + [t for _, t in rows]
    for text in texts:
        assert pii.base_spans(text) == brute.personal(text), text
    for r in pii.find(docs).collect():
        assert spans_of(r, *pii.KINDS[:4]) == brute.personal(r["text"])


def test_long_runs_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 100_000, "1 " * 150_000):
        assert isinstance(pii.base_spans(text), list)


def test_terms_that_give_an_entity_away(spark, monkeypatch):
    fill = [f"common{i}" for i in range(30)]
    draw = random.Random(1)
    words = lambda n: " ".join(draw.choice(fill) for _ in range(n))
    texts = [f"{words(6)} Zorblatt jo@x.example {words(6)}" for _ in range(5)] + [words(40) for _ in range(40)]
    texts += [f"{words(3)} once{i} other{i}@x.example {words(3)}" for i in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for limit in (200_000, 1):  # one pass, and a pass for each pair
        monkeypatch.setattr(pii, "PAIRS_PER_PASS", limit)
        for r in pii.find(docs).collect():
            found = {r["text"][s:e] for _, s, e in spans_of(r, "term")}
            assert found == ({"Zorblatt"} if r["doc_id"] < 5 else set())
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "<TERM> <EMAIL>" in clean[0] and clean[7] == texts[7]


def test_terms_beside_entities_seen_once_or_copied(spark):
    draw = random.Random(2)
    fill = ["alpha", "bravo", "carol", "delta", "early", "fetch", "given", "haste"]
    words = lambda n: " ".join(draw.choice(fill) for _ in range(n))
    copied = f"{words(6)} Marbeck ma@x.example {words(6)}"
    texts = [f"{words(6)} Quillon once@x.example {words(6)}", *(f"{words(4)} Tarvish 4111 1111 1111 1111 {words(4)}" for _ in range(2))]
    texts += [copied] * 50 + [words(500) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in pii.find(docs).collect():
        found = {r["text"][s:e] for _, s, e in spans_of(r, "term")}
        assert found == ({"Quillon"} if r["doc_id"] < 1 else {"Tarvish"} if r["doc_id"] < 3 else {"Marbeck"} if r["doc_id"] < 53 else set())


def test_sanitised_rows_keep_their_columns(docs, clashing, no_docs):
    out = pii.sanitise(clashing)
    assert out.columns == clashing.columns and out.count() == clashing.count()
    by = {r["doc_id"]: r for r in out.collect()}
    assert by[7]["text"] == "Écrivez à <EMAIL> ou <PHONE>, ip 10.0.0.256 et <IP> 🙂" and by[7]["n_chars"] == len(by[7]["text"])
    assert by[4]["text"] is None and by[7]["spans"] == "own"
    assert pii.sanitise(no_docs).count() == 0
    assert pii.replaced("abcdef", [{"kind": "ip", "start": 1, "end": 4}, {"kind": "card", "start": 2, "end": 5}]) == "a<IP>f"


# -- search, counts, licences ----------------------------------------------------------------------------------------------

def test_topk_on_awkward_vectors(spark, monkeypatch):
    draw = random.Random(2)
    vectors = [(i, [float(draw.randrange(-3, 4)) for _ in range(4)]) for i in range(300)]
    vectors += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0]), (303, [float("nan")] * 4), (304, [float("inf")] * 4), (None, [1.0] * 4)]
    vectors += [(305, [1.0, 2.0]), (400, [0.0] * 4), (7, [3.0] * 4), (500, [1.0] * 4), (500, [1.0] * 4)]
    vectors += [(401, [3e9, 0.0, 0.0, 0.0])]  # too large for doubles, so its cell counts in whole numbers
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    good = [(i, v) for i, v in vectors if i is not None and v and all(x is not None and abs(x) < 1e12 for x in v)]
    for block, first in ((16_384, 64), (50, 2)):
        monkeypatch.setattr(exact_topk, "BLOCK", block)
        monkeypatch.setattr(exact_topk, "FIRST_READ", first)
        got = defaultdict(list)
        for r in exact_topk.top_k(frame.where("vec_id % 100 = 0"), frame, 10).collect():
            got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
        for key, q in {i: v for i, v in good if i % 100 == 0}.items():
            scores = sorted((-sum(int(1024 * a) * int(1024 * b) for a, b in zip(q, v)), i) for i, v in good if i != key and len(v) == len(q))
            assert sorted(got[key]) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores[:10])]
    assert exact_topk.top_k(frame.limit(0), frame, 3).count() == 0 and exact_topk.top_k(frame, frame.limit(0), 3).count() == 0


def test_token_batches_count_once(spark, tmp_path):
    root = f"{tmp_path}/rollup"
    schema = "source string, lang string, version string, change string, tokens bigint, old_tokens bigint, docs string"
    first = spark.createDataFrame([("a", "en", "v1", "insert", 5, None, "x"), ("a", "en", "v1", "insert", None, None, "x"), (None, None, "v1", "insert", 3, None, "x")], schema)
    second = spark.createDataFrame([("a", "en", "v1", "revise", 9, 5, "x"), (None, None, "v1", "delete", 3, None, "x")], schema)
    as_rows = lambda: sorted((tuple(r) for r in token_counts.totals(spark, root).collect()), key=str)
    assert as_rows() == []
    assert token_counts.commit(first, root, "1") and not token_counts.commit(second, root, "1")
    # A batch that broke off has files and no marker: it doesn't count, and is written again.
    token_counts.signed(second).write.parquet(f"{root}/batch=2")
    (tmp_path / "rollup/batch=2/_SUCCESS").unlink()
    assert as_rows() == [("a", "en", "v1", 2, 5), (None, None, "v1", 1, 3)]
    assert token_counts.commit(second, root, "2") and not token_counts.commit(second, root, "2")
    assert as_rows() == [("a", "en", "v1", 2, 9)]
    token_counts.compact(spark, root, "a")
    assert as_rows() == [("a", "en", "v1", 2, 9)] and not token_counts.commit(first, root, "1")
    assert token_counts.commit(first, root, "3") and as_rows() == [("a", "en", "v1", 4, 14), (None, None, "v1", 1, 3)]
    with pytest.raises(Exception, match="unknown change"):
        token_counts.commit(first.withColumn("change", F.lit("other")), root, "4")
    assert token_counts.commit(first.limit(0), root, "5")


def test_licences(spark):
    files = [
        ("/a/LICENSE", "Licensed under the Apache License, Version 2.0."), ("/a/b/x.txt", "text"), ("/a/b/c/y.txt", "text\nReleased under the MIT License.\n"),
        ("/a/b/c/LICENSE", "no name here"), ("/a/b/c/z.txt", None), ("/ab/x.txt", ""), ("/d/COPYING", "nothing"), (None, "Licensed under CC BY-NC 4.0."),
        ("/a/b/x.txt", "text"), ("/e/LICENSE.md", "This work is licensed under the GNU General Public License, version 3."), ("/e/f", "a license of another kind"),
    ]
    frame = spark.createDataFrame(files, "path string, text string").withColumn("license", F.lit("own"))
    out = sorted(((r["path"], r["own_license"], r["license"], r["inherited_from"]) for r in license_scan.scan(frame).collect()), key=str)
    assert out == sorted([
        ("/a/LICENSE", "Apache-2.0", "Apache-2.0", None), ("/a/b/x.txt", None, "Apache-2.0", "/a"), ("/a/b/x.txt", None, "Apache-2.0", "/a"),
        ("/a/b/c/y.txt", "MIT", "MIT", None), ("/a/b/c/LICENSE", None, "Apache-2.0", "/a"), ("/a/b/c/z.txt", None, "Apache-2.0", "/a"),
        ("/ab/x.txt", None, None, None), ("/d/COPYING", None, None, None), (None, "CC-BY-NC-4.0", "CC-BY-NC-4.0", None),
        ("/e/LICENSE.md", "GPL-3.0", "GPL-3.0", None), ("/e/f", None, "GPL-3.0", "/e"),
    ], key=str)
    assert license_scan.scan(frame.limit(0)).count() == 0


def test_real_licence_files_tags_and_sentences(spark):
    import pyspark

    home = Path(pyspark.__file__).parent / "licenses"
    real = {"LICENSE-modernizr.txt": "MIT", "LICENSE-jquery.txt": "MIT", "LICENSE-py4j.txt": "BSD-3-Clause", "LICENSE-CC0.txt": "CC0-1.0"}
    files = [(f"/r/{name}/LICENSE", (home / name).read_text(), want) for name, want in real.items()]
    files += [(f"/t/{name}/COPYING", "Preface.\n" + text, name) for name, text in license_scan.TEXTS.items()]
    files += [
        ("/s/a.py", "# SPDX-License-Identifier: MIT\nx = 1", "MIT"), ("/s/b.py", "// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
        ("/s/c.py", "SPDX-License-Identifier: GPL-3.0-or-later\n", "GPL-3.0"), ("/s/d.py", "SPDX-License-Identifier: MIT OR Apache-2.0", "MIT OR Apache-2.0"),
        ("/s/e.py", "A small tool for many purposes of all kinds. Released under the MIT License. See the home page for more.", "MIT"),
        ("/s/f.py", "The license of this file is described elsewhere in the handbook.", None), ("/r/LICENSE-modernizr.txt/x", "below", None),
    ]
    frame = spark.createDataFrame([f[:2] for f in files], "path string, text string")
    out = {r["path"]: r for r in license_scan.scan(frame).collect()}
    assert {p: out[p]["own_license"] for p, _, _ in files} == {p: want for p, _, want in files}
    assert out["/r/LICENSE-modernizr.txt/x"]["license"] == "MIT"


# -- queries ---------------------------------------------------------------------------------------------------------------

def test_queries_return_their_contract(spark, rows, tokenizer):
    texts = dict(rows)
    for r in QUERIES["op3_sharding"](spark, SF).collect():
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    for r in QUERIES["op4_bpe_codec"](spark, SF).collect():
        ids = expected_ids(tokenizer, texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    for r in QUERIES["op8_pii"](spark, SF).collect():
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in brute.personal(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest() and r["spans"].startswith(listed)
    for r in QUERIES["op9_packing"](spark, SF).collect():
        ids = [*expected_ids(tokenizer, texts[r["doc_id"]]), 1][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        assert 0 < out.count() <= docs.count(), name
        docs = out.checkpoint()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in pieces.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}
