"""Extra columns that differ from results in case, columns of maps, long texts in one Arrow batch, and names of batches."""

from __future__ import annotations

import tracemalloc

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import (
    bpe_codec, license_scan, ngram_join, packing, pii, quality_classifier, quality_rules, resampling, sharding, simhash, token_counts,
)
from tallyloom.llm.queries import VOCABULARY
from tallyloom.llm.word_bpe import Encoder, loaded

NAMES = ("Kept", "LLR", "N_Words", "IDS", "Decoded", "Spans", "SIZE", "Shard", "Slot", "Selected", "Sample_Key", "N_GRAMS", "License", "Score", "Rank", "FP")


@pytest.fixture
def mixed(docs):
    extra = [F.lit("own").alias(n) for n in NAMES]
    return docs.select("*", *extra, F.create_map(F.lit("k"), F.col("doc_id")).alias("tags"), F.array(F.lit("a")).alias("list"))


def test_columns_that_clash_in_case_and_maps(spark, mixed, labels):
    n, shared = mixed.count(), bpe_codec.vocabulary(spark, VOCABULARY)
    files = mixed.withColumn("path", F.concat(F.lit("/a/"), F.coalesce("doc_id", F.lit(0)).cast("string")))
    outs = {
        "op1": license_scan.scan(files), "op3": sharding.shard(mixed, 3), "op4": bpe_codec.decode(bpe_codec.encode(mixed, shared), shared),
        "op5": quality_rules.judge(mixed, labels), "op8": pii.find(mixed), "op10": quality_classifier.resample(mixed, labels),
        "op11": resampling.resample(mixed, mixed.select("text")), "op13": simhash.near_duplicates(mixed), "op7": ngram_join.near_duplicates(mixed),
    }
    results = {
        "op1": "license", "op3": "shard", "op4": "decoded", "op5": "kept", "op8": "spans", "op10": "selected", "op11": "score", "op13": "fp", "op7": "class_id"}
    for name, out in outs.items():
        assert len(out.collect()) == n, name
        assert results[name] in out.columns and len({c.lower() for c in out.columns}) == len(out.columns), name
    assert packing.pack(mixed, shared).count() >= n


def test_filters_hand_their_columns_on_as_they_came(mixed, labels):
    for kept in (quality_rules.keep_good(mixed, labels), quality_classifier.keep_selected(mixed, labels), ngram_join.keep_one(mixed),
                 simhash.keep_one(mixed), pii.sanitise(mixed), resampling.draw(mixed, mixed.select("text"), least_words=1)):
        assert kept.columns == mixed.columns
        assert {(r["Kept"], r["Spans"], tuple(r["list"])) for r in kept.collect()} <= {("own", "own", ("a",))}


def test_crowded_rows_keep_their_bucket(spark):
    same = spark.range(6000).selectExpr("1L as doc_id", "'same' as text", "map('a', 1) as tags").repartition(6)
    out = sharding.shard(same, 5, bucket_bytes=4000).collect()
    by = {s: sorted(r["slot"] for r in out if r["shard"] == s) for s in range(5)}
    assert all(slots == list(range(1200)) for slots in by.values())


def test_long_texts_in_one_batch(spark, conf):
    conf(spark__sql__execution__arrow__maxBytesPerBatch="1g")
    texts = [" ".join(f"w{(i * j) % 997}" for j in range(30_000)) + f" a{i}@b.example" for i in range(1, 41)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    assert ngram_join.near_duplicates(docs).count() == 40
    assert pii.sanitise(docs).where("text like '%@%'").count() == 0


@pytest.mark.parametrize("name", ["x/y", "", ".x", "compact-a"])
def test_batch_names_that_would_be_lost_are_refused(spark, tmp_path, name):
    rows = spark.createDataFrame([("s", "l", "v", "insert", 3, None)], "source string, lang string, version string, change string, tokens long, old_tokens long")
    with pytest.raises(ValueError, match="no name for a batch"):
        token_counts.commit(rows, str(tmp_path / "t"), name)


def test_batches_count_where_the_session_wants_no_markers(spark, tmp_path):
    rows = spark.createDataFrame([("s", "l", "v", "insert", 3, None)], "source string, lang string, version string, change string, tokens long, old_tokens long")
    option, conf = "mapreduce.fileoutputcommitter.marksuccessfuljobs", spark._jsc.hadoopConfiguration()
    conf.set(option, "false")
    try:
        assert token_counts.commit(rows, str(tmp_path / "t"), "b") and not token_counts.commit(rows, str(tmp_path / "t"), "b")
        token_counts.compact(spark, str(tmp_path / "t"), "c")
    finally:
        conf.unset(option)
    assert [tuple(r) for r in token_counts.totals(spark, str(tmp_path / "t")).collect()] == [("s", "l", "v", 1, 3)]


def test_the_cut_of_the_lexicon_by_counting(spark, monkeypatch):
    draw = __import__("random").Random(7)
    counts = [draw.choice([1, 1, 1, 2, 3, 5, 8, 1000, 10**9 + draw.randint(0, 50)]) for _ in range(400)]
    frame = spark.createDataFrame([(f"w{i}", n) for i, n in enumerate(counts)], "word string, n bigint")
    for fan_out in (2, 7, 4096):
        monkeypatch.setattr(bpe_codec, "FAN_OUT", fan_out)
        for words in (0, 1, 50, 200, 399, 400, 1000):
            ordered = sorted(counts, reverse=True)
            assert bpe_codec.frequency_cut(frame, words) == (ordered[words] if words < len(counts) else 0), (fan_out, words)
    assert bpe_codec.frequency_cut(frame.limit(0), 5) == 0


def test_words_beside_an_entity_however_long_they_are():
    long = ["a" * 700, "b" * 3000]
    text = f"first second {' '.join(long)}\n\n   three four five six a@b.example {long[0]} after"
    spans = pii.base_spans(text)
    (_, terms), = pii.surroundings(text, spans)
    assert [t for t, _, _ in terms] == ["first", "second", *long, "three", "four", "five", "six", long[0], "after"]
    assert all(text[s:e] == t for t, s, e in terms)
    many = " ".join(f"w{chr(97 + i)}" for i in range(20)) + " x@y.example"
    (_, terms), = pii.surroundings(many, pii.base_spans(many))
    assert [t for t, _, _ in terms] == []  # all are shorter than a term
    assert pii.words_before(many, many.index("x@")) == [(f"w{chr(97 + i)}", many.index(f"w{chr(97 + i)}")) for i in range(12, 20)]


def test_a_term_that_stands_only_glued_to_its_entity_is_found(spark):
    draw = __import__("random").Random(5)
    fill = [f"common{chr(97 + i)}" for i in range(20)]
    words = lambda n: " ".join(draw.choice(fill) for _ in range(n))
    texts = [f"{words(8)} Zorblatt<zo@x.example> {words(8)}" for _ in range(4)] + [words(60) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: {r["text"][s["start"]:s["end"]] for s in r["spans"] if s["kind"] == "term"} for r in pii.find(docs).collect()}
    assert all(found[i] == {"Zorblatt"} for i in range(4)) and not any(found[i] for i in range(4, 64))
    assert pii.without_entities("acct:a@b.cc,x") == "acct: ,x" and pii.without_entities(None) == ""


def test_a_task_of_the_pipeline_has_one_python_worker(spark, docs, conf):
    # Every mapInArrow of a task runs in a worker of its own, and each keeps the vocabulary once it has encoded.
    conf(spark__sql__adaptive__enabled="false")
    plan = pii.sanitise(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_encoding_holds_few_words_of_a_batch_at_a_time():
    with open(VOCABULARY, "rb") as file:
        encoder = Encoder(loaded(file.read()))
    texts = [" ".join(f"word{(i * j) % 50}" for j in range(2000)) for i in range(1, 201)]
    expected = [encoder.encode([t])[0] for t in texts]
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        assert encoder.encode(texts) == expected
        # The ids are four times 400,000 numbers; a list of all words would take 25 MB more.
        assert tracemalloc.get_traced_memory()[1] - before < 3 * sum(map(len, expected))
    finally:
        tracemalloc.stop()


def test_encoding_splits_each_text_once(monkeypatch):
    with open(VOCABULARY, "rb") as file:
        encoder = Encoder(loaded(file.read()))
    texts = [f"word{i} and,others <|endoftext|> {i}" if i % 3 else f"word{i}. Some" for i in range(30)] + [None, "", "<|startoftext|>"]
    expected = [encoder.encode([t])[0] for t in texts]
    parts, chunks = [], encoder.bpe.chunks
    monkeypatch.setattr(encoder.bpe, "chunks", lambda text: parts.append(text) or chunks(text))
    assert encoder.encode(texts) == expected
    whole = [part for t in texts for special, part in encoder.bpe.segments(t or "") if special is None]
    assert sorted(parts) == sorted(whole)


def test_a_full_memory_keeps_the_frequent_words(monkeypatch):
    with open(VOCABULARY, "rb") as file:
        bpe = loaded(file.read())
    monkeypatch.setattr(Encoder, "MEMO", 40)
    encoder, learned, pieces = Encoder(bpe), [], bpe.pieces
    monkeypatch.setattr(bpe, "pieces", lambda chunks: learned.extend(chunks) or pieces(chunks))
    rare = [" ".join(f"rare{i}x{j}" for j in range(60)) + " <|endoftext|>" for i in range(4)]
    texts = ["often, " * 40 + "<|startoftext|> seldom", *rare, "often, <|endoftext|> often,"]
    found = [encoder.encode([t])[0] for t in texts]
    assert learned.count("often,") == 1 and len(encoder.numbers) <= 100
    assert found == [Encoder(bpe).encode([t])[0] for t in texts]


def test_filtering_on_the_verdict_repeats_no_table_in_the_plan(docs, labels):
    plans = [len(df._jdf.queryExecution().executedPlan().toString()) for df in (quality_rules.judge(docs, labels), quality_rules.keep_good(docs, labels))]
    assert plans[0] > 2**16 and plans[1] < 1.5 * plans[0]
