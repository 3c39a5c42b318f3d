"""One query for each operator of this subpackage, over its whole table, and the corpus pipeline; SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    bpe_codec, centroids, exact_topk, license_scan, ngram_join, packing, pii, quality_classifier, quality_rules, resampling, sharding,
    simhash, token_counts,
)
from tallyloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def text_crc32() -> Column:
    return F.crc32(F.coalesce(F.col("text"), F.lit("")))


def files(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a file in a tree of directories; each sixteenth is called LICENSE, at the level its number ends."""
    k = F.col("doc_id")
    place = F.when(k % 4096 == 0, F.lit("")).when(k % 256 == 0, F.concat(F.lit("/"), F.expr("doc_id div 256"))).otherwise(
        F.concat(F.lit("/"), F.expr("doc_id div 256"), F.lit("/"), F.expr("doc_id div 16")))
    name = F.when(k % 16 == 0, F.lit("LICENSE")).otherwise(F.concat(k.cast("string"), F.lit(".txt")))
    path = F.concat(F.lit("/"), "source", F.lit("/"), "lang", place, F.lit("/"), name)
    return read(spark, sf, "documents").select("doc_id", path.alias("path"), "text")


def _license_sql() -> str:
    idf, unknown, vectors = license_scan.template_weights(license_scan.TEMPLATES)
    terms = ", ".join(f"('{t}', {w!r})" for t, w in sorted(idf.items()))
    weights = ", ".join(f"('{name}', '{t}', {w!r})" for name, v in sorted(vectors.items()) for t, w in sorted(v.items()))
    cue, special = license_scan.CUE, license_scan.LICENSE_FILE
    return f"""
WITH idf(term, idf) AS (VALUES {terms}), tpl(license, term, w) AS (VALUES {weights}),
files AS (
  SELECT doc_id, coalesce(text, '') AS text, '/' || source || '/' || lang ||
    CASE WHEN doc_id % 4096 = 0 THEN '' WHEN doc_id % 256 = 0 THEN '/' || (doc_id // 256) ELSE '/' || (doc_id // 256) || '/' || (doc_id // 16) END
    || '/' || CASE WHEN doc_id % 16 = 0 THEN 'LICENSE' ELSE doc_id || '.txt' END AS path FROM documents),
named AS (SELECT *, regexp_replace(path, '/[^/]*$', '') AS dir, regexp_matches(regexp_extract(path, '[^/]*$'), '{special}') AS special FROM files),
passages AS (
  SELECT doc_id, unnest(list_distinct(list_concat(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{cue}')),
    CASE WHEN special AND regexp_matches(text, '{cue}') THEN [text] ELSE [] END))) AS passage FROM named),
words AS (SELECT doc_id, passage, unnest(list_filter(string_split_regex(lower(passage), '[^a-z0-9]+'), lambda x: x <> '')) AS term FROM passages),
tf AS (SELECT doc_id, passage, term, count(*) AS n FROM words GROUP BY ALL),
weighed AS (SELECT tf.*, n * coalesce(idf, {unknown!r}) AS w FROM tf LEFT JOIN idf USING (term)),
norms AS (SELECT doc_id, passage, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL),
scores AS (
  SELECT doc_id, license, round(sum(weighed.w * tpl.w) / any_value(norm), {license_scan.DIGITS}) AS score
  FROM weighed JOIN tpl USING (term) JOIN norms USING (doc_id, passage) GROUP BY doc_id, passage, license),
best AS (SELECT doc_id, score, license FROM scores QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1),
own AS (SELECT named.*, coalesce(score, 0.0) AS score, CASE WHEN score >= {license_scan.LEAST} THEN license END AS own_license
  FROM named LEFT JOIN best USING (doc_id)),
holders AS (SELECT dir AS holder, own_license AS given FROM own WHERE special AND own_license IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path) = 1),
near AS (SELECT o.doc_id, holder, given FROM own o JOIN holders h ON o.dir = holder OR starts_with(o.dir, holder || '/')
  QUALIFY row_number() OVER (PARTITION BY o.doc_id ORDER BY length(holder) DESC) = 1)
SELECT doc_id, path, own_license, score, coalesce(own_license, given) AS license,
  CASE WHEN own_license IS NULL THEN holder END AS inherited_from
FROM own LEFT JOIN near USING (doc_id)
"""


@query(_license_sql())
def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(files(spark, sf)).drop("text")


SPLIT = "list_filter(string_split_regex({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


@query(f"""
WITH d AS (
  SELECT source, lang, len({SPLIT.format("coalesce(text, '')")}) AS n,
    len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]')) AS marks,
    len({SPLIT.format("array_to_string(list_distinct(string_split(coalesce(text, ''), chr(10))), chr(10))")}) AS lines
  FROM documents),
c AS (
  SELECT source, lang, 'words-1' AS version, 1 AS docs, lines AS tokens FROM d WHERE n >= 20
  UNION ALL SELECT source, lang, 'marks-1', 1, marks FROM d WHERE n >= 20)
SELECT source, lang, version, sum(docs)::BIGINT AS docs, sum(tokens)::BIGINT AS tokens FROM c GROUP BY ALL
""")
def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """All documents come in, short ones go, counts are revised to distinct lines, a second tokenizer joins; two batches twice."""
    docs, root, text = read(spark, sf, "documents"), scratch_path(spark, "token-counts"), F.col("text")
    words = docs.select("source", "lang", "text", F.lit("words-1").alias("version"), token_counts.word_tokens(text).alias("n"))

    def changes(rows: DataFrame, change: str, tokens: str | Column, old: str | Column | None = None) -> DataFrame:
        old = F.lit(None).cast("long") if old is None else old
        return rows.select("source", "lang", "version", F.lit(change).alias("change"), F.col(tokens).alias("tokens") if isinstance(tokens, str) else tokens.alias("tokens"),
                           F.col(old).alias("old_tokens") if isinstance(old, str) else old.alias("old_tokens"))

    long = words.where("n >= 20")
    batches = {
        "1-insert": changes(words, "insert", "n"),
        "2-delete": changes(words.where("n < 20"), "delete", "n"),
        "3-revise": changes(long, "revise", token_counts.word_tokens(token_counts.distinct_lines(text)), "n"),
        "4-marks": changes(long.withColumn("version", F.lit("marks-1")), "insert", token_counts.mark_tokens(text)),
    }
    for name, batch in batches.items():
        token_counts.commit(batch, root, name)
    for name in ("1-insert", "3-revise"):
        token_counts.commit(batches[name], root, name)
    return token_counts.totals(spark, root)


@query()
def op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    out = sharding.shard(read(spark, sf, "documents"), shards=24)
    return out.select(
        "doc_id", "size", text_crc32().alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query()
def op4_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    docs, shared = read(spark, sf, "documents").select("doc_id", "text"), bpe_codec.vocabulary(spark, VOCABULARY)
    path = scratch_path(spark, "encoded")
    encoded = bpe_codec.encode(docs, shared, bpe_codec.fit_lexicon(docs, shared)).select("doc_id", "ids")
    encoded.write.option("compression", "zstd").parquet(path)
    out = bpe_codec.decode(spark.read.parquet(path), shared)
    return out.select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query()
def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    out = quality_rules.judge(read(spark, sf, "documents"), read(spark, sf, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


@query("""
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([a * b for a, b in zip])::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
QUALIFY rank <= 10
""".replace("list_sum([a * b for a, b in zip])", "list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))"))
def op6_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = read(spark, sf, "embeddings")
    return exact_topk.top_k(vectors.where("vec_id % 100 = 0"), vectors, 10)


@query()
def op7_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf, "documents")).select("doc_id", "class_id", "n_links")


@query()
def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find(read(spark, sf, "documents").select("doc_id", "text"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(listed(of(*pii.KINDS[:4])), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def packed_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "continues_document",
        "continued")


@query()
def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packed_digest(packing.pack(read(spark, sf, "documents"), bpe_codec.vocabulary(spark, VOCABULARY)))


@query()
def op10_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    out = quality_classifier.resample(read(spark, sf, "documents"), read(spark, sf, "labels"))
    return out.select("doc_id", "n_grams", "log_weight", "sample_key", "selected")


def _resampling_sql() -> str:
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    digit = "instr('0123456789ABCDEF', substr(h, {}, 1)) - 1"
    return f"""
WITH texts AS (
  SELECT doc_id, false AS target, {words} AS w FROM documents UNION ALL SELECT row_number() OVER (), true, {words} FROM benchmark),
listed AS (
  SELECT *, list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS grams FROM texts),
spread AS (SELECT doc_id, target, unnest(grams) AS gram FROM listed),
hexed AS (SELECT DISTINCT gram, hex(encode(gram)) AS h FROM spread),
bytes AS (
  SELECT gram, list_transform(range(0, len(h) // 2), lambda i: 16 * ({digit.format("2 * i + 1")}) + {digit.format("2 * i + 2")}) AS b FROM hexed),
hashed AS (
  SELECT gram, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b),
    lambda c, x: xor(c >> 8, {table}[xor(c & 255, x) + 1]::BIGINT))) % 10000 AS bucket FROM bytes),
counts AS (
  SELECT bucket, count(*) FILTER (NOT target) AS s, count(*) FILTER (target) AS t FROM spread JOIN hashed USING (gram) GROUP BY bucket),
sums AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counts),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain FROM counts, sums),
weights AS (
  SELECT doc_id, floor(sum(gain) / count(*))::BIGINT AS weight FROM spread JOIN hashed USING (gram) JOIN gains USING (bucket) WHERE NOT target GROUP BY doc_id),
noise AS (SELECT doc_id, len(w) AS n_words, len(grams) AS n_features, ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h FROM listed WHERE NOT target),
scored AS (
  SELECT doc_id, n_words, n_features::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score FROM noise LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= floor(25 * n / 100) THEN rank END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""


@query(_resampling_sql())
def op11_target_resampling(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text")
    out = resampling.resample(docs, read(spark, sf, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def _clustering_sql() -> str:
    ctes = ["""kept AS (
  SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""", """c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), vec_id, v) - 1 AS k, v FROM kept WHERE vec_id IS NOT NULL QUALIFY k < 40)"""]
    far = "list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    for i in range(6):
        ctes.append(f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, kept.v, k, {far} AS distance FROM kept CROSS JOIN c{i} c QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, k) = 1)""")
        if i < 5:
            ctes.append(f"""s{i} AS (
  SELECT k, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, 65)) AS i) GROUP BY k, i),
m{i} AS (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s{i} GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (k))""")
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, k::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY k)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c5.v, ',')) AS centroid_sha256
FROM a5 JOIN c5 USING (k)
"""


@query(_clustering_sql())
def op12_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    out = centroids.cluster(read(spark, sf, "embeddings"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroids.centroid_sha256().alias("centroid_sha256"))


@query()
def op13_simhash(spark: SparkSession, sf: str) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, sf)
