"""Token counts: rollups by source, language and tokenizer version, kept by signed deltas.

A batch holds inserts, deletes and revisions of documents' counts. It is summed to one signed delta per (source, lang, version)
and written to its own folder; Spark's commit marker there makes it count. A batch that has the marker is not applied again, one
without is written anew, so a batch may be sent any number of times. Totals are the sum of all deltas, in any order;
``compact`` folds deltas into one.

Defined results: null sources, languages and versions are groups of their own. A null count adds no tokens but is a document. An
unknown kind of change is an error. Totals of no documents and no tokens are left out. Repeated rows count as often as they
occur. Other columns play no part.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.words import words_of

KEYS = ["source", "lang", "version"]
DELTA = "source string, lang string, version string, docs bigint, tokens bigint"
MARKER = "_SUCCESS"
NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def signed(changes: DataFrame) -> DataFrame:
    """One signed delta per key. Columns of ``changes``: the keys, ``change``, ``tokens`` and, for revisions, ``old_tokens``."""
    tokens, old = F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    kind = F.col("change")
    docs = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0)
    delta = F.when(kind == "insert", tokens).when(kind == "delete", -tokens).when(kind == "revise", tokens - old)
    docs = F.coalesce(docs, F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(kind, F.lit("null")))).cast("int"))
    return changes.groupBy(*(F.col(k).cast("string").alias(k) for k in KEYS)).agg(
        F.sum(docs).cast("long").alias("docs"), F.coalesce(F.sum(delta), F.lit(0)).cast("long").alias("tokens"))


def commit(changes: DataFrame, root: str, batch: str) -> bool:
    """Apply a batch; False if it was applied before. Its name is letters, digits, '.', '_' and '-', not ``compact-``."""
    if not NAME.fullmatch(batch) or batch.startswith("compact-"):
        raise ValueError(f"{batch!r} is no name for a batch")
    spark, path = changes.sparkSession, f"{root}/batch={batch}"
    if _exists(spark, f"{path}/{MARKER}") or any(batch in _folded(spark, p) for p in _committed(spark, root, "compact-")):
        return False
    _write(signed(changes), path)
    return True


def _write(deltas: DataFrame, path: str) -> None:
    """Write with the marker, whatever the session says about markers, and see that it is there."""
    deltas.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
    if not _exists(deltas.sparkSession, f"{path}/{MARKER}"):
        raise RuntimeError(f"{path} was written without {MARKER}: it would never be counted")


def _committed(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [f.getPath().getName() for f in files.listStatus(place)]
    return sorted(f"{root}/{n}" for n in names if n.startswith(f"batch={prefix}") and _exists(spark, f"{root}/{n}/{MARKER}"))


def _folded(spark: SparkSession, path: str) -> set[str]:
    """The batches that a compacted one stands for."""
    return {r["batch"] for r in spark.read.schema("batch string").json(path.replace("/batch=", "/members=")).collect()}


def totals(spark: SparkSession, root: str) -> DataFrame:
    """``docs`` and ``tokens`` of each key, over all committed batches."""
    paths = _committed(spark, root)
    hidden = {f"{root}/batch={b}" for p in paths if "batch=compact-" in p for b in _folded(spark, p)}
    paths = [p for p in paths if p not in hidden]
    deltas = spark.read.schema(DELTA).parquet(*paths) if paths else spark.createDataFrame([], DELTA)
    summed = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    return summed.where("docs <> 0 or tokens <> 0")


def compact(spark: SparkSession, root: str, name: str) -> None:
    """One batch in place of all committed ones. Its list of members is written first and counts only with its marker."""
    path = f"{root}/batch=compact-{name}"
    if _exists(spark, f"{path}/{MARKER}"):
        return
    members = [p.rsplit("batch=", 1)[1] for p in _committed(spark, root)]
    members += [b for p in _committed(spark, root, "compact-") for b in _folded(spark, p)]
    spark.createDataFrame([(b,) for b in sorted(set(members))], "batch string").coalesce(1).write.mode("overwrite").json(f"{root}/members=compact-{name}")
    _write(totals(spark, root), path)


def word_tokens(text: Column) -> Column:
    """Tokenizer ``words-1``: runs of characters other than white space."""
    return F.size(words_of(text)).cast("long")


def mark_tokens(text: Column) -> Column:
    """Tokenizer ``marks-1``: runs of ASCII letters and digits, and every other character that isn't white space."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D])"), 1)).cast("long")


def distinct_lines(text: Column) -> Column:
    return F.array_join(F.array_distinct(F.split(F.coalesce(text, F.lit("")), "\n")), "\n")
