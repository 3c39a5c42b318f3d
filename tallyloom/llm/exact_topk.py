"""Exact top-k search by inner product: Fagin's threshold algorithm over sorted lists, one per dimension.

Vectors are turned into whole numbers, floor(``SCALE`` * x). Candidates and queries are cut into blocks of bounded size; each
pair of blocks is one task's work (a cell). In a cell every dimension has a list of the candidates sorted by their value. For a
query all lists are read together, from the end that its sign favours; each candidate met is scored at once. The bound, the
score of a vector with the last value read in every list, can't be beaten by any candidate not met, so reading stops as soon
as the k-th score is above it (not when it is equal: an equal score may have a smaller id). The cells' answers are merged.

Defined results: rows with a null id, and vectors that are null, empty or hold null or non-finite values, take no part. Vectors
of different lengths aren't compared. A query's own id is no candidate, so all rows of that id are left out. Equal query rows are
one query. Equal candidate rows are as many candidates. Scores are exact as long as they fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
BLOCK, QUERY_BLOCK = 16_384, 256
#: Entries of each list read in the first round; every round reads twice as many.
FIRST_READ = 64


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))


def threshold_search(x: np.ndarray, ids: np.ndarray, lists: np.ndarray, query: np.ndarray, own: int, k: int):
    """Places of the k best candidates for ``query``, best first. ``lists[d]``: places sorted by falling value of dimension d."""
    n = len(x)
    up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    met = ids == own
    top, scores = np.empty(0, np.int64), np.empty(0, x.dtype)
    read, step = 0, FIRST_READ
    while read < n:
        to = min(n, read + step)
        fresh = np.zeros(n, bool)
        fresh[lists[up, read:to].ravel()] = True
        fresh[lists[down, n - to : n - read].ravel()] = True
        if not len(up) and not len(down):
            fresh[:] = True  # all scores are 0
            to = n
        new = np.flatnonzero(fresh & ~met)
        met[new] = True
        top, scores = np.concatenate([top, new]), np.concatenate([scores, x[new] @ query])
        if len(top) > k:
            best = np.lexsort((ids[top], -scores))[:k] if len(top) < 4 * k else _best(ids[top], scores, k)
            top, scores = top[best], scores[best]
        last = (x[lists[up, to - 1], up] * query[up]).sum() + (x[lists[down, n - to], down] * query[down]).sum()
        if len(top) == k and scores.min() > last:
            break
        read, step = to, step * 2
    order = np.lexsort((ids[top], -scores))
    return top[order], scores[order]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    near = np.flatnonzero(scores >= least)
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def top_k(queries: DataFrame, candidates: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` best candidates, ties to the smaller id."""

    def numbers(rows: DataFrame, block: int) -> DataFrame:
        rows = rows.where(usable(F.col(vector)) & F.col(id_col).isNotNull())
        rows = rows.select(F.col(id_col).cast("long").alias("id"), whole_numbers(F.col(vector)).alias("v")).withColumn("dim", F.size("v"))
        count = rows.agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n")).scalar()
        return rows, F.greatest(count, F.lit(1))

    x, x_blocks = numbers(candidates, BLOCK)
    q, q_blocks = numbers(queries, QUERY_BLOCK)
    q = q.distinct()
    copies = F.xxhash64(F.lit(1), "id", F.monotonically_increasing_id())  # equal rows go to different blocks
    left = x.withColumn("xb", F.pmod(copies, x_blocks)).withColumn("last", q_blocks - 1).select(
        "id", "v", "dim", "xb", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("qb"), F.lit(False).alias("asks"))
    right = q.withColumn("qb", F.pmod(F.xxhash64("id", "v"), q_blocks)).withColumn("last", x_blocks - 1).select(
        "id", "v", "dim", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("xb"), "qb", F.lit(True).alias("asks"))
    cells = left.select("id", "v", "dim", F.col("xb").cast("int"), F.col("qb").cast("int"), "asks").unionByName(
        right.select("id", "v", "dim", F.col("xb").cast("int"), F.col("qb").cast("int"), "asks"))

    def search(cell: pa.Table) -> pa.Table:
        asks = cell.column("asks").to_numpy()
        dim = cell.column("dim")[0].as_py()
        flat = pa.concat_arrays(cell.column("v").chunks).flatten().to_numpy().reshape(-1, dim)
        every = cell.column("id").to_numpy()
        x, ids, q, q_ids = flat[~asks], every[~asks], flat[asks], every[asks]
        out = [(np.empty(0, np.int64),) * 4]
        # Rows of one id that ask for different vectors are told apart by the whole numbers, in every cell alike.
        asked = [xxhash.xxh64_intdigest(v.tobytes()) - 2**63 for v in q]
        if len(x) and len(q):
            # Doubles hold whole numbers up to 2**53 exactly, and multiply faster.
            if float(np.abs(x).max()) * float(np.abs(q).max()) * dim < 2**53:
                x, q = x.astype(np.float64), q.astype(np.float64)
            lists = np.ascontiguousarray(np.argsort(-x, axis=0, kind="stable").T)
            for i in range(len(q)):
                top, scores = threshold_search(x, ids, lists, q[i], q_ids[i], k)
                number = np.full(len(top), q_ids[i])
                out.append((number, np.full(len(top), asked[i], np.int64), ids[top], scores.astype(np.int64)))
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.table(dict(zip(("query_id", "asked", "vec_id", "score"), columns)))

    found = cells.groupBy("dim", "xb", "qb").applyInArrow(search, "query_id bigint, asked bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
