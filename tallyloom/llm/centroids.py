"""Centroid clustering in whole numbers, with Ptolemaic lower bounds from cached pivot distances.

For a vector x, a centroid c and two pivots p and s, Ptolemy's inequality gives
``d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s)``. The pivots are fixed, so the distances of every vector to them are
computed once and written beside it; only the centroids' own distances to them change from round to round. A vector looks at
the centroids in the order of their bounds, computes the exact distance in whole numbers, and stops at the first whose bound
is above the best so far. Bounds are rounded down by more than the error of the floating point operations in them, so
no centroid that could win, or tie, is ever left out.

The start are the ``clusters`` vectors of smallest ``sha256("<seed>:<id>")``, in that order. A round assigns every vector to the
nearest centroid, ties to the smaller number, and replaces each centroid that has vectors by the floor of their mean. Sums of
each task are added up by Spark; the driver holds the centroids, ``clusters * dims`` numbers.

Defined results: vectors take part that have ``dims`` components, none null or non-finite. Rows without an id are assigned but
never a start. Repeated rows are as many vectors. With fewer vectors than clusters each is a start; with none the result is
empty. Distances and sums must fit a long: components within +-2**10 do for 2**35 vectors. Other columns play no part.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.exact_topk import usable
from tallyloom.session import scratch_path

DIMS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 256, 40, 5, 2
PIVOTS = 8
#: Vectors that are assigned at once.
AT_ONCE = 4096
#: More than the relative error of a product of two rounded square roots, or of the operations after it.
SLACK = 2.0**-48
CACHED = "vec_id bigint, v binary, pivots binary"


def whole_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    numbers = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.where(usable(F.col("embedding")) & (F.size("embedding") == dims))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("v"))


def starts(whole: DataFrame, clusters: int, seed: int) -> np.ndarray:
    named = whole.where("vec_id is not null").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    first = named.orderBy("h", "vec_id", "v").limit(clusters).collect()
    return np.array([r["v"] for r in first], np.int64)


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all rows of ``y``."""
    return np.stack([((x - one) ** 2).sum(1) for one in y], 1) if len(y) else np.zeros((len(x), 0), np.int64)


def choose_pivots(start: np.ndarray, pivots: int) -> np.ndarray:
    """Starting centroids far from each other: the first, then always the one farthest from those chosen."""
    chosen = [0]
    while len(chosen) < min(pivots, len(start)):
        far = squares(start, start[chosen]).min(1)
        if not far.max():
            break
        chosen.append(int(far.argmax()))
    return start[chosen]


def lower_bounds(x_pivots: np.ndarray, c_pivots: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Lower bounds of the squared distances of vectors to centroids, from the distances of both to the pivots."""
    best = np.zeros((len(x_pivots), len(c_pivots)))
    for p, s in combinations(range(len(between)), 2):
        one, other = x_pivots[:, p, None] * c_pivots[:, s], x_pivots[:, s, None] * c_pivots[:, p]
        np.maximum(best, (np.abs(one - other) - (one + other) * SLACK) / between[p, s], out=best)
    return best * best * (1 - SLACK)


def nearest(x: np.ndarray, x_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid, exact squared distance to it, and how many distances were computed."""
    bounds = lower_bounds(x_pivots, np.sqrt(squares(centroids, pivots)), np.sqrt(squares(pivots, pivots)))
    order = np.argsort(bounds, 1, kind="stable")
    number, least = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
    at, checked = np.arange(len(x)), 0
    for place in range(len(centroids)):
        turn = order[at, place]
        open_ = bounds[at, turn] <= least[at]
        at, turn = at[open_], turn[open_]
        if not len(at):
            break
        checked += len(at)
        found = ((x[at] - centroids[turn]) ** 2).sum(1)
        better = (found < least[at]) | ((found == least[at]) & (turn < number[at]))
        least[at[better]], number[at[better]] = found[better], turn[better]
    return number, least, checked


def cached(whole: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The vectors as written numbers, each with its distances to the pivots."""

    def run(batches):
        for batch in batches:
            x = batch.column("v").flatten().to_numpy().astype("<i8").reshape(batch.num_rows, -1)
            far = np.sqrt(squares(x, pivots))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in far], pa.binary())],
                ["vec_id", "v", "pivots"])

    path = scratch_path(whole.sparkSession, "pivots")
    whole.mapInArrow(run, CACHED).write.option("compression", "zstd").parquet(path)
    return whole.sparkSession.read.schema(CACHED).parquet(path)


def assigned(batches, centroids: np.ndarray, pivots: np.ndarray):
    """Ids, vectors, centroid numbers, exact distances and how many were computed, in parts of bounded size."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(at, AT_ONCE)
            x = np.frombuffer(b"".join(part.column("v").to_pylist()), "<i8").reshape(part.num_rows, -1)
            far = np.frombuffer(b"".join(part.column("pivots").to_pylist()), "<f8").reshape(part.num_rows, -1)
            yield part.column("vec_id"), x, *nearest(x, far, centroids, pivots)


def next_centroids(vectors: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, int]:
    """The centroids after one round, and how many distances were computed."""
    dims = centroids.shape[1]

    def run(batches):
        sums, counts, checked = np.zeros_like(centroids), np.zeros(len(centroids), np.int64), 0
        for _, x, number, _, n in assigned(batches, centroids, pivots):
            np.add.at(sums, number, x)
            counts += np.bincount(number, minlength=len(centroids))
            checked += n
        used = np.flatnonzero(counts)
        tried = np.zeros(len(used), np.int64)
        tried[:1] = checked
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(used, pa.int32()), "n": counts[used], "checked": tried, "sums": pa.array(list(sums[used]), pa.list_(pa.int64()))})

    parts = vectors.mapInArrow(run, "cluster int, n bigint, checked bigint, sums array<bigint>")
    totals = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.sum("checked").alias("checked"), F.array(*(F.sum(F.col("sums")[i]) for i in range(dims))).alias("sums"))
    out, checked = centroids.copy(), 0
    for r in totals.collect():
        out[r["cluster"]] = [s // r["n"] for s in r["sums"]]
        checked += r["checked"]
    return out, checked


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: int = SCALE, pivots: int = PIVOTS,
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and the ``centroid``, one row per vector."""
    spark, whole = vectors.sparkSession, whole_vectors(vectors, dims, scale)
    centroids = starts(whole, clusters, seed)
    if not len(centroids):
        centroids = np.zeros((0, dims), np.int64)
        whole = whole.where(F.lit(False))
    anchors = choose_pivots(centroids, pivots) if len(centroids) else centroids
    rows = cached(whole, anchors)
    for _ in range(rounds if len(centroids) else 0):
        centroids, _ = next_centroids(rows, centroids, anchors)

    def run(batches):
        for ids, _, number, least, _ in assigned(batches, centroids, anchors):
            yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(least)], ["vec_id", "cluster", "distance"])

    path, schema = scratch_path(spark, "assigned"), "vec_id bigint, cluster int, distance bigint"
    rows.mapInArrow(run, schema).write.parquet(path)
    final = spark.read.schema(schema).parquet(path)
    named = spark.createDataFrame([(k, c) for k, c in enumerate(centroids.tolist())], "cluster int, centroid array<bigint>")
    inertia = final.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(F.broadcast(named), "cluster")
    # One row per cluster.
    inertia = inertia.withColumn("inertia", final.agg(F.sum("distance")).scalar())
    return final.join(F.broadcast(inertia), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def centroid_sha256():
    """The hash of a centroid: its components as decimal numbers, joined by commas."""
    return F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)

