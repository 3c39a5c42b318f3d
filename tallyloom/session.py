"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Hours, local days and zone-less timestamps are only well defined when the session reads wall-clock values as UTC.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Aggregating right after a skewed join on the same key must not switch the splitting off.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Rows handed to Python: so many bytes at once, since ten thousand long texts would fill a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}
# Only a new session can take these: checkpoint files go when the frames that use them are gone.
START_SETTINGS = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(app: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``SETTINGS``; ``conf`` keys use ``__`` for dots (``spark__sql__ansi__enabled``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **START_SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_for(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 * 1024 * 1024) -> int:
    """Shuffle partitions for a job over that much input, at least two per core; returns their number.

    Too many do no harm, adaptive execution joins small neighbours; too few would spill.
    """
    partitions = max(2 * spark.sparkContext.defaultParallelism, -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such a folder would exist on one machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tallyloom/{name}-{uuid.uuid4().hex}"


def settle(df):
    """Cut the lineage of a frame that several outputs read, surviving the loss of executors.

    The rows are written once to the cluster's checkpoint folder; a lost executor costs a re-read, not a recomputation.
    """
    context = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
