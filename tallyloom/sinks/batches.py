"""Appending in batches that may be sent again: what a batch's log entry lists is in the tables, and nothing else.

A batch writes each of its outputs to a folder of its own, named by the batch and a number no other attempt has. Then one small
file, the log entry, is put in place by a rename that fails if the entry exists. So all outputs of a batch become visible
at once, a batch that broke off half way leaves nothing visible, and of two writers of the same batch one wins. Readers take the
files that the entries list. The log has a line per batch and output, whatever the number of rows.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
ATTEMPT = "__attempt"
ENTRY = "batch string, output string, folder string, files array<string>, bytes bigint"


def _checked(name: str) -> str:
    """A name that is one path segment and no hidden file."""
    if not NAME.fullmatch(name):
        raise ValueError(f"{name!r} is no name for a batch or an output: letters, digits, '.', '_' and '-' only")
    return name


def _place(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    place = _place(spark, path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _written(spark: SparkSession, folder: str) -> tuple[list[str], int]:
    """Names of the data files below a folder, partition folders included, and their size."""
    files, place = _files(spark, folder)
    base, found, size = len(files.makeQualified(place).toString()) + 1, [], 0
    listing = files.listFiles(place, True)
    while listing.hasNext():
        status = listing.next()
        name = status.getPath().toString()[base:]
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            found.append(name)
            size += status.getLen()
    return sorted(found), size


def _publish(spark: SparkSession, path: str, text: str) -> bool:
    """Put a file in place whole; False if it is there already."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, draft = _place(spark, path), _place(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    files = target.getFileSystem(conf)
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(files.makeQualified(draft), files.makeQualified(target), options)
    except Py4JJavaError as e:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def is_committed(spark: SparkSession, root: str, batch: str) -> bool:
    files, place = _files(spark, f"{root}/log/{_checked(batch)}.json")
    return files.exists(place)


def commit_batch(
    spark: SparkSession, root: str, batch: str, outputs: Mapping[str, DataFrame], partition_by: Mapping[str, Sequence[str]] | None = None,
) -> bool:
    """Append the ``outputs`` of a batch to the tables of these names, all or none; False if the batch is in them already."""
    if is_committed(spark, root, batch):
        return False
    attempt, lines = uuid.uuid4().hex, []
    for name, df in outputs.items():
        folder = f"data/{_checked(name)}/{ATTEMPT}={batch}-{attempt}"
        df.write.partitionBy(*(partition_by or {}).get(name, ())).parquet(f"{root}/{folder}")
        found, size = _written(spark, f"{root}/{folder}")
        lines.append({"batch": batch, "output": name, "folder": folder, "files": found, "bytes": size})
    return _publish(spark, f"{root}/log/{batch}.json", "".join(json.dumps(line) + "\n" for line in lines))


def batch_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed batch and output: ``batch, output, folder, files, bytes``."""
    files, place = _files(spark, f"{root}/log")
    if not files.exists(place):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).option("pathGlobFilter", "*.json").json(f"{root}/log")


def read_batches(spark: SparkSession, root: str, output: str, schema: T.StructType | str, batches: Sequence[str] | None = None) -> DataFrame:
    """The table ``output``: the listed files of all committed batches, or of those named. ``schema`` has partition columns as well.

    The paths of all files pass through the driver, as in any read of listed files; a job writes few files per batch.
    """
    log = batch_log(spark, root).where(f"output = '{_checked(output)}'")
    if batches is not None:
        log = log.where(log["batch"].isin(*batches))
    parts = [(r["folder"], r["files"]) for r in log.select("folder", "files").orderBy("folder").collect() if r["files"]]
    if not parts:
        return spark.createDataFrame([], schema)
    # One scan of all files; the folder of an attempt is a partition of the table, which is not handed on.
    files = spark.read.schema(schema).option("basePath", f"{root}/data/{output}")
    return files.parquet(*(f"{root}/{folder}/{name}" for folder, names in parts for name in names)).drop(ATTEMPT)


def left_behind(spark: SparkSession, root: str, output: str) -> list[str]:
    """Folders of attempts that no log entry lists: broken off, or second. They may be deleted once no writer is at work."""
    files, place = _files(spark, f"{root}/data/{_checked(output)}")
    if not files.exists(place):
        return []
    listed = {r["folder"] for r in batch_log(spark, root).where(f"output = '{output}'").select("folder").collect()}
    found = [f"data/{output}/{status.getPath().getName()}" for status in files.listStatus(place)]
    return sorted(f for f in found if f not in listed)
