"""Writes from the executors; no result passes through the driver."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Exactly the declared columns, in order and type; a declared column the frame lacks is null."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str], options: Mapping[str, str] | None):
    writer = df.write.mode(mode).options(**(options or {}))
    return writer.partitionBy(*partition_by) if partition_by else writer


def append(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """Blind append: a second run adds the rows again."""
    _writer(df, "append", partition_by, options).format(fmt).save(path)


def append_day(
    df: DataFrame, path: str, day: str | Sequence[str], fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> None:
    """Append by day: the partitions present in ``df`` are replaced, all others stay, so a re-run does not double.

    ``day`` is the partition column, or several (environment and day): everything one writer of the table tells apart from
    the others. A null there would be shared by all writers, so the write fails. Rows are rebalanced by partition first: few
    files each, and a large one still spread over several tasks.
    """
    keys = [day] if isinstance(day, str) else list(day)
    refused = {k: F.coalesce(k, F.raise_error(F.lit(f"{k} is a partition and null")).cast(df.schema[k].dataType)) for k in keys}
    balanced = df.withColumns(refused).hint("rebalance", *[F.col(k) for k in keys])
    _writer(balanced, "overwrite", keys, {"partitionOverwriteMode": "dynamic", **(options or {})}).format(fmt).save(path)


def overwrite(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    _writer(df, "overwrite", partition_by, {"partitionOverwriteMode": "static", **(options or {})}).format(fmt).save(path)


def write_all(writes: Mapping[str, Callable[[], None]]) -> dict[str, str]:
    """Run every write; a failing one is reported by name and does not stop the others."""
    status = {}
    for name, write in writes.items():
        try:
            write()
            status[name] = "ok"
        except (PySparkException, Py4JError) as e:
            status[name] = failure(e)
    return status


def failure(e: Exception) -> str:
    """Spark's name of an error, or the class and message of one that comes from below it (a path, the storage)."""
    if isinstance(e, PySparkException):
        return e.getCondition() or type(e).__name__
    if isinstance(e, Py4JJavaError):
        return str(e.java_exception).splitlines()[0]
    return f"{type(e).__name__}: {e}".splitlines()[0]


def must_succeed(status: Mapping[str, str]) -> dict[str, str]:
    """``status``, unless a write failed: all have been tried by now, so a job may end with the error."""
    failed = {name: s for name, s in status.items() if s != "ok"}
    if failed:
        raise RuntimeError("; ".join(f"{name}: {s}" for name, s in failed.items()))
    return dict(status)


def write_selected(writes: Mapping[str, Callable[[], None]], choice: str = "All") -> dict[str, str]:
    """Run the write named by ``choice``, or all of them."""
    if choice != "All" and choice not in writes:
        raise KeyError(f"unknown output {choice!r}; known: All, {', '.join(writes)}")
    return write_all(writes if choice == "All" else {choice: writes[choice]})
