"""Landing events to classified hourly counts: files that land twice count once, and a batch that is replayed as well.

The stream drops repeated events, names them by the same rules as the daily job, and hands every micro-batch's counts to the
batch log under the number of the micro-batch. The log holds increments: the counts of an hour are their sum, so an hour may get
more events as long as they are within the grace, and no state is kept for it beyond the identities of its events.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.functions.columns import hour_of
from tallyloom.operators.aggregate import count_by
from tallyloom.operators.rules import classify
from tallyloom.operators.shape import MISSING
from tallyloom.sinks.batches import commit_batch, read_batches
from tallyloom.streaming.hourly import LATENESS

OUTPUT = "counts"


def once_each(events: DataFrame, ids: Sequence[str], time: str, lateness: str = LATENESS) -> DataFrame:
    """Each event once, by its ``ids``: state holds identities for the grace, events later than that are dropped.

    A repetition may carry another time than the first arrival, as long as it comes within the grace of it.
    """
    instants = events.withColumn(time, F.col(time).cast("timestamp"))
    return instants.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(ids))


def classified_stream(
    events: DataFrame, rules: DataFrame, keys: Sequence[str], targets: Sequence[str], ids: Sequence[str], time: str,
    lateness: str = LATENESS, default: str = MISSING,
) -> DataFrame:
    """Events once each, with one column per target of the rule table; the rules are read as they are when a micro-batch begins."""
    return classify(once_each(events, ids, time, lateness), rules, keys, targets, default)


def write_counts_stream(stream: DataFrame, time: str, dims: Sequence[str], root: str, checkpoint: str, name: str = "stream") -> StreamingQuery:
    """Counts per UTC hour and ``dims`` of all files that have landed, in increments by micro-batch below ``root``."""
    return stream.writeStream.foreachBatch(count_batch(time, dims, root, name)).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()


def count_batch(time: str, dims: Sequence[str], root: str, name: str = "stream") -> Callable[[DataFrame, int], None]:
    """What is done with a micro-batch. One that is replayed after a crash finds itself in the log and adds nothing."""
    def run(batch: DataFrame, number: int) -> None:
        hours = batch.withColumn("datetime_h", hour_of(time))
        counts = count_by(hours, ["datetime_h", *dims]).withColumn("day", F.to_date("datetime_h"))
        commit_batch(batch.sparkSession, root, f"{name}-{number}", {OUTPUT: counts}, {OUTPUT: ["day"]})

    return run


def counts_so_far(spark: SparkSession, root: str, dims: T.StructType | str) -> DataFrame:
    """The sum of all increments; ``dims`` is the schema of the dimensions."""
    fields = (T.StructType.fromDDL(dims) if isinstance(dims, str) else dims).fields
    schema = T.StructType([
        T.StructField("datetime_h", T.TimestampType()), *fields, T.StructField("event_count", T.LongType()), T.StructField("day", T.DateType())])
    names = [f.name for f in fields]
    return read_batches(spark, root, OUTPUT, schema).groupBy("datetime_h", *names).agg(F.sum("event_count").alias("event_count"))
