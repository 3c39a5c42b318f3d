import datetime as dt
import uuid

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.operators.events import IDENT, attributes_by_identity, headers_by_identity, widen_events, widen_stored
from tallyloom.sinks import BucketedTable, declare, replace_bucketed

DAY = dt.date(2024, 1, 1)


def table(tmp_path, name, columns, partition_by=(), buckets=4):
    return BucketedTable(f"{name}_{uuid.uuid4().hex}", str(tmp_path / name), f"{IDENT} string, {columns}", [IDENT], buckets, partition_by)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def inputs(spark):
    headers = spark.createDataFrame(
        [(1, "s", "A", DAY), (2, "s", "B", DAY), (2, "s", "B", DAY), (None, "s", "C", DAY), (None, None, None, DAY), (5, "t", None, DAY)],
        "id int, serialNumber string, thingType string, day date")
    pairs = [(1, "s", "k", "v2"), (1, "s", "k", "v1"), (1, "s", "x", "w"), (3, "s", "k", "v"), (None, "s", "k", "n"), (5, "t", "other", "o"), (5, "t", "k", None)]
    attributes = spark.createDataFrame([(*p, DAY) for p in pairs], "metadataId int, serialNumber string, key string, value string, day date")
    return headers, attributes


def test_stored_tables_widen_as_moved_ones_and_move_nothing(spark, tmp_path, conf, inputs):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    headers, attributes = inputs
    stored = table(tmp_path, "headers", "thingType string, day date", ["day"]), table(tmp_path, "attributes", "key string, value string, day date", ["day"])
    for _ in range(2):
        replace_bucketed(headers_by_identity(headers), stored[0])
        replace_bucketed(attributes_by_identity(attributes, carry=["day"]), stored[1])
    got = widen_stored(declare(spark, stored[0]), declare(spark, stored[1]), ["k", "x"]).select(IDENT, "thingType", "k", "x")
    want = widen_events(headers, attributes, ["k", "x"]).select(IDENT, "thingType", "k", "x")
    assert rows(got) == rows(want) and got.count() == 8
    plan = final_plan(got)
    assert "SortMergeJoin" in plan and "FullOuter" in plan and "Exchange" not in plan
    moved = final_plan(want)
    assert moved.count("Exchange") >= 2


def test_a_day_written_again_replaces_itself_only(spark, tmp_path):
    stored = table(tmp_path, "t", "n int, day date", ["day"])
    day = lambda d, *n: spark.createDataFrame([(f"i{x}", x, dt.date(2024, 1, d)) for x in n], f"{IDENT} string, n int, day date")
    for frame in (day(1, 1, 2), day(2, 3), day(1, 4)):
        replace_bucketed(frame, stored)
    assert rows(declare(spark, stored), "n") == [(3,), (4,)]
    files = list((tmp_path / "t").rglob("part-*.parquet"))
    assert 2 <= len(files) <= 2 * stored.buckets
    with pytest.raises(Exception, match="day is a partition and null"):
        replace_bucketed(day(1, 9).withColumn("day", F.lit(None).cast("date")), stored)
    # Another session knows the same files under another name.
    again = BucketedTable(f"other_{uuid.uuid4().hex}", stored.path, stored.schema, stored.keys, stored.buckets, stored.partition_by)
    assert rows(declare(spark, again), "n") == [(3,), (4,)]


def test_a_table_without_partitions_is_replaced_whole(spark, tmp_path):
    stored = table(tmp_path, "u", "n int")
    for n in (1, 2):
        replace_bucketed(spark.createDataFrame([("a", n)], f"{IDENT} string, n int"), stored)
    assert rows(declare(spark, stored), "n") == [(2,)]
    with pytest.raises(ValueError, match="has no column day"):
        declare(spark, BucketedTable("v", stored.path, stored.schema, [IDENT], 4, ["day"]))


def test_headers_without_identity_are_spread(spark):
    headers = spark.range(5000).select(F.lit(None).cast("int").alias("id"), F.col("id").cast("string").alias("serialNumber"))
    sizes = headers_by_identity(headers).groupBy(F.pmod(F.hash(IDENT), F.lit(16))).count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 800
