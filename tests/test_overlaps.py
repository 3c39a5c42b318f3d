import datetime as dt
import random
import re

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.operators.overlaps import assign_latest, winning_segments

D = lambda day, h=0: dt.datetime(2024, 1, day, h)
LISTED = "ordinal int, start timestamp, end timestamp, label string"


def facts(spark, times):
    return spark.createDataFrame(list(enumerate(times)), "id int, t timestamp")


def last_of_list(times, listed, closed):
    """One interval after the other, each overwriting what it covers."""
    out = [None] * len(times)
    for _, start, end, label in sorted(listed, key=lambda i: i[0]):
        for n, t in enumerate(times):
            if t is not None and (start is None or t >= start) and (end is None or (t <= end if closed else t < end)):
                out[n] = label
    return out


@pytest.mark.parametrize("max_bytes", [0, 8 << 20])
def test_nested_and_crossing_intervals(spark, max_bytes):
    listed = [(0, D(2), D(20), "wide"), (1, D(5), D(8), "inner"), (2, D(7), D(12), "crossing"), (3, D(9), D(9), "point"), (4, D(15), D(14), "never")]
    got = winning_segments(spark.createDataFrame(listed, LISTED), ["ordinal"], max_bytes=max_bytes)
    assert rows(got) == [
        (D(2), D(5), "wide"), (D(5), D(7), "inner"), (D(7), D(8), "crossing"), (D(8), D(12), "crossing"), (D(12), D(20), "wide")]
    closed = winning_segments(spark.createDataFrame(listed, LISTED), ["ordinal"], closed=True, max_bytes=max_bytes)
    tick = dt.timedelta(microseconds=1)
    assert (D(9), D(9) + tick, "point") in rows(closed) and (D(12) + tick, D(20) + tick, "wide") in rows(closed)


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("max_bytes, width", [(8 << 20, 86_400_000_000), (0, 3_600_000_000), (0, 7 * 86_400_000_000)])
def test_same_as_overwriting_in_the_order_of_the_list(spark, closed, max_bytes, width):
    draw = random.Random(11)
    when = lambda: D(draw.randint(1, 28), draw.randint(0, 23))
    listed = []
    for n in range(60):
        start = when()
        listed.append((n, start, start + dt.timedelta(hours=draw.choice([0, 1, 5, 30, 200])), f"i{n}"))
    listed += [(60, None, D(2), "open"), (61, D(28), None, "ending"), (-1, None, None, "always"), (62, D(3), D(3), "point")]
    draw.shuffle(listed)
    times = [when() for _ in range(300)] + [i[1] for i in listed] + [i[2] for i in listed]
    times += [dt.datetime(1950, 1, 1), dt.datetime(2090, 1, 1), None]
    given = spark.createDataFrame(listed, LISTED).repartition(3)
    for some, plain in ((given, listed), (given.where("label <> 'always' and start is not null and end is not null"), [i for i in listed if i[1] and i[2]])):
        got = assign_latest(facts(spark, times), some, "t", ["ordinal"], closed=closed, width=width, max_bytes=max_bytes)
        assert got.columns == ["id", "t", "label"]
        assert [r.label for r in got.orderBy("id").collect()] == last_of_list(times, plain, closed)


def test_no_intervals_and_no_facts(spark):
    none = spark.createDataFrame([], LISTED)
    assert rows(assign_latest(facts(spark, [D(1), None]), none, "t", ["ordinal"]), "id", "label") == [(0, None), (1, None)]
    assert winning_segments(none, ["ordinal"]).count() == 0
    some = spark.createDataFrame([(0, D(1), D(2), "a")], LISTED)
    assert assign_latest(facts(spark, [D(1)]).limit(0), some, "t", ["ordinal"]).count() == 0
    always = spark.createDataFrame([(0, None, None, "a")], LISTED)
    assert rows(assign_latest(facts(spark, [D(1), None]), always, "t", ["ordinal"]), "id", "label") == [(0, "a"), (1, None)]


def test_equal_intervals_and_ties(spark):
    same = spark.range(500).select(
        F.lit(1).alias("ordinal"), F.lit(D(1)).cast("timestamp").alias("start"), F.lit(D(2)).cast("timestamp").alias("end"), F.col("id").cast("string").alias("label"))
    assert rows(winning_segments(same, ["ordinal"])) == [(D(1), D(2), "99")]


def test_many_segments_under_one_interval_stay_few_rows(spark):
    """An interval over n segments is listed in as many blocks as log n, not n times."""
    n = 4096
    cuts = spark.range(n).select(F.col("id").cast("int").alias("ordinal"), F.timestamp_seconds("id").alias("start"), F.timestamp_seconds(F.col("id") + 1).alias("end"), F.lit("small").alias("label"))
    wide = spark.range(300).select((F.col("id") - 1000).cast("int").alias("ordinal"), F.timestamp_seconds(F.lit(0)).alias("start"), F.timestamp_seconds(n + F.col("id")).alias("end"), F.lit("wide").alias("label"))
    got = winning_segments(cuts.unionByName(wide), ["ordinal"])
    assert got.groupBy("label").count().collect() and {r["label"]: r["count"] for r in got.groupBy("label").count().collect()} == {"small": n, "wide": 299}


def test_no_product_of_facts_and_intervals(spark):
    listed = spark.range(2000).select(F.col("id").cast("int").alias("ordinal"), F.timestamp_seconds(F.col("id") * 60).alias("start"), F.timestamp_seconds(F.col("id") * 60 + 9999).alias("end"), F.lit("x").alias("label"))
    got = assign_latest(facts(spark, [D(1)] * 20), listed, "t", ["ordinal"], max_bytes=0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("closed", [True, False])
def test_dense_instants_are_sorted_and_never_compared_with_all_segments_of_a_day(spark, conf, closed):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="13")
    listed = [(n, D(1, 1) + dt.timedelta(seconds=n % 40), D(1, 1) + dt.timedelta(seconds=n % 40 + n % 7), f"i{n}") for n in range(200)]
    times = [D(1, 1) + dt.timedelta(seconds=n % 60 - 5) for n in range(900)] + [D(1, 1) + dt.timedelta(seconds=20)] * 900 + [None] * 300
    got = assign_latest(facts(spark, times).repartition(5), spark.createDataFrame(listed, LISTED), "t", ["ordinal"], closed=closed, max_bytes=0)
    assert [r.label for r in got.orderBy("id").collect()] == last_of_list(times, listed, closed)
    assert not re.search(r"Join.*(>=|<)", got._jdf.queryExecution().executedPlan().toString())
