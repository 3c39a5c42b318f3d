from collections import Counter

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.operators.aggregate import positions, share_of_total
from tallyloom.operators.intervals import assign_interval, build_intervals
from tallyloom.operators.joins import (
    fits_broadcast, full_outer, left_fan_out, lookup, may_have_hot_key, skew_join, split_by_match, spread_nulls,
)

LEFT = [("a", 1), ("a", 2), ("b", 3), (None, 4), ("z", 5)]
RIGHT = [("a", "x"), ("a", "y"), ("b", "w"), ("c", "v"), (None, "n")]


@pytest.fixture
def left(spark):
    return spark.createDataFrame(LEFT, "k string, l int")


@pytest.fixture
def right(spark):
    return spark.createDataFrame(RIGHT, "k string, r string")


ALWAYS_HOT, NEVER_HOT = {"hot_bytes": 0}, {"hot_bytes": 10**40}
WAYS = pytest.mark.parametrize("way", [{}, ALWAYS_HOT, NEVER_HOT])


@WAYS
def test_full_outer_is_a_full_outer_join(left, right, way):
    assert rows(full_outer(left, right, "k", **way)) == rows(left.join(right, "k", "full_outer"))


@WAYS
def test_full_outer_over_an_aggregate_with_given_keys(left, right, way):
    grouped = right.groupBy("k").agg(F.min("r").alias("r"))
    got = full_outer(left, grouped, ["k"], left_keys=left.select("k"), **way)
    assert rows(got) == rows(left.join(grouped, "k", "full_outer"))


@WAYS
def test_fan_out_is_a_left_join(left, right, way):
    assert rows(left_fan_out(left, right, "k", **way)) == rows(left.join(right, "k", "left"))


def test_a_small_frame_has_no_hot_key(spark):
    df = spark.range(1000).selectExpr("1 as k")
    assert may_have_hot_key(df, 1000) and not may_have_hot_key(df)


def test_choosing_a_way_runs_no_job(spark, left, right):
    tracker, group = spark.sparkContext.statusTracker(), "choosing"
    spark.sparkContext.setJobGroup(group, group)
    lookup(left, right, "k"), full_outer(left, right.distinct(), "k"), left_fan_out(left, right, "k")
    spark.sparkContext.setJobGroup("", "")
    assert not tracker.getJobIdsForGroup(group)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_is_the_join(left, right, how):
    assert rows(skew_join(left, right, "k", how)) == rows(left.join(right, "k", how))


def test_matched_and_unmatched_are_a_partition(left, right):
    found, missing = split_by_match(left, right.groupBy("k").agg(F.min("r").alias("r")), "k")
    assert Counter(r.l for r in found.collect()) + Counter(r.l for r in missing.collect()) == Counter([1, 2, 3, 4, 5])


@pytest.mark.parametrize("max_bytes", [0, 10**30])
def test_lookup_is_the_same_on_both_sides_of_the_bound(left, right, max_bytes):
    assert rows(lookup(left, right, "k", max_bytes=max_bytes)) == rows(left.join(right, "k", "left"))


def test_only_small_tables_are_broadcast(left, right):
    plan = lookup(left, right, "k", max_bytes=10**30)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    plan = lookup(left, right, "k", max_bytes=4)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan


def test_the_bound_follows_the_plan(spark):
    assert fits_broadcast(spark.range(100), 800) and not fits_broadcast(spark.range(100), 799)


def test_nulls_are_spread_and_match_nothing(spark, right):
    many = spark.range(1000).select(F.lit(None).cast("string").alias("k"), "id")
    keyed = many.withColumn("k", spread_nulls("k", "id"))
    assert keyed.select("k").distinct().count() > 500
    assert keyed.join(right, "k", "inner").count() == 0


def _hot(spark):
    """Half of the rows share one key."""
    return spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )


@pytest.fixture
def split_soon(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_a_hot_key_is_split_even_against_an_aggregate(spark, split_soon):
    hot = _hot(spark)
    grouped = hot.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert "skew=true" in _final_plan(skew_join(hot, grouped, "k", "left"))
    # The plain join cannot be split: its right side is not shuffled for the join.
    assert "skew=true" not in _final_plan(hot.join(grouped, "k", "left"))


def test_operators_split_their_hot_keys(spark, split_soon):
    hot = _hot(spark)
    assert "skew=true" in _final_plan(share_of_total(hot, ["k"], "v", "total"))
    parents = hot.select("k").distinct().withColumn("p", F.lit(1))
    assert "skew=true" in _final_plan(left_fan_out(parents, hot, "k", hot_bytes=0))
    unique = hot.groupBy("k").agg(F.max("pad").alias("pad2"))
    assert "skew=true" in _final_plan(full_outer(hot, unique, "k", hot_bytes=0))
    found, missing = split_by_match(hot, unique, "k")
    assert "skew=true" in _final_plan(found)


@pytest.mark.parametrize("few", [True, False, None])
def test_positions_number_the_whole_table(spark, few):
    df = spark.range(0, 500, 1, 5).select((F.col("id") * 37 % 500).alias("x"))
    got = positions(df, ["x"], "n", few).collect()
    assert sorted((r.x, r.n) for r in got) == [(i, i) for i in range(500)]


def test_a_hot_day_is_split_when_the_calendar_is_not_broadcast(spark, split_soon):
    facts = _hot(spark).withColumn("t", F.timestamp_seconds(F.lit(1_700_000_000) + F.when(F.col("k") == 7, 0).otherwise(F.col("k") * 600)))
    ends = spark.range(50).select(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 500_000).alias("at"), F.col("id").cast("string").alias("name"))
    placed = assign_interval(facts, build_intervals(ends, "at", "name"), "t", "label", max_bytes=0)
    assert "skew=true" in _final_plan(placed)
