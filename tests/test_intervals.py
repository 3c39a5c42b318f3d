import datetime as dt
import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.operators.intervals import assign_interval, build_intervals

D = lambda day, h=0: dt.datetime(2024, 1, day, h)


def calendar(spark, *pairs):
    return spark.createDataFrame(list(pairs), "at timestamp, name string")


def facts(spark, *times):
    return spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, t timestamp")


@pytest.mark.parametrize("max_bytes", [0, 1000])
def test_intervals_follow_each_other(spark, max_bytes):
    cal = calendar(spark, (D(9), "b"), (D(3), "a"), (None, "never"), (D(20), "c"))
    got = build_intervals(cal, "at", "name", max_bytes=max_bytes)
    assert rows(got) == [
        (0, "00 a", None, D(3), False), (1, "01 b", D(3), D(9), False), (2, "02 c", D(9), D(20), True),
    ]


def test_first_start_may_be_given(spark):
    got = build_intervals(calendar(spark, (D(3), "a"), (D(9), "b")), "at", "name", F.lit(D(1)), numbered=False)
    assert rows(got, "label", "start") == [("a", D(1)), ("b", D(3))]


def test_ordinals_beyond_two_digits_are_not_cut(spark):
    cal = spark.range(120).select((F.lit(D(1)) + F.make_dt_interval(F.col("id").cast("int"))).alias("at"), F.lit("x").alias("name"))
    labels = {r.label for r in build_intervals(cal, "at", "name").collect()}
    assert {"00 x", "99 x", "100 x", "119 x"} <= labels and len(labels) == 120


@pytest.mark.parametrize("max_bytes", [0, 1000])
@pytest.mark.parametrize("closed, expected", [
    (False, ["a", "a", "b", "b", "c", "c", None, None, None]),
    (True, ["a", "a", "b", "b", "c", "c", "c", None, None]),
])
def test_boundaries(spark, closed, expected, max_bytes):
    cal = build_intervals(calendar(spark, (D(3), "a"), (D(9, 12), "b"), (D(20), "c")), "at", "name", numbered=False)
    when = facts(spark, dt.datetime(1970, 1, 1), D(2, 23), D(3), D(9, 11), D(9, 12), D(19, 23), D(20), D(20, 1), None)
    got = assign_interval(when, cal, "t", "label", closed=closed, max_bytes=max_bytes)
    assert [r.label for r in got.orderBy("id").collect()] == expected


def test_bounded_first_interval_leaves_earlier_facts_out(spark):
    cal = build_intervals(calendar(spark, (D(3), "a")), "at", "name", F.lit(D(2)), numbered=False)
    got = assign_interval(facts(spark, D(1), D(2), D(3)), cal, "t", "x", closed=True, carry=("start", "end"))
    assert rows(got, "id", "x", "x_start", "x_end") == [(0, None, None, None), (1, "a", D(2), D(3)), (2, "a", D(2), D(3))]


@pytest.mark.parametrize("closed", [True, False])
def test_same_as_assigning_one_interval_after_the_other(spark, closed):
    rng = random.Random(5)
    ends = sorted({D(rng.randint(1, 28), rng.randint(0, 23)) for _ in range(12)})
    times = [D(rng.randint(1, 28), rng.randint(0, 23)) for _ in range(200)] + ends
    want, start = [None] * len(times), None
    for n, end in enumerate(ends):
        for i, t in enumerate(times):
            if (start is None or t >= start) and (t <= end if closed else t < end):
                want[i] = f"n{n:02d}"
        start = end
    cal = build_intervals(calendar(spark, *[(e, f"n{n:02d}") for n, e in enumerate(ends)]), "at", "name", numbered=False)
    got = assign_interval(facts(spark, *times), cal, "t", "label", closed=closed)
    assert [r.label for r in got.orderBy("id").collect()] == want
    assert got.count() == len(times)
