import datetime as dt
import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.operators.bitmaps import counts_of_bitmaps, distinct_bitmaps, merge_bitmaps, new_numbers


@pytest.fixture
def visits(spark):
    draw = random.Random(3)
    made = [(dt.date(2024, draw.choice([1, 2]), draw.randint(1, 9)), draw.choice("ab"), draw.choice([None, *range(40)]), f"s{draw.randint(0, 9)}") for _ in range(600)]
    return spark.createDataFrame(made, "day date, kind string, item int, site string")


def test_months_from_days_are_the_counts_of_the_raw_rows(spark, visits):
    numbers = {c: new_numbers(visits, c) for c in ("item", "site")}
    days = distinct_bitmaps(visits, ["day", "kind"], numbers)
    month = days.withColumn("month", F.trunc("day", "month"))
    for keys in (["month", "kind"], ["kind"], ["month"], ["day", "kind"]):
        raw = visits.withColumn("month", F.trunc("day", "month")).groupBy(*keys).agg(F.count_distinct("item").alias("items"), F.count_distinct("site").alias("sites"))
        assert rows(counts_of_bitmaps(month, keys, {"items": "item", "sites": "site"})) == rows(raw)


def test_a_dictionary_grows_and_keeps_its_numbers(spark):
    values = lambda *v: spark.createDataFrame([(x,) for x in v], "v string")
    first = new_numbers(values("c", "a", None, "a"), "v")
    assert rows(first) == [("a", 1), ("c", 2)]
    more = new_numbers(values("b", "a", "d"), "v", first)
    assert rows(more) == [("b", 3), ("d", 4)]
    assert new_numbers(values("a"), "v", first).count() == 0


def test_many_values_take_several_buckets(spark):
    many = spark.range(100_000).select((F.col("id") % 3).alias("g"), "id")
    sets = distinct_bitmaps(many, ["g"], {"id": new_numbers(many, "id")})
    assert sets.select("bucket").distinct().count() == 4
    assert rows(counts_of_bitmaps(sets, ["g"], {"n": "id"})) == [(0, 33334), (1, 33333), (2, 33333)]
    assert rows(counts_of_bitmaps(sets.unionByName(sets), [], {"n": "id"})) == [(100_000,)]


def test_a_value_without_a_number_is_an_error(spark, visits):
    known = new_numbers(visits.where("site <> 's1'"), "site")
    with pytest.raises(Exception, match="no number for site s1"):
        distinct_bitmaps(visits, ["kind"], {"site": known}).collect()


def test_merging_moves_one_row_per_task_and_bucket(spark, visits):
    sets = distinct_bitmaps(visits, ["day", "kind"], {"site": new_numbers(visits, "site")})
    plan = merge_bitmaps(sets, ["kind"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_or_agg" in plan
