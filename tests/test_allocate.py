"""Every allocator hands out exactly the pool of the groups that match."""

import datetime as dt

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.operators import allocate

H = [dt.datetime(2024, 3, 10, h) for h in range(4)]


@pytest.fixture
def usage(spark):
    data = [(H[0], "a", 10), (H[0], "b", 30), (H[1], "a", 7), (H[2], "a", 0), (H[3], "c", 5)]
    return spark.createDataFrame(data, "datetime_h timestamp, who string, event_count bigint")


@pytest.fixture
def costs(spark):
    data = [(H[0], 8.0, 6.0), (H[0], 4.0, 4.0), (H[1], 3.0, 2.0), (H[2], 9.0, 9.0), (dt.datetime(2024, 3, 11), 50.0, 40.0)]
    return spark.createDataFrame(data, "datetime_h timestamp, cost double, cost_after_discount double")


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_hourly_rate(usage, costs):
    got = allocate.allocate_by_hourly_rate(usage, costs)
    assert rows(got, "who", "datetime_h", "allocated_cost") == [
        ("a", H[0], 3.0), ("a", H[1], 3.0), ("a", H[2], None), ("b", H[0], 9.0),
    ]
    assert total(got, "allocated_cost") == pytest.approx(8 + 4 + 3)
    assert total(got, "allocated_cost_after_discount") == pytest.approx(6 + 4 + 2)
    local = got.where("who = 'b'").first()["datetime_h_local"]
    assert local == dt.datetime(2024, 3, 9, 16)


def test_unallocated_is_what_the_rate_leaves_out(usage, costs):
    assert rows(allocate.unallocated(usage, costs), "cost") == [(50.0,)]


def test_bytes_by_local_day(spark):
    sizes = spark.createDataFrame(
        [(dt.datetime(2024, 3, 10), "t1", "x", 30), (dt.datetime(2024, 3, 10), "t2", "y", 10), (dt.datetime(2024, 3, 11), "t1", "x", 1)],
        "date timestamp, tenant string, real_name string, size_storage bigint",
    )
    # 10 March 2024 is the day the clocks change in Los Angeles: it lasts from 08:00 UTC to 07:00 UTC, 23 hours
    hours = [dt.datetime(2024, 3, 10, 7, 59), dt.datetime(2024, 3, 10, 8), dt.datetime(2024, 3, 11, 6, 59), dt.datetime(2024, 3, 11, 7)]
    costs = spark.createDataFrame(
        [(h, 100.0, -10.0, 90.0) for h in hours],
        "usage_start_time timestamp, storage_cost double, storage_discount double, storage_after_discount double",
    )
    got = allocate.allocate_by_bytes(sizes, costs, day="2024-03-10")
    assert rows(got, "tenant", "size_storage_percentage", "storage_cost_assigned", "storage_cost_assigned_after_discounts") == [
        ("t1", 75.0, 150.0, 135.0), ("t2", 25.0, 50.0, 45.0),
    ]


def test_components_keep_both_unmatched_sides(spark):
    sizes = spark.createDataFrame([("d", "s1", "t1", 3), ("d", "s1", "t2", 1), ("d", "lost", "t1", 5)],
                                  "day string, sub_component string, tenant string, size_on_disk bigint")
    measures = [*allocate.COMPONENT_MEASURES]
    costs = spark.createDataFrame(
        [("d", "s1", "Shard", *[8.0] * 7), ("d", "r", "Router", *[4.0] * 7), ("d", "s1", "Router", *[2.0] * 7)],
        "day string, sub_component string, component string, " + ", ".join(f"{m} double" for m in measures),
    )
    got = allocate.allocate_by_component(sizes, costs, F.col("component") == "Router")
    assert rows(got, "sub_component", "tenant", "total_allocated_cost") == [
        ("lost", "t1", None), ("r", "internal", 4.0), ("s1", "internal", 2.0), ("s1", "t1", 6.0), ("s1", "t2", 2.0),
    ]
    assert total(got, "total_allocated_cost") == 14.0


def test_requests_by_length_and_by_calls(spark):
    requests = spark.createDataFrame(
        [("d", "01", "x", 10, 2.0, 1), ("d", "01", "y", 30, 4.0, 3), ("d", "02", "x", 5, 1.0, 1)],
        "date string, hour string, host string, length_sum bigint, latency_mean double, call_count bigint",
    )
    pool = spark.createDataFrame([("d", "01", 80.0)], "date string, hour string, cost_h double")
    got = allocate.allocate_by_requests(requests, pool)
    assert rows(got, "host", "hour", "cost_assigned_length", "cost_assigned_call_count", "latency_mean_h") == [
        ("x", "01", 20.0, 20.0, 3.0), ("x", "02", None, None, 1.0), ("y", "01", 60.0, 60.0, 3.0),
    ]


def test_monthly_flat_rate_uses_the_local_month(spark):
    usage = spark.createDataFrame(
        [(dt.datetime(2024, 4, 1, 7), "a", 10), (dt.datetime(2024, 5, 1, 6), "a", 30), (dt.datetime(2024, 4, 1, 6), "a", 99),
         (dt.datetime(2024, 5, 1, 7), "a", 99)], "datetime_h timestamp, who string, event_count bigint")
    costs = spark.createDataFrame(
        [(dt.datetime(2024, 4, 15), 80.0, 40.0), (dt.datetime(2024, 6, 1), 7.0, 7.0)],
        "usage_start_time timestamp, cost double, cost_after_discount double",
    )
    got = allocate.allocate_monthly_flat(usage, costs, "2024-04", ["who"])
    assert rows(got, "event_count_h", "cost_assigned", "cost_assigned_after_discount") == [(10, 20.0, 10.0), (30, 60.0, 30.0)]


def test_even_parts_reach_every_tenant_in_every_month(spark):
    costs = spark.createDataFrame([("2024-01", 10.0), ("2024-01", 20.0), ("2024-02", 6.0)], "m string, cost double")
    tenants = spark.createDataFrame([("a",), ("b",), ("a",)], "tenant string")
    got = allocate.allocate_evenly(costs, tenants, ["cost"], F.col("m"))
    assert rows(got, "month", "tenant", "cost_by_tenant") == [
        ("2024-01", "a", 15.0), ("2024-01", "b", 15.0), ("2024-02", "a", 3.0), ("2024-02", "b", 3.0),
    ]


def test_cost_per_site_keeps_both_sides_and_filters_by_cost_month(spark):
    costs = spark.createDataFrame(
        [("2024-01-01", "IN", 1.0, 2.0), ("2024-01-01", "MA", 4.0, None), ("2024-02-01", "B", 1.0, 1.0)],
        "day string, tenant string, compute_cost double, storage_cost double")
    sites = spark.createDataFrame(
        [("2024-01-01", "H", "1"), ("2024-01-01", "H", "1"), ("2024-01-01", "H", "2"), ("2024-01-01", "C", "9"), ("2024-01-01", "OUT", "5")],
        "day string, tenant string, site string")
    got = allocate.cost_per_site(costs, sites, {"H": ["IN", "MA"]}, excluded=["OUT"])
    assert rows(got, "day", "tenant", "total_cost", "deployed_sites", "total_sites") == [
        ("2024-01-01", "C", None, 1, 3), ("2024-01-01", "H", 7.0, 2, 3), ("2024-02-01", "B", 2.0, None, None),
    ]
    got = allocate.cost_per_site(costs, sites, {"H": ["IN", "MA"]}, excluded=["OUT"], month="2024-01")
    assert rows(got, "tenant") == [("H",)]
