import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators import billing
from tallyloom.plans import cost_jobs


def credit(kind, amount):
    return ("n", amount, "f", "i", kind)


def line(credits, cost=100.0, sku="CPU hours", service="svc", when="2024-01-02 10:00:00", resource="r", unit="seconds"):
    import datetime as dt

    return (
        ("1", service), ("2", sku), ("proj", "77"), (5.0, unit), (resource, "//g"), credits, cost, "regular",
        dt.datetime.fromisoformat(when),
    )


def lines(spark, *rows_):
    return spark.createDataFrame(list(rows_), schemas.BILLING_LINE)


DISCOUNT, PROMO = "SUSTAINED_USAGE_DISCOUNT", "PROMOTION"
CASES = [
    # credits, (like), (exact), (all)
    ([], (0, 0), (0, 0), (0, 0)),
    (None, (0, 0), (0, 0), (0, 0)),
    ([credit(DISCOUNT, -1.0)], (-1, 0), (-1, 0), (-1, 0)),
    ([credit(PROMO, -2.0)], (0, -2), (0, -2), (-2, 0)),
    ([credit(DISCOUNT, -1.0), credit(PROMO, -2.0)], (-1, -2), (-1, -2), (-3, 0)),
    ([credit(PROMO, -2.0), credit(DISCOUNT, -1.0)], (-1, -2), (-1, -2), (-3, 0)),
    ([credit(DISCOUNT, -1.0), credit("COMMITTED_USAGE_DISCOUNT", -4.0)], (-5, 0), (-5, 0), (-5, 0)),
    ([credit(None, -1.0), credit(PROMO, -2.0)], (0, -2), (-1, -2), (-3, 0)),
    ([credit(None, -1.0), credit(DISCOUNT, -2.0)], (-2, 0), (-3, 0), (-3, 0)),
    # one of two matching credits without an amount: nothing is known, so nothing is taken
    ([credit(DISCOUNT, None), credit(DISCOUNT, -2.0)], (0, 0), (-2, 0), (-2, 0)),
    ([credit("FREE_TIER", -9.0)], (0, 0), (-9, 0), (-9, 0)),
    # a third credit counts like the others
    ([credit(DISCOUNT, -1.0), credit(DISCOUNT, -1.0), credit(DISCOUNT, -50.0)], (-52, 0), (-52, 0), (-52, 0)),
    ([credit(PROMO, -1.0), credit(None, -1.0), credit(PROMO, -50.0), credit(DISCOUNT, -3.0)], (-3, -51), (-4, -51), (-55, 0)),
    ([credit(DISCOUNT, -1.0), credit(PROMO, -1.0), credit(DISCOUNT, None)], (0, -1), (-1, -1), (-2, 0)),
]


@pytest.mark.parametrize("n", range(len(CASES)))
def test_credit_policies(spark, n):
    credits, *expected = CASES[n]
    flat = billing.flatten_billing(lines(spark, line(credits)))
    for policy, want in zip(("like", "exact", "all"), expected):
        got = billing.split_credits(flat, policy).select("credits_discounts", "credits_promotion").first()
        assert tuple(got) == want, policy


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        billing.split_credits(billing.flatten_billing(lines(spark, line([]))), "none")


def test_compute_and_storage_parts(spark):
    df = lines(spark, line([credit(DISCOUNT, -10.0)]), line([credit(PROMO, -3.0)], 50.0, "SSD space"))
    parts = billing.split_compute_storage(billing.split_credits(billing.flatten_billing(df)))
    got = rows(parts, "compute_cost", "storage_cost", "compute_after_discount", "storage_after_discount",
               "total_after_discounts", "total_after_discounts_promotion")
    assert got == [(100.0, None, 90.0, None, 90.0, 90.0), (None, 50.0, None, 50.0, 50.0, 47.0)]


def test_only_compute_and_only_storage_share_the_lines_with_an_sku(spark):
    df = billing.flatten_billing(lines(spark, line([], sku="SSD a"), line([], sku="b"), line([], sku=None)))
    assert billing.only_compute(df).count() == 1 and billing.only_storage(df).count() == 1


def test_project_summary_moves_services_and_keeps_unknown_projects(spark):
    projects = spark.createDataFrame([("moved", "gold")], "id string, tier string")
    df = lines(spark, line([], service="special"), line([credit(DISCOUNT, -1.0)]), line([credit(PROMO, -2.0)]))
    got = billing.project_cost_summary(df, projects, {"special": "moved"})
    assert rows(got, "id_project", "tier", "total_cost", "total_after_discounts", "total_promotion_credits") == [
        ("moved", "gold", 100.0, 100.0, 0.0), ("proj", None, 200.0, 199.0, -2.0),
    ]


def test_nested_fields_are_pruned_at_the_scan(spark, tmp_path):
    lines(spark, line([])).write.parquet(str(tmp_path / "b"))
    flat = billing.only_compute(billing.flatten_billing(spark.read.parquet(str(tmp_path / "b"))))
    plan = flat.select("cost", "sku_description")._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "sku:struct<description:string>" in schema and "credits" not in schema and "resource" not in schema


def test_component_allocation_conserves_the_pool_and_gives_shared_parts_to_internal(spark):
    import datetime as dt

    df = lines(
        spark,
        line([credit(DISCOUNT, -10.0)], resource="mongo-shard-1-a", when="2024-01-02 20:00:00"),
        line([], 60.0, "SSD", resource="mongo-shard-1-b", when="2024-01-02 20:00:00"),
        line([], 40.0, resource="mongo-router-0", when="2024-01-02 20:00:00"),
        line([], 999.0, resource="kafka-0", when="2024-01-02 20:00:00"),
        line([], 999.0, resource="mongo-shard-1-a", when="2024-01-02 05:00:00"),  # still 1 January in Los Angeles
    )
    sizes = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2), "rs0_1", "t1", 30), (dt.datetime(2024, 1, 2), "rs0_1", "t2", 10),
         (dt.datetime(2024, 1, 2), "rs0_2", "t1", 5)], schemas.DATABASE_SIZE,
    )
    got = cost_jobs.component_allocation(sizes, df, "ENV", "2024-01-02")
    assert rows(got, "sub_component", "tenant", "total_allocated_cost", "total_allocated_cost_after_discount") == [
        ("Mongo DB Platform - Router", "internal", 40.0, 40.0),
        ("Mongo DB Platform - Shard 1", "t1", 120.0, 112.5),
        ("Mongo DB Platform - Shard 1", "t2", 40.0, 37.5),
        ("Mongo DB Platform - Shard 2", "t1", None, None),
    ]
    assert got.agg(F.sum("total_allocated_cost")).first()[0] == 200.0


def test_month_report_and_even_allocation(spark):
    df = lines(
        spark, line([credit(DISCOUNT, -10.0)], when="2024-02-01 05:00:00"),  # 31 January in Los Angeles
        line([credit(PROMO, -5.0)], 50.0, "SSD", when="2024-01-10 00:00:00"), line([], 7.0, when="2024-02-01 09:00:00"),
    )
    report = cost_jobs.local_cost_report(df, "2024-01")
    totals = report.agg(F.sum("total_cost"), F.sum("total_after_discounts"), F.sum("total_compute_cost")).first()
    assert tuple(totals) == (150.0, 140.0, 100.0)
    adjusted = cost_jobs.adjusted_report(report, flat=10.0, rate=0.5)
    # 90 - 10/2 - 90 * 0.5 for the hour with compute, 0 - 10/2 - 50 * 0.5 for the one without
    assert rows(adjusted, "total_compute_after_adjustment") == [(-30.0,), (40.0,)]
    sites = spark.createDataFrame([("A",), ("A",), ("B",), ("X",)], "tenant_parent_code string")
    even = cost_jobs.even_allocation(df, sites, ["A", "B"], "ENV", "2024-01")
    assert rows(even, "tenant_parent_code", "month", "total_cost_by_tenant", "environment") == [
        ("A", "2024-01", 75.0, "ENV"), ("B", "2024-01", 75.0, "ENV"),
    ]


@pytest.mark.parametrize("max_bytes", [0, 8 << 20])
def test_names_mapped_once_as_line_by_line(spark, max_bytes):
    names = [("a-gw-1", "g/x"), ("db-a", None), (None, "g/db"), (None, None), ("plain", "plain"), ("a-gw-1", "g/y"), ("db-gw", "g/x")]
    lines = spark.range(700).join(
        spark.createDataFrame([(i, *n) for i, n in enumerate(names)], "i int, resource_name string, resource_global_name string"),
        F.col("id") % len(names) == F.col("i")).withColumn("component", F.lit("before"))
    by_name, by_global = [("%gw%", "gateway"), ("db%", "store")] + [(f"%none{i}%", "x") for i in range(60)], [("%db", "store"), ("g/%", "group")]
    for mode in ("first", "last"):
        mapped = lambda rows, mode=mode: billing.map_component(rows, by_name, by_global, mode, default="N/A")
        once = billing.map_once(lines, ["resource_name", "resource_global_name"], mapped, max_bytes)
        assert rows(once, "id", "component") == rows(mapped(lines), "id", "component") and once.columns.count("component") == 1
