"""Billing lines, credits, components and allocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import day_text, hour_text, month_text
from tallyloom.operators import allocate, billing
from tallyloom.operators.aggregate import share_of_total, sum_all, sum_by, sum_by_unit, top_unmapped, totals
from tallyloom.operators.events import hourly_event_counts
from tallyloom.plans.cost_jobs import adjusted_report, local_cost_report
from tallyloom.plans.fixed_values import UNIT_SUMS
from tallyloom.session import scratch_path
from tallyloom.sinks import overwrite, write_conserved
from tallyloom.sources import credits_of_text
from tallyloom.workload.registry import query
from tallyloom.workload.standins import (
    BILLING, PURCHASES, STORAGE, billing_lines, k, plain, purchases, read, units,
)

USAGE = """usage AS (
  SELECT date_trunc('hour', ts) AS datetime_h, event_type, user_id, count(*) AS event_count
  FROM events WHERE event_type <> 'purchase' GROUP BY ALL
)"""


def usage_counts(spark: SparkSession, sf: str) -> DataFrame:
    used = read(spark, sf, "events").where(F.col("event_type") != "purchase")
    return hourly_event_counts(used, "ts", ["event_type", "user_id"])


@query(f"""
WITH {USAGE}, {PURCHASES}, u AS (SELECT datetime_h, sum(event_count) AS n FROM usage GROUP BY 1),
p AS (SELECT datetime_h, sum(cost) AS cost, sum(after) AS after FROM pool GROUP BY 1)
SELECT usage.datetime_h, event_type, user_id, event_count,
       (p.cost / (n / 1000.0::DOUBLE)) AS cost_per_1000, (p.after / (n / 1000.0::DOUBLE)) AS cost_per_1000_after_discount,
       (event_count / 1000.0::DOUBLE * (p.cost / (n / 1000.0::DOUBLE))) AS allocated_cost,
       (event_count / 1000.0::DOUBLE * (p.after / (n / 1000.0::DOUBLE))) AS allocated_cost_after_discount,
       timezone('America/Los_Angeles', timezone('UTC', usage.datetime_h)) AS datetime_h_local
FROM usage JOIN u ON usage.datetime_h = u.datetime_h JOIN p ON usage.datetime_h = p.datetime_h
""")
def alloc_hourly_rate(spark: SparkSession, sf: str) -> DataFrame:
    out = allocate.allocate_by_hourly_rate(usage_counts(spark, sf), purchases(spark, sf))
    return out.withColumn("datetime_h", plain("datetime_h"))


@query(f"""
WITH {USAGE}, {PURCHASES}
SELECT datetime_h, sum(cost) AS cost, sum(after) AS cost_after_discount
FROM pool WHERE datetime_h NOT IN (SELECT datetime_h FROM usage WHERE isodow(datetime_h) < 6) GROUP BY 1
""")
def alloc_unallocated(spark: SparkSession, sf: str) -> DataFrame:
    """Cost of the hours without usage, for a service that is used on working days."""
    working_days = usage_counts(spark, sf).where(F.weekday("datetime_h") < 5)
    left = allocate.unallocated(working_days, purchases(spark, sf))
    return left.withColumn("datetime_h", plain("datetime_h"))


@query(f"""
WITH {USAGE}, {PURCHASES}, used AS (SELECT DISTINCT datetime_h FROM usage WHERE isodow(datetime_h) < 6),
p AS (SELECT datetime_h, sum(cost)::DOUBLE AS cost, sum(after)::DOUBLE AS after FROM pool WHERE datetime_h NOT IN (SELECT datetime_h FROM used) GROUP BY 1)
SELECT datetime_h, 'cost' AS amount, cost AS pool, 0.0::DOUBLE AS allocated, cost AS difference FROM p WHERE abs(cost) > 1e-9
UNION ALL SELECT datetime_h, 'cost_after_discount', after, 0.0::DOUBLE, after FROM p WHERE abs(after) > 1e-9
""")
def conservation_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly allocation of a service that is used on working days, written under watch: the hours whose cost was lost."""
    path = scratch_path(spark, "conserved")
    working_days = usage_counts(spark, sf).where(F.weekday("datetime_h") < 5)
    result = write_conserved(
        purchases(spark, sf), lambda pool: allocate.allocate_by_hourly_rate(working_days, pool),
        {"cost": "allocated_cost", "cost_after_discount": "allocated_cost_after_discount"}, ["datetime_h"],
        lambda df: overwrite(df, path), lambda: spark.read.parquet(path))
    lost = result.differences
    if lost is None:
        lost = spark.createDataFrame([], "datetime_h timestamp_ntz, amount string, pool double, allocated double, difference double")
    return lost.withColumn("datetime_h", plain("datetime_h"))


# -- credits and parts -----------------------------------------------------------------------------------------------

ANY_CREDITS = """
WITH t AS (
  SELECT l_returnflag, l_linenumber % 4 AS n,
    [{'type': 'A_DISCOUNT', 'amount': -l_linenumber}, {'type': 'PROMOTION', 'amount': -2 * l_linenumber},
     {'type': CASE WHEN l_linestatus = 'F' THEN 'B_DISCOUNT' ELSE 'PROMOTION' END, 'amount': -l_partkey}] AS credits FROM lineitem),
c AS (SELECT l_returnflag, n, list_filter(credits[1:n], lambda x: x.type LIKE '%DISCOUNT%') AS d,
        list_filter(credits[1:n], lambda x: x.type = 'PROMOTION') AS p FROM t)
SELECT l_returnflag AS id_project, n AS usage_amount, sum(coalesce(list_sum(list_transform(d, lambda x: x.amount)), 0))::DOUBLE AS discounts,
       sum(coalesce(list_sum(list_transform(p, lambda x: x.amount)), 0))::DOUBLE AS promotions
FROM c GROUP BY 1, 2
"""


def _three_credits() -> Column:
    number, status = F.col("l_linenumber"), F.col("l_linestatus")
    credit = lambda kind, amount: F.struct(F.lit("c").alias("name"), amount.cast("double").alias("amount"), kind.alias("type"))
    three = F.array(
        credit(F.lit("A_DISCOUNT"), -number), credit(F.lit("PROMOTION"), -2 * number),
        credit(F.when(status == "F", F.lit("B_DISCOUNT")).otherwise("PROMOTION"), -F.col("l_partkey")))
    return F.slice(three, 1, number % 4)


def _sum_credits(lines: DataFrame, credits: Column) -> DataFrame:
    named = lambda *names: F.struct(*[F.lit("x").alias(n) for n in names])
    lines = lines.select(
        named("id", "description").alias("service"), named("id", "description").alias("sku"),
        F.struct(F.col("l_returnflag").alias("id")).alias("project"), F.struct((F.col("l_linenumber") % 4).alias("amount"), F.lit("u").alias("unit")).alias("usage"),
        credits.alias("credits"), F.lit(0.0).alias("cost"), F.lit("regular").alias("cost_type"),
        F.col("l_shipdate").alias("usage_start_time"))
    flat = billing.flatten_billing(lines)
    # Both policies on the same row, so that the lines are read, and their credits parsed, once.
    for policy in ("like", "exact"):
        split = F.struct("credits_discounts", "credits_promotion").alias(policy)
        flat = billing.split_credits(flat, policy).select("*", split).drop("credits_discounts", "credits_promotion")
    same = flat.select("id_project", "usage_amount", F.inline(F.array("like", "exact")))
    return same.groupBy("id_project", "usage_amount").agg(
        (F.sum("credits_discounts") / 2).alias("discounts"), (F.sum("credits_promotion") / 2).alias("promotions"))


@query(ANY_CREDITS)
def split_credits_any_number(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of none to three credits; all policies that tell discounts from promotions agree on them."""
    return _sum_credits(read(spark, sf, "lineitem"), _three_credits())


@query(ANY_CREDITS)
def split_credits_text(spark: SparkSession, sf: str) -> DataFrame:
    """The same credits as they arrive printed: single quotes, nothing or a comma between them."""
    printed = F.transform(_three_credits(), lambda c: F.concat(
        F.lit("{'name': 'it is', 'amount': "), c["amount"].cast("string"), F.lit(", 'full_name': None, 'id': '', 'type': '"), c["type"], F.lit("'}")))
    between = F.when(F.col("l_linestatus") == "F", F.lit("\n ")).otherwise(F.lit(", "))
    text = F.concat(F.lit("["), F.aggregate(printed, F.lit(""), lambda a, p: F.when(a == "", p).otherwise(F.concat(a, between, p))), F.lit("]"))
    # Parsing costs far more than moving the few columns it needs, and a file may hold all rows in one group, which is one task's.
    lines = read(spark, sf, "lineitem").select("l_returnflag", "l_linenumber", "l_linestatus", "l_partkey", "l_shipdate").hint("rebalance")
    return _sum_credits(lines, credits_of_text(text))


def _credits(spark: SparkSession, sf: str, policy: str) -> DataFrame:
    split = billing.split_credits(billing.flatten_billing(billing_lines(spark, sf)), policy)
    return sum_by(split, ["id_project", "service_description"], {
        "discounts": "credits_discounts", "promotions": "credits_promotion",
    })


def _credit_sql(discount: str, promotion: str) -> str:
    return f"""
WITH {BILLING}
SELECT id_project, service_description, sum({discount}) AS discounts, sum({promotion}) AS promotions
FROM c GROUP BY 1, 2
"""


@query(_credit_sql("disc", "promo"))
def split_credits_like(spark: SparkSession, sf: str) -> DataFrame:
    return _credits(spark, sf, "like")


@query(_credit_sql("disc_exact", "promo_exact"))
def split_credits_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _credits(spark, sf, "exact")


@query(_credit_sql("a1 + a2", "0.0::DOUBLE"))
def split_credits_all(spark: SparkSession, sf: str) -> DataFrame:
    return _credits(spark, sf, "all")


PARTS = (
    "compute_cost", "storage_cost", "compute_discount", "storage_discount", "compute_after_discount",
    "storage_after_discount", "total_after_discounts", "total_after_discounts_promotion",
)


@query(f"""
WITH {BILLING}
SELECT id_project, usage_unit,
       sum(CASE WHEN NOT is_storage THEN cost END) AS compute_cost,
       sum(CASE WHEN is_storage THEN cost END) AS storage_cost,
       sum(CASE WHEN NOT is_storage THEN disc END) AS compute_discount,
       sum(CASE WHEN is_storage THEN disc END) AS storage_discount,
       sum(CASE WHEN NOT is_storage THEN cost + disc END) AS compute_after_discount,
       sum(CASE WHEN is_storage THEN cost + disc END) AS storage_after_discount,
       sum(cost + disc) AS total_after_discounts,
       sum(cost + disc + promo) AS total_after_discounts_promotion
FROM c GROUP BY 1, 2
""")
def compute_storage_split(spark: SparkSession, sf: str) -> DataFrame:
    flat = billing.flatten_billing(billing_lines(spark, sf))
    parts = billing.split_compute_storage(billing.split_credits(flat), mark=STORAGE)
    return sum_by(parts, ["id_project", "usage_unit"], {p: p for p in PARTS})


# -- components ------------------------------------------------------------------------------------------------------

BY_NAME = (("%bolt", "Fasteners"), ("red%", "Red line"), ("%gear%", "Drives"), ("%ring", "Seals"))
BY_GLOBAL = (("%/PROMO", "Promotions"), ("//Brand#1%", "First brands"))
SUBS = (("%blue%", "Blue"), ("%ring%", "Rings"))
COMPONENT = """CASE WHEN resource_name LIKE '%bolt' THEN 'Fasteners' WHEN resource_name LIKE 'red%' THEN 'Red line'
            WHEN resource_name LIKE '%gear%' THEN 'Drives' WHEN resource_name LIKE '%ring' THEN 'Seals'
            WHEN resource_global_name LIKE '%/PROMO' THEN 'Promotions'
            WHEN resource_global_name LIKE '//Brand#1%' THEN 'First brands' END"""


COMPONENT_MAP = f"""
WITH {BILLING}, m AS (SELECT *, {COMPONENT} AS component FROM c)
SELECT component,
       CASE WHEN component IS NULL THEN 'N/A' WHEN resource_name LIKE '%blue%' THEN 'Blue'
            WHEN resource_name LIKE '%ring%' THEN 'Rings' WHEN resource_name LIKE 'cold%' THEN resource_name
            ELSE 'N/A' END AS sub_component,
       date_trunc('month', local_time)::DATE AS month, sum(cost) AS cost,
       sum(cost + disc) AS total_after_discounts, count(*) AS lines
FROM m GROUP BY 1, 2, 3
"""


def _component_costs(detailed: DataFrame) -> DataFrame:
    month = detailed.withColumn("month", F.trunc("usage_start_time_local", "month"))
    return month.groupBy("component", "sub_component", "month").agg(
        F.sum("cost").alias("cost"), F.sum("total_after_discounts").alias("total_after_discounts"),
        F.count(F.lit(1)).alias("lines"),
    )


@query(COMPONENT_MAP)
def component_map(spark: SparkSession, sf: str) -> DataFrame:
    return _component_costs(billing.detailed_costs(billing_lines(spark, sf), BY_NAME, BY_GLOBAL, SUBS, verbatim=("cold%",)))


@query(COMPONENT_MAP)
def component_map_once(spark: SparkSession, sf: str) -> DataFrame:
    """The patterns are tried on the distinct names only."""
    return _component_costs(billing.detailed_costs(billing_lines(spark, sf), BY_NAME, BY_GLOBAL, SUBS, verbatim=("cold%",), once=True))


COMPONENT_LAST = f"""
WITH {BILLING}
SELECT coalesce(
         CASE WHEN contains(resource_name, 'ring') THEN 'Seals' WHEN contains(resource_name, 'gear') THEN 'Drives'
              WHEN contains(resource_name, 'red') THEN 'Red line' WHEN contains(resource_name, 'bolt') THEN 'Fasteners' END,
         CASE WHEN contains(resource_global_name, 'Brand#1') THEN 'First brands'
              WHEN contains(resource_global_name, 'PROMO') THEN 'Promotions' END, 'other') AS component,
       sum(cost) AS cost, count(*) AS lines
FROM c GROUP BY 1
"""


def _last_component(rows: DataFrame) -> DataFrame:
    by_name = [(p.strip("%"), c) for p, c in BY_NAME]
    by_global = [("PROMO", "Promotions"), ("Brand#1", "First brands")]
    return billing.map_component(rows, by_name, by_global, mode="last", default="other")


@query(COMPONENT_LAST)
def component_map_last(spark: SparkSession, sf: str) -> DataFrame:
    mapped = _last_component(billing.flatten_billing(billing_lines(spark, sf), resource=True))
    return mapped.groupBy("component").agg(F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("lines"))


@query(COMPONENT_LAST)
def component_map_last_once(spark: SparkSession, sf: str) -> DataFrame:
    flat = billing.flatten_billing(billing_lines(spark, sf), resource=True)
    mapped = billing.map_once(flat, ["resource_name", "resource_global_name"], _last_component)
    return mapped.groupBy("component").agg(F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("lines"))


@query(f"""
WITH {BILLING}, m AS (SELECT *, {COMPONENT} AS component FROM c)
SELECT service_description, resource_name, resource_global_name, sum(cost) AS cost
FROM m WHERE component IS NULL GROUP BY 1, 2, 3
""", name="top_unmapped")
def unmapped_costs(spark: SparkSession, sf: str) -> DataFrame:
    flat = billing.flatten_billing(billing_lines(spark, sf), resource=True)
    mapped = billing.map_component(flat, BY_NAME, BY_GLOBAL)
    keys = ["service_description", "resource_name", "resource_global_name"]
    return top_unmapped(mapped, "component", keys, "cost")


@query(f"""
WITH {BILLING}, m AS (
  SELECT *, CASE WHEN service_description = 'PROMO' THEN 'Supplier#000000000' ELSE id_project END AS project FROM c
)
SELECT usage_start_time, project AS id_project, service_description, sku_description, usage_unit,
       sum(cost) AS total_cost, sum(usage_amount) AS total_amount,
       sum(cost + disc) AS total_after_discounts, sum(disc) AS total_amount_credits,
       sum(promo) AS total_promotion_credits, sum(CASE WHEN NOT is_storage THEN cost END) AS total_compute_cost,
       sum(CASE WHEN is_storage THEN cost END) AS total_storage_cost, any_value(n_name) AS unit_finance, any_value(r_name) AS entity_finance,
       any_value(local_time) AS usage_start_time_local
FROM m LEFT JOIN supplier ON project = s_name LEFT JOIN nation ON s_nationkey = n_nationkey
     LEFT JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2, 3, 4, 5
""")
def project_summary(spark: SparkSession, sf: str) -> DataFrame:
    supplier, nation, region = (read(spark, sf, t) for t in ("supplier", "nation", "region"))
    places = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    projects = supplier.join(places, supplier.s_nationkey == places.n_nationkey, "left").select(
        F.col("s_name").alias("id"), F.col("n_name").alias("unit_finance"), F.col("r_name").alias("entity_finance")
    )
    return billing.project_cost_summary(billing_lines(spark, sf), projects, {"PROMO": "Supplier#000000000"}, mark=STORAGE)


# -- allocators ------------------------------------------------------------------------------------------------------


def stored_bytes(spark: SparkSession, sf: str) -> DataFrame:
    line, supplier = read(spark, sf, "lineitem"), read(spark, sf, "supplier")
    return line.join(supplier, line.l_suppkey == supplier.s_suppkey, "left").select(
        F.col("l_shipdate").alias("date"), F.col("s_name").alias("tenant"), F.col("l_linestatus").alias("real_name"),
        F.col("l_quantity").alias("size_storage"),
    )


@query(f"""
WITH {BILLING}, pool AS (
  SELECT strftime(local_time, '%Y-%m-%d') AS day, sum(cost) AS cost, sum(cost + disc) AS after FROM c
  WHERE is_storage GROUP BY 1
), s AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, s_name AS tenant, l_linestatus AS real_name, sum(l_quantity) AS size
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3
), t AS (SELECT day, sum(size) AS total FROM s GROUP BY 1)
SELECT s.day, tenant, real_name, size AS size_storage, (size / total * 100) AS size_storage_percentage,
       (size / total * cost) AS storage_cost_assigned,
       (size / total * after) AS storage_cost_assigned_after_discounts
FROM s JOIN t ON s.day = t.day LEFT JOIN pool ON s.day = pool.day
""")
def alloc_bytes(spark: SparkSession, sf: str) -> DataFrame:
    flat = billing.only_storage(billing.flatten_billing(billing_lines(spark, sf)), mark=STORAGE)
    costs = billing.split_compute_storage(billing.split_credits(flat), mark=STORAGE)
    return allocate.allocate_by_bytes(stored_bytes(spark, sf), costs)


CLOCK_CHANGES = ("1996-04-07", "1996-10-27")  # a day of 23 hours and one of 25


@query(f"""
WITH {BILLING}, h AS (
  SELECT usage_start_time + to_hours(CAST(usage_amount AS INTEGER)) AS t, cost, disc FROM c WHERE is_storage
), pool AS (
  SELECT strftime(timezone('America/Los_Angeles', timezone('UTC', t)), '%Y-%m-%d') AS day, count(*) AS lines, sum(cost) AS cost, sum(cost + disc) AS after
  FROM h GROUP BY 1
), s AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, s_name AS tenant, l_linestatus AS real_name, sum(l_quantity) AS size
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3
), t AS (SELECT day, sum(size) AS total FROM s GROUP BY 1)
SELECT s.day, tenant, real_name, size AS size_storage, (size / total * 100) AS size_storage_percentage,
       (size / total * cost) AS storage_cost_assigned, (size / total * after) AS storage_cost_assigned_after_discounts
FROM s JOIN t ON s.day = t.day LEFT JOIN pool ON s.day = pool.day WHERE s.day IN {CLOCK_CHANGES}
""")
def alloc_bytes_clock_change(spark: SparkSession, sf: str) -> DataFrame:
    """Local days on which the clocks change, each from the days around it alone."""
    flat = billing.only_storage(billing.flatten_billing(billing_lines(spark, sf)), mark=STORAGE)
    costs = billing.split_compute_storage(billing.split_credits(flat), mark=STORAGE)
    hours = F.make_dt_interval(hours=F.col("usage_amount").cast("int"))
    costs = costs.withColumn("usage_start_time", F.col("usage_start_time") + hours)
    first, second = (allocate.allocate_by_bytes(stored_bytes(spark, sf), costs, day=day) for day in CLOCK_CHANGES)
    return first.unionByName(second)


@query(f"""
WITH {BILLING}, pool AS (
  SELECT strftime(usage_start_time, '%Y-%m') AS day, service_description AS sub, 'component ' || service_description AS component,
         sum(CASE WHEN NOT is_storage THEN cost ELSE 0 END + CASE WHEN NOT is_storage THEN a1 + a2 ELSE 0 END) AS compute,
         sum(CASE WHEN is_storage THEN cost ELSE 0 END + CASE WHEN is_storage THEN a1 + a2 ELSE 0 END) AS storage,
         sum(cost) AS cost, sum(cost + a1 + a2) AS after
  FROM c GROUP BY 1, 2, 3
), s AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS day, p_type AS sub, p_brand AS shard_id, n_name AS tenant, sum(l_quantity) AS size
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2, 3, 4
), t AS (SELECT day, sub, sum(size) AS total FROM s GROUP BY 1, 2)
SELECT coalesce(s.day, pool.day) AS day, coalesce(s.sub, pool.sub) AS sub_component, shard_id,
       CASE WHEN component = 'component PROMO' THEN 'internal' ELSE tenant END AS tenant, size AS size_on_disk, component,
       after AS total_after_discounts,
       (CASE WHEN component = 'component PROMO' THEN 1 ELSE size / total END * compute) AS compute_cost_after_discount,
       (CASE WHEN component = 'component PROMO' THEN 1 ELSE size / total END * storage) AS storage_cost_after_discount,
       (CASE WHEN component = 'component PROMO' THEN 1 ELSE size / total END * after) AS total_allocated_cost_after_discount,
       (CASE WHEN component = 'component PROMO' THEN 1 ELSE size / total END * cost) AS total_allocated_cost
FROM (SELECT s.*, total FROM s JOIN t ON s.day = t.day AND s.sub = t.sub) s
     FULL JOIN pool ON s.day = pool.day AND s.sub = pool.sub AND component <> 'component PROMO'
""")
def alloc_component(spark: SparkSession, sf: str) -> DataFrame:
    line, part = read(spark, sf, "lineitem"), read(spark, sf, "part")
    supplier, nation = read(spark, sf, "supplier"), read(spark, sf, "nation")
    stored = line.join(part, line.l_partkey == part.p_partkey, "left").join(supplier, line.l_suppkey == supplier.s_suppkey, "left")
    sizes = stored.join(nation, supplier.s_nationkey == nation.n_nationkey, "left").select(
        month_text("l_shipdate").alias("day"), F.col("p_type").alias("sub_component"), F.col("p_brand").alias("shard_id"),
        F.col("n_name").alias("tenant"), F.col("l_quantity").alias("size_on_disk"),
    )
    flat = billing.split_credits(billing.flatten_billing(billing_lines(spark, sf)), "all")
    parts = billing.split_compute_storage(flat, mark=STORAGE).withColumns({
        "day": month_text("usage_start_time"), "sub_component": F.col("service_description"),
        "component": F.concat(F.lit("component "), "service_description"), "credits": F.col("credits_discounts"),
    })
    parts = parts.fillna(0, subset=["compute_cost", "storage_cost", "compute_discount", "storage_discount"])
    return allocate.allocate_by_component(sizes, parts, F.col("component") == "component PROMO")


@query("""
WITH r AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour, event_type AS host, user_id,
         sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS length_sum, avg(round(value * 100)) AS latency_mean, count(*) AS call_count
  FROM events WHERE event_type <> 'purchase' GROUP BY ALL
), h AS (
  SELECT date, hour, sum(length_sum) AS length_h, sum(call_count) AS calls_h FROM r GROUP BY 1, 2
), p AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour, sum(round(value * 100)) AS cost_h
  FROM events WHERE event_type = 'purchase' GROUP BY 1, 2
)
SELECT r.date, r.hour, host, user_id, length_sum, call_count, latency_mean AS latency_mean,
       cost_h AS cost_h, length_h::BIGINT AS length_sum_h, calls_h::BIGINT AS call_count_h,
       CASE WHEN length_h <> 0 THEN length_sum / length_h END AS average_length,
       (CASE WHEN length_h <> 0 THEN length_sum / length_h END * cost_h) AS cost_assigned_length,
       (call_count / calls_h * cost_h) AS cost_assigned_call_count
FROM r JOIN h ON r.date = h.date AND r.hour = h.hour LEFT JOIN p ON r.date = p.date AND r.hour = p.hour
""")
def alloc_requests(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").withColumns({"date": day_text("ts"), "hour": hour_text("ts"), "length": k(), "cents": units("value", 100)})
    hourly = events.where(F.col("event_type") != "purchase").groupBy(
        "date", "hour", F.col("event_type").alias("host"), "user_id"
    ).agg(
        F.sum("length").alias("length_sum"), F.avg("cents").alias("latency_mean"), F.count(F.lit(1)).alias("call_count")
    )
    pool = sum_by(events.where(F.col("event_type") == "purchase"), ["date", "hour"], {"cost_h": "cents"})
    out = allocate.allocate_by_requests(hourly, pool)
    return out.drop("latency_mean_h")  # a mean of means: its last digit depends on the order of rows


@query(f"""
WITH {USAGE}, {PURCHASES}, u AS (
  SELECT datetime_h, event_type, sum(event_count)::BIGINT AS event_count_h,
         timezone('America/Los_Angeles', timezone('UTC', datetime_h)) AS datetime_h_local
  FROM usage WHERE strftime(timezone('America/Los_Angeles', timezone('UTC', datetime_h)), '%Y-%m') = '2024-01' GROUP BY 1, 2
), p AS (
  SELECT sum(cost) AS cost, sum(after) AS after FROM pool
  WHERE strftime(timezone('America/Los_Angeles', timezone('UTC', datetime_h)), '%Y-%m') = '2024-01'
), n AS (SELECT sum(event_count_h) AS n FROM u)
SELECT datetime_h, event_type, event_count_h, datetime_h_local, (event_count_h * (p.cost / n)) AS cost_assigned,
       (event_count_h * (p.after / n)) AS cost_assigned_after_discount
FROM u, p, n
""")
def alloc_monthly_flat(spark: SparkSession, sf: str) -> DataFrame:
    out = allocate.allocate_monthly_flat(
        usage_counts(spark, sf), purchases(spark, sf), "2024-01", ["event_type"], cost_time="datetime_h"
    )
    return out.withColumn("datetime_h", plain("datetime_h"))


EVEN = ("total_cost", "total_discount", "total_after_discounts")


@query(f"""
WITH {BILLING}, t AS (
  SELECT DISTINCT c_mktsegment AS tenant FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY')
), m AS (
  SELECT strftime(local_time, '%Y-%m') AS month, sum(cost) AS cost, sum(disc_exact) AS disc, sum(cost + disc_exact) AS after
  FROM c GROUP BY 1
)
SELECT month, tenant, (cost / (SELECT count(*) FROM t)) AS total_cost_by_tenant,
       (disc / (SELECT count(*) FROM t)) AS total_discount_by_tenant,
       (after / (SELECT count(*) FROM t)) AS total_after_discounts_by_tenant
FROM m, t
""")
def alloc_even(spark: SparkSession, sf: str) -> DataFrame:
    valid = F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD", "MACHINERY")
    tenants = read(spark, sf, "customer").where(valid).select(F.col("c_mktsegment").alias("tenant"))
    report = local_cost_report(billing_lines(spark, sf))
    return allocate.allocate_evenly(report, tenants, EVEN, month_text("usage_start_time_local"))


@query("""
WITH o AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_custkey AS site, o_orderstatus, o_totalprice,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'VEHICLES' ELSE c_mktsegment END AS tenant
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
), costs AS (
  SELECT day, tenant, sum(CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice * 100) ELSE 0 END) AS compute_cost,
         sum(CASE WHEN o_orderstatus = 'O' THEN round(o_totalprice * 100) ELSE 0 END) AS storage_cost
  FROM o WHERE o_orderstatus <> 'P' GROUP BY 1, 2
), sites AS (
  SELECT day, tenant, count(DISTINCT site) AS deployed_sites FROM o WHERE o_orderstatus <> 'F' AND tenant <> 'FURNITURE' GROUP BY 1, 2
), t AS (SELECT day, sum(deployed_sites)::BIGINT AS total_sites FROM sites GROUP BY 1)
SELECT coalesce(c.day, s.day) AS day, coalesce(c.tenant, s.tenant) AS tenant, compute_cost AS compute_cost,
       storage_cost AS storage_cost, deployed_sites, total_sites, (compute_cost + storage_cost) AS total_cost
FROM costs c FULL JOIN (SELECT sites.*, total_sites FROM sites JOIN t ON sites.day = t.day) s
     ON c.day = s.day AND c.tenant = s.tenant
""")
def cost_per_site(spark: SparkSession, sf: str) -> DataFrame:
    orders, customers = read(spark, sf, "orders"), read(spark, sf, "customer")
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey, "left").select(
        day_text("o_orderdate").alias("day"), F.col("c_mktsegment").alias("tenant"), F.col("o_custkey").alias("site"),
        F.when(F.col("o_orderstatus") == "F", units("o_totalprice", 100)).alias("compute_cost"),
        F.when(F.col("o_orderstatus") == "O", units("o_totalprice", 100)).alias("storage_cost"), "o_orderstatus",
    )
    vehicles = {"VEHICLES": ["AUTOMOBILE", "MACHINERY"]}
    return allocate.cost_per_site(
        rows.where(F.col("o_orderstatus") != "P"), rows.where(F.col("o_orderstatus") != "F"), vehicles, vehicles,
        excluded=["FURNITURE"],
    )


# -- sums ------------------------------------------------------------------------------------------------------------

@query(f"""
WITH {BILLING}
SELECT strftime(usage_start_time, '%Y-%m-%d') AS date, strftime(usage_start_time, '%H') AS hour,
       sum(CASE WHEN usage_unit = 'bytes' THEN usage_amount ELSE 0 END) AS bytes_h,
       sum(CASE WHEN usage_unit = 'requests' THEN usage_amount ELSE 0 END) AS requests_h,
       sum(CASE WHEN usage_unit = 'seconds' THEN usage_amount ELSE 0 END) AS seconds_h,
       sum(CASE WHEN usage_unit = 'byte-seconds' THEN usage_amount ELSE 0 END) AS bytes_seconds_h
FROM c WHERE NOT is_storage GROUP BY 1, 2
""")
def unit_sums(spark: SparkSession, sf: str) -> DataFrame:
    flat = billing.only_compute(billing.flatten_billing(billing_lines(spark, sf)), mark=STORAGE)
    keyed = flat.withColumns({"date": day_text("usage_start_time"), "hour": hour_text("usage_start_time")})
    return sum_by_unit(keyed, ["date", "hour"], "usage_unit", "usage_amount", UNIT_SUMS)


@query("""
SELECT p_brand, sum(p_partkey)::BIGINT AS p_partkey, sum(p_size)::BIGINT AS p_size, sum(round(p_retailprice * 100)) AS p_retailprice
FROM part GROUP BY 1
""")
def sum_every_number(spark: SparkSession, sf: str) -> DataFrame:
    return sum_all(read(spark, sf, "part").withColumn("p_retailprice", units("p_retailprice", 100)), ["p_brand"])


@query("""
SELECT sum(round(l_extendedprice * 100)) AS cost, sum(l_quantity) AS amount, count(*) AS lines FROM lineitem
""")
def global_totals(spark: SparkSession, sf: str) -> DataFrame:
    return totals(read(spark, sf, "lineitem"), {"cost": units("l_extendedprice", 100), "amount": "l_quantity", "lines": F.lit(1)})


@query("""
WITH s AS (SELECT c_mktsegment, c_nationkey, sum(round(c_acctbal * 100)) AS balance FROM customer GROUP BY 1, 2),
t AS (SELECT c_mktsegment, sum(balance) AS total FROM s GROUP BY 1)
SELECT s.c_mktsegment, c_nationkey, balance AS balance, total AS total, (balance / total * 100) AS share
FROM s JOIN t ON s.c_mktsegment = t.c_mktsegment
""")
def shares(spark: SparkSession, sf: str) -> DataFrame:
    balances = sum_by(read(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"], {"balance": units("c_acctbal", 100)})
    return share_of_total(balances, ["c_mktsegment"], "balance", "total", "share")


@query(f"""
WITH {BILLING}, h AS (
  SELECT local_time AS usage_start_time_local, sum(CASE WHEN NOT is_storage THEN cost + disc_exact ELSE 0 END) AS compute_after,
         sum(cost + disc_exact) AS after
  FROM c GROUP BY 1
)
SELECT usage_start_time_local, after AS total_after_discounts,
       (compute_after - 3750.0::DOUBLE / (SELECT count(compute_after) FROM h) - after * 0.05::DOUBLE) AS total_compute_after_adjustment
FROM h
""")
def adjusted_month(spark: SparkSession, sf: str) -> DataFrame:
    adjusted = adjusted_report(local_cost_report(billing_lines(spark, sf), mark=STORAGE))
    return adjusted.select("usage_start_time_local", "total_after_discounts", "total_compute_after_adjustment")
