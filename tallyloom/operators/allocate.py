"""Sharing a cost pool out over usage. Each allocator hands out the whole pool of every matched group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.cases import all_hold, case_first
from tallyloom.functions.columns import LOCAL_ZONE, day_text, local_time, month_text, per_thousand, ratio, share_pct
from tallyloom.operators.aggregate import distinct_counts, share_of_total, sum_by
from tallyloom.operators.joins import full_outer, skew_join
from tallyloom.operators.shape import fill_zero
from tallyloom.session import settle

COST, AFTER = "cost", "cost_after_discount"


def hourly_rates(
    usage: DataFrame, costs: DataFrame, hour: str = "datetime_h", count: str = "event_count",
    cost: str = COST, after: str = AFTER,
) -> DataFrame:
    """Cost per 1000 events for every hour that has both events and cost."""
    events = sum_by(usage, [hour], {"_events": count})
    pool = sum_by(costs, [hour], {"_cost": cost, "_after": after})
    return events.join(pool, hour, "inner").select(
        hour,
        per_thousand("_cost", "_events").alias("cost_per_1000"),
        per_thousand("_after", "_events").alias("cost_per_1000_after_discount"),
    )


def allocate_by_hourly_rate(
    usage: DataFrame, costs: DataFrame, hour: str = "datetime_h", count: str = "event_count",
    cost: str = COST, after: str = AFTER, zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Each hour's cost over that hour's events. Hours missing on either side drop out; see ``unallocated``."""
    rates = hourly_rates(usage, costs, hour, count, cost, after)
    thousands = F.col(count) / F.lit(1000.0)
    return skew_join(usage, rates, hour).withColumns({
        "allocated_cost": thousands * F.col("cost_per_1000"),
        "allocated_cost_after_discount": thousands * F.col("cost_per_1000_after_discount"),
        f"{hour}_local": local_time(hour, zone),
    })


def unallocated(
    usage: DataFrame, costs: DataFrame, hour: str = "datetime_h", cost: str = COST, after: str = AFTER
) -> DataFrame:
    """Cost of the hours without any event, which the rate join leaves out."""
    pool = sum_by(costs, [hour], {cost: cost, after: after})
    return pool.join(usage.select(hour).distinct(), hour, "left_anti")


def allocate_by_bytes(
    sizes: DataFrame,
    costs: DataFrame,
    keys: Sequence[str] = ("tenant", "real_name"),
    day: str | None = None,
    zone: str = LOCAL_ZONE,
    time: str = "usage_start_time",
    size_time: str = "date",
) -> DataFrame:
    """Storage cost of a local day over the stored bytes of that day.

    With ``day`` (``yyyy-MM-dd``) the billing scan is limited to that day plus one on each side: a local day never
    reaches further in UTC. Sizes carry ``size_storage``, costs ``storage_cost``, ``storage_discount`` and
    ``storage_after_discount``.
    """
    if day:
        start = F.lit(day).cast("date")
        costs = costs.where((F.col(time) >= F.date_sub(start, 1)) & (F.col(time) < F.date_add(start, 2)))
        sizes = sizes.where((F.col(size_time) >= start) & (F.col(size_time) < F.date_add(start, 1)))
    pool = costs.withColumn("day", day_text(local_time(time, zone)))
    if day:
        pool = pool.where(F.col("day") == day)
    pool = sum_by(pool, ["day"], {
        "pool_cost": "storage_cost", "pool_discount": "storage_discount", "pool_after": "storage_after_discount",
    })
    stored = sum_by(sizes.withColumn("day", day_text(size_time)), ["day", *keys], {"size_storage": "size_storage"})
    # Total and pool have a row per day each; brought together first, they cost the stored bytes one move instead of two.
    totals = sum_by(stored, ["day"], {"size_storage_total": "size_storage"})
    part = ratio("size_storage", "size_storage_total")
    return skew_join(stored, totals.join(pool, "day", "left"), "day", "left").select(
        "day", *keys, "size_storage",
        share_pct("size_storage", "size_storage_total").alias("size_storage_percentage"),
        (part * F.col("pool_cost")).alias("storage_cost_assigned"),
        (part * F.col("pool_after")).alias("storage_cost_assigned_after_discounts"),
    )


COMPONENT_MEASURES = (
    "compute_cost", "storage_cost", "compute_discount", "storage_discount", "cost", "credits", "total_after_discounts",
)


def allocate_by_component(
    sizes: DataFrame,
    costs: DataFrame,
    whole: Column,
    keys: Sequence[str] = ("day", "sub_component"),
    tenant: str = "tenant",
    size: str = "size_on_disk",
    internal: str = "internal",
) -> DataFrame:
    """Component cost over the bytes of the same (day, sub-component); both sides keep their unmatched rows.

    Components for which ``whole`` holds are shared by everybody: each is one row of the tenant ``internal``, also where there
    are sizes for its key, so the pool is handed out once.
    """
    keys = list(keys)
    pool = sum_by(costs, [*keys, "component"], {m: m for m in COMPONENT_MEASURES})
    # Undivided components meet no owner, because owners have the other value here.
    pool = pool.withColumn("_divided", ~F.coalesce(whole, F.lit(False)))
    owners = [c for c in sizes.columns if c not in keys and c != size]
    owned = sum_by(sizes, [*keys, *owners], {size: size})
    # Totals join the pool, which has few rows too, so that the owners' rows are moved once.
    pool = pool.join(sum_by(owned, keys, {"_all": size}), keys, "left")
    joined = full_outer(
        owned.withColumn("_divided", F.lit(True)), pool, [*keys, "_divided"], left_keys=sizes.withColumn("_divided", F.lit(True)))
    part = ratio(size, "_all")
    undivided = ~F.col("_divided")

    def hand_out(measure: Column) -> Column:
        return F.when(undivided, measure).otherwise(part * measure)

    return joined.select(
        *keys, *[F.when(undivided, F.lit(internal)).otherwise(F.col(c)).alias(c) if c == tenant else F.col(c) for c in owners],
        size, "component", "total_after_discounts",
        hand_out(F.col("compute_cost") + F.col("compute_discount")).alias("compute_cost_after_discount"),
        hand_out(F.col("storage_cost") + F.col("storage_discount")).alias("storage_cost_after_discount"),
        hand_out(F.col("total_after_discounts")).alias("total_allocated_cost_after_discount"),
        hand_out(F.col("cost")).alias("total_allocated_cost"),
    )


def allocate_by_requests(
    requests: DataFrame, pool: DataFrame, keys: Sequence[str] = ("date", "hour"),
    length: str = "length_sum", latency: str = "latency_mean", calls: str = "call_count", cost: str = "cost_h",
) -> DataFrame:
    """Hourly pool over requests, once by length and once by calls. Latency stays an unweighted mean of means."""
    keys = list(keys)
    hourly = requests.groupBy(*keys).agg(
        F.sum(length).alias(f"{length}_h"), F.avg(latency).alias(f"{latency}_h"), F.sum(calls).alias(f"{calls}_h")
    )
    rated = hourly.join(pool, keys, "left")
    return skew_join(requests, rated, keys, "left").withColumns({
        "cost_assigned_length": ratio(length, f"{length}_h") * F.col(cost),
        "cost_assigned_call_count": ratio(calls, f"{calls}_h") * F.col(cost),
        "average_length": ratio(length, f"{length}_h"),
    })


def allocate_monthly_flat(
    usage: DataFrame, costs: DataFrame, month: str, keys: Sequence[str],
    usage_time: str = "datetime_h", cost_time: str = "usage_start_time", count: str = "event_count",
    cost: str = COST, after: str = AFTER, zone: str = LOCAL_ZONE,
) -> DataFrame:
    """One rate for the whole local month: all cost over all events. Time is read as UTC and judged locally."""
    def in_month(df: DataFrame, time: str) -> DataFrame:
        first = F.lit(f"{month}-01").cast("date")
        near = df.where((F.col(time) >= F.date_sub(first, 1)) & (F.col(time) < F.date_add(F.last_day(first), 2)))
        return near.where(month_text(local_time(time, zone)) == month)

    events = sum_by(in_month(usage, usage_time), [usage_time, *keys], {"event_count_h": count})
    events_total = events.agg(F.sum("event_count_h"))
    spent = in_month(costs, cost_time)
    rate = ratio(spent.agg(F.sum(cost)).scalar(), events_total.scalar())
    rate_after = ratio(spent.agg(F.sum(after)).scalar(), events_total.scalar())
    return events.withColumns({
        "cost_assigned": F.col("event_count_h") * rate,
        "cost_assigned_after_discount": F.col("event_count_h") * rate_after,
        f"{usage_time}_local": local_time(usage_time, zone),
    })


def allocate_evenly(
    costs: DataFrame, tenants: DataFrame, measures: Sequence[str], month_of: Column, tenant: str = "tenant",
) -> DataFrame:
    """Each month's measures in equal parts to every distinct tenant of ``tenants``."""
    valid = tenants.select(tenant).distinct()
    spent = costs.withColumn("month", month_of)
    monthly = settle(sum_by(spent, ["month"], {m: m for m in measures}))  # one row per month, read twice below
    heads = valid.agg(F.count(F.lit(1))).scalar()
    parts = monthly.select("month", *[ratio(m, heads).alias(f"{m}_by_tenant") for m in measures])
    # Every tenant takes part in every month: pair them through the month instead of a product.
    months = monthly.agg(F.collect_set("month")).scalar()
    seats = valid.withColumn("month", F.explode(months))
    return parts.join(seats, "month", "inner")


def cost_per_site(
    costs: DataFrame,
    sites: DataFrame,
    cost_alias: dict[str, Sequence[str]] | None = None,
    site_alias: dict[str, Sequence[str]] | None = None,
    excluded: Sequence[str] = (),
    month: str | None = None,
) -> DataFrame:
    """Daily cost per tenant beside the number of deployed sites of the tenant and of the day.

    ``costs``: day, tenant, compute_cost, storage_cost. ``sites``: day, tenant, site. An alias maps the tenant name to
    report to the names it replaces. Both sides keep their unmatched rows; ``month`` (``yyyy-MM``) keeps the days of
    that month on which there is a cost.
    """
    def named(column: str, alias: dict[str, Sequence[str]] | None) -> Column:
        return case_first([(all_hold({column: list(old)}), new) for new, old in (alias or {}).items()], F.col(column))

    spent = sum_by(
        costs.withColumn("tenant", named("tenant", cost_alias)), ["day", "tenant"],
        {"compute_cost": "compute_cost", "storage_cost": "storage_cost"},
    )
    spent = fill_zero(spent, "compute_cost", "storage_cost").withColumn("_spent", F.col("day"))
    kept = sites.where(~F.col("tenant").isin(list(excluded))) if excluded else sites
    deployed = distinct_counts(
        kept.withColumn("tenant", named("tenant", site_alias)), ["day", "tenant"], {"deployed_sites": "site"}
    )
    deployed = share_of_total(deployed, ["day"], "deployed_sites", "total_sites")
    # One row per (day, tenant) on both sides: no key can be hot here.
    out = spent.join(deployed, ["day", "tenant"], "full_outer")
    out = out.withColumn("total_cost", F.col("compute_cost") + F.col("storage_cost"))
    return (out.where(F.col("_spent").startswith(month)) if month else out).drop("_spent")

