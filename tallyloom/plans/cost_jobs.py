"""Cost allocation jobs: billing lines in, allocated cost out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.columns import LOCAL_ZONE, day_text, hour_text, local_time, month_text, net_of
from tallyloom.operators import allocate, billing
from tallyloom.operators.aggregate import sum_by

from tallyloom.functions.cases import case_first, case_last, contains_rules
from tallyloom.plans import fixed_values as fixed
from tallyloom.sinks.tables import conform


def compute_costs(lines: DataFrame, policy: str = "like", mark: str = billing.STORAGE_MARK) -> DataFrame:
    """Compute lines as (datetime_h, cost, cost_after_discount)."""
    flat = billing.only_compute(billing.flatten_billing(lines), mark=mark)
    parts = billing.split_compute_storage(billing.split_credits(flat, policy), mark=mark)
    return parts.select(
        F.col("usage_start_time").alias("datetime_h"), F.col("compute_cost").alias("cost"),
        F.col("compute_after_discount").alias("cost_after_discount"),
    )


def storage_costs(lines: DataFrame, policy: str = "like", mark: str = billing.STORAGE_MARK) -> DataFrame:
    flat = billing.only_storage(billing.flatten_billing(lines), mark=mark)
    return billing.split_compute_storage(billing.split_credits(flat, policy), mark=mark)


def compute_allocation(counts: DataFrame, lines: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Compute cost over the classified events of the same hour."""
    return allocate.allocate_by_hourly_rate(counts, compute_costs(lines), zone=zone)


def storage_allocation(sizes: DataFrame, lines: DataFrame, environment: str, day: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """Storage cost of a local day over the collections stored on it."""
    shared = allocate.allocate_by_bytes(sizes, storage_costs(lines), day=day, zone=zone)
    return shared.withColumn("environment", F.lit(environment))


def component_allocation(
    sizes: DataFrame, lines: DataFrame, environment: str, day: str, family: str = "Mongo", zone: str = LOCAL_ZONE,
    mark: str = billing.STORAGE_MARK,
) -> DataFrame:
    """Database cost per shard over the databases of the shard; shared components go to ``internal``."""
    flat = billing.flatten_billing(lines, resource=True)
    mapped = billing.map_component(
        flat, fixed.COMPONENT_CONTAINS, (("cloudsql", "Cloud SQL"),), mode="last", default=None
    )
    mapped = mapped.where(F.col("component").contains(family))
    sub = case_last(contains_rules(F.col("resource_name"), fixed.SUBCOMPONENT_CONTAINS))
    parts = billing.split_compute_storage(billing.split_credits(mapped, "all"), mark=mark).withColumns({
        "sub_component": sub,
        "day": day_text(local_time("usage_start_time", zone)),
        "credits": F.col("credits_discounts"),
    }).where((F.col("day") == day) & F.col("sub_component").isNotNull())
    parts = parts.fillna(0, subset=["compute_cost", "storage_cost", "compute_discount", "storage_discount"])
    owned = sizes.select(
        day_text("date").alias("day"),
        case_last(contains_rules(F.col("shard_id"), fixed.SHARD_CONTAINS)).alias("sub_component"),
        "shard_id", "tenant", F.lit(environment).alias("environment"), "size_on_disk",
    ).where((F.col("day") == day) & F.col("sub_component").isNotNull())
    whole = case_first([(F.col("component").contains(w), True) for w in fixed.WHOLE_COMPONENTS], False)
    return allocate.allocate_by_component(owned, parts, whole)


def component_costs(
    lines: DataFrame, environment: str, verbatim: Sequence[str] = (), zone: str = LOCAL_ZONE, mark: str = billing.STORAGE_MARK
) -> DataFrame:
    """Every billing line with its component and sub-component; resources like ``verbatim`` are their own sub-component."""
    detailed = billing.detailed_costs(
        lines, fixed.COMPONENT_BY_NAME, fixed.COMPONENT_BY_GLOBAL_NAME, fixed.SUBCOMPONENT_BY_NAME, verbatim, zone, mark)
    return detailed.withColumn("environment", F.lit(environment))


def project_costs(
    lines: DataFrame, projects: DataFrame, project_of_service: Mapping[str, str] | None = None, zone: str = LOCAL_ZONE,
    mark: str = billing.STORAGE_MARK,
) -> DataFrame:
    """The project summary in its declared columns."""
    return conform(billing.project_cost_summary(lines, projects, project_of_service, zone, mark), schemas.PROJECT_COSTS)


def hourly_pool(lines: DataFrame, mark: str = billing.STORAGE_MARK) -> DataFrame:
    """Compute cost per UTC hour with the used units summed by kind."""
    flat = billing.only_compute(billing.flatten_billing(lines), mark=mark)
    keyed = flat.select(
        day_text("usage_start_time").alias("date"), hour_text("usage_start_time").alias("hour"),
        "cost", "usage_unit", "usage_amount",
    )
    units = {n: F.when(F.col("usage_unit") == u, F.col("usage_amount")) for n, u in fixed.UNIT_SUMS.items()}
    return sum_by(keyed, ["date", "hour"], {"cost_h": "cost", **units}, empty=0.0)


def request_allocation(hourly_requests: DataFrame, lines: DataFrame, month: str) -> DataFrame:
    """Hourly pool over the endpoint statistics of a month."""
    return allocate.allocate_by_requests(
        hourly_requests.where(F.col("date").startswith(month)), hourly_pool(lines)
    )


def monthly_allocation(
    counts: DataFrame, lines: DataFrame, month: str, environment: str, keys: Sequence[str] = ("tenantCode", "thingType"),
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Compute cost of a local month over its events at one rate, promotions kept out of the discounts."""
    shared = allocate.allocate_monthly_flat(
        counts, compute_costs(lines, "exact"), month, list(keys), cost_time="datetime_h", zone=zone
    )
    return shared.withColumn("environment", F.lit(environment))


REPORT_MEASURES = {
    "total_cost": "cost",
    "total_compute_cost": "compute_cost",
    "total_storage_cost": "storage_cost",
    "total_discount": "credits_discounts",
    "total_compute_discount": "compute_discount",
    "total_storage_discount": "storage_discount",
    "total_after_discounts": "total_after_discounts",
    "total_compute_after_discount": "compute_after_discount",
}


def local_cost_report(
    lines: DataFrame, month: str | None = None, zone: str = LOCAL_ZONE, mark: str = billing.STORAGE_MARK
) -> DataFrame:
    """The cost measures per local hour, promotions kept out of the discounts; 0 where an hour has none."""
    parts = billing.split_compute_storage(billing.split_credits(billing.flatten_billing(lines), "exact"), mark=mark)
    local = parts.withColumn("usage_start_time_local", local_time("usage_start_time", zone))
    if month:
        local = local.where(month_text("usage_start_time_local") == month)
    return sum_by(local, ["usage_start_time_local"], REPORT_MEASURES, empty=0.0)


def adjusted_report(
    report: DataFrame, flat: float = fixed.MONTHLY_FLAT_CREDIT, rate: float = fixed.MONTHLY_RATE
) -> DataFrame:
    """The monthly report less its part of the yearly credit and a percentage of the discounted total."""
    hours = report.agg(F.count("total_compute_after_discount")).scalar()
    return report.withColumn("total_compute_after_adjustment", net_of(
        "total_compute_after_discount", "total_after_discounts", flat, hours, rate
    ))


def even_allocation(
    lines: DataFrame, sites: DataFrame, valid: Sequence[str], environment: str, month: str, zone: str = LOCAL_ZONE
) -> DataFrame:
    """The cost of a shared environment in equal parts to its valid tenants."""
    tenants = sites.where(F.col("tenant_parent_code").isin(list(valid))).select("tenant_parent_code")
    report = local_cost_report(lines, month, zone)
    parts = allocate.allocate_evenly(
        report, tenants, [m for m in REPORT_MEASURES if m != "total_storage_cost"],
        month_text("usage_start_time_local"), tenant="tenant_parent_code",
    )
    return parts.withColumn("environment", F.lit(environment))
