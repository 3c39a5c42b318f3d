"""The smaller jobs: traffic, API keys, sandbox counts, site costs, catalogues, enrichment and tickets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.columns import LOCAL_ZONE, day_text
from tallyloom.operators import allocate, catalog, tickets, traffic
from tallyloom.operators.events import hourly_event_counts
from tallyloom.operators.shape import union_by_name
from tallyloom.sources import Table, arrays_to_rows, by_environment, day_slice, flatten_structs

REQUEST_COLUMNS = ("time", "method", "uri", "host", "status", "length", "latency")


def request_reports(
    spark: SparkSession, tables: Mapping[str, Table], environment: str, day: str, failures: bool = True
) -> dict[str, DataFrame]:
    """Endpoint statistics of a day in one environment, and its failing endpoints."""
    requests = by_environment(spark, tables, environment, day_slice("time", day)).select(*REQUEST_COLUMNS)
    out = {"stats": traffic.endpoint_stats(requests)}
    if failures:
        out["failures"] = traffic.failing_endpoints(requests)
    return out


def apikey_report(requests: DataFrame, known: DataFrame, start: Column, end: Column) -> DataFrame:
    """API-key audit of ``start <= time < end``."""
    return traffic.apikey_audit(requests.where((F.col("time") >= start) & (F.col("time") < end)), known)


def sandbox_counts(environments: Mapping[str, DataFrame], day: str, zone: str = LOCAL_ZONE) -> dict[str, DataFrame]:
    """Hourly events per tenant and thing type of a day, each environment from its own headers."""
    dims = ["tenantCode", "thingType"]
    return {
        name: hourly_event_counts(headers.where(day_slice("time", day)), "time", dims, zone)
        for name, headers in environments.items()
    }


def site_costs(
    tenant_costs: DataFrame,
    deployed: DataFrame,
    environment: str,
    month: str,
    cost_alias: Mapping[str, Sequence[str]] | None = None,
    site_alias: Mapping[str, Sequence[str]] | None = None,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """Cost of a month per day and tenant beside the sites deployed on that day."""
    costs = tenant_costs.select(
        day_text("date_LA_2").alias("day"), F.col("tenant_full").alias("tenant"), "compute_cost", "storage_cost"
    )
    first = F.lit(f"{month}-01").cast("date")
    of_month = (F.col("timestamp") >= first) & (F.col("timestamp") < F.add_months(first, 1))
    sites = deployed.where(of_month & (F.col("environment") == environment)).select(
        day_text("timestamp").alias("day"), F.col("tenant_parent_code").alias("tenant"), F.col("id").alias("site")
    )
    return allocate.cost_per_site(costs, sites, cost_alias, site_alias, excluded, month)


def site_catalogues(
    fixtures: Mapping[str, DataFrame], zones: Mapping[str, DataFrame], premises: Mapping[str, DataFrame]
) -> DataFrame:
    """One catalogue of all tenants from the payloads landed per tenant."""

    def together(parts: Mapping[str, DataFrame]) -> DataFrame:
        return union_by_name(*[df.withColumn("tenant", F.lit(tenant)) for tenant, df in parts.items()])

    plain = together(zones)
    if "hierarchy" in plain.columns:
        plain = flatten_structs(plain, "_")
    return catalog.site_catalogue(together(fixtures), plain, together(premises))


def sites_and_items(items: DataFrame, day: str) -> DataFrame:
    """Item counts with the day they were taken on."""
    return catalog.item_counts(items).withColumn("extraction_date", F.lit(day).cast("date"))


def enriched_events(
    events: DataFrame, premises: DataFrame, products: DataFrame, weather_payload: DataFrame | None = None
) -> DataFrame:
    """Events with premise, product and, from the landed payloads, the temperature of their hour."""
    weather = None
    if weather_payload is not None:
        hours = {"hour": "hourly.time", "temperature": "hourly.temperature_2m"}
        weather = arrays_to_rows(weather_payload, hours, "code")
    return catalog.enrich_events(events, premises, products, weather)


def ticket_reports(
    issues: DataFrame, worklogs: DataFrame, time_in_status: DataFrame, keywords: Sequence[tuple[str, str]],
    statuses: Sequence[str], attributes: Sequence[str] = ("ISSUE_TYPE_NAME", "ISSUE_STATUS_NAME", "SUMMARY", "TENANT"),
) -> dict[str, DataFrame]:
    """Ticket facts, hours logged on tickets and hours per status."""
    facts = tickets.ticket_facts(issues, keywords)
    return {
        "tickets": facts,
        "worklogs": tickets.ticket_worklogs(worklogs, facts, attributes),
        "time_in_status": tickets.ticket_time_in_status(time_in_status, statuses),
    }
