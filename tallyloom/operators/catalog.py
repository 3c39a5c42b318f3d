"""Site catalogue, item counts and event enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import hour_of, parse_time
from tallyloom.operators.aggregate import distinct_counts
from tallyloom.operators.joins import lookup
from tallyloom.operators.shape import prefix_columns

# Dispositions that take an item out of the count.
EXCLUDED_DISPOSITIONS = (
    "urn:epcglobal:cbv:disp:blacklisted",
    "urn:econnectware:epcis:disp:blacklisted",
    "urn:epcglobal:cbv:disp:destroyed",
    "urn:epcglobal:cbv:disp:dispensed",
    "urn:epcglobal:cbv:disp:disposed",
    "urn:epcglobal:cbv:disp:in_transit",
    "urn:epcglobal:cbv:disp:missing",
    "urn:epcglobal:cbv:disp:retail_sold",
    "urn:epcglobal:cbv:disp:stolen",
)


def site_catalogue(fixtures: DataFrame, zones: DataFrame, premises: DataFrame) -> DataFrame:
    """Fixtures with their zone (tenant, locationCode = code) and premise (tenant, premise = code)."""
    zone = prefix_columns(zones, "zone_", "tenant").withColumnRenamed("zone_code", "locationCode")
    premise = prefix_columns(premises, "premise_", "tenant").withColumnRenamed("premise_code", "premise")
    return lookup(lookup(fixtures, zone, ["tenant", "locationCode"]), premise, ["tenant", "premise"])


def zone_catalogue(zones: DataFrame, premises: DataFrame) -> DataFrame:
    """Zones with the premise their hierarchy names."""
    premise = prefix_columns(premises, "premise_", "tenant").withColumnRenamed("premise_code", "premise")
    flat = zones.withColumn("premise", F.col("hierarchy.premiseId")).drop("hierarchy")
    return lookup(flat, premise, ["tenant", "premise"])


def premise_of_location(
    events: DataFrame, sites: DataFrame, site_column: str, event_column: str, code: str, out: str, tenant: str = "tenantCode"
) -> DataFrame:
    """Premise of an event by (tenant, location) or by (tenant, fixture), from the distinct pairs of a site catalogue.

    ``site_column`` is the catalogue's location or fixture and ``code`` its premise; ``event_column`` is compared to it.
    """
    pairs = sites.select(
        F.col("tenant").alias(tenant), F.col(site_column).alias(event_column), F.col(code).alias(out)
    ).dropDuplicates()
    return lookup(events, pairs, [tenant, event_column])


def item_counts(
    items: DataFrame,
    keys: Sequence[str] = ("tenant", "premise", "disposition", "bizStep", "action"),
    excluded: Sequence[str] = EXCLUDED_DISPOSITIONS,
) -> DataFrame:
    """Distinct products, SKUs and tags, and items, per place and state, leaving out excluded dispositions.

    An item without a disposition is in no state, so it is left out as well.
    """
    kept = items.where(~F.col("disposition").isin(list(excluded)))
    return distinct_counts(
        kept, keys, {"distinct_gtin": "gtin", "distinct_sku": "sku", "distinct_hexa": "hexa"}, "item_count"
    )


def enrich_events(
    events: DataFrame,
    sites: DataFrame,
    products: DataFrame,
    weather: DataFrame | None = None,
    site_key: str = "premise",
    product_key: str = "gtin",
    time: str = "time",
) -> DataFrame:
    """Events with their site, product and the weather of their hour; every event is kept once per match."""
    out = lookup(events, sites.withColumnRenamed("code", site_key), site_key)
    out = lookup(out, products.withColumnRenamed("gtin", product_key), product_key)
    if weather is None:
        return out
    hourly = weather.select(
        hour_of(parse_time("hour")).alias("datehour"), F.col("code").alias(site_key), "temperature"
    )
    return lookup(out.withColumn("datehour", hour_of(time)), hourly, ["datehour", site_key])
