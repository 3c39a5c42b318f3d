"""Event widening, classification and hourly counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.cases import all_hold, case_first
from tallyloom.functions.columns import LOCAL_ZONE, hour_of, local_time, segment
from tallyloom.operators.aggregate import count_by, pivot_first
from tallyloom.operators.joins import NULL_KEY, full_outer, lookup, spread_nulls
from tallyloom.operators.shape import MISSING, ensure_columns, fill_text, union_by_name

IDENT = "id_serial_number"


def identity(ident: str, serial: str = "serialNumber") -> Column:
    """``id-serial``; null as soon as one part is null."""
    return F.concat(F.col(ident).cast("string"), F.lit("-"), F.col(serial).cast("string"))


def widen_events(
    headers: DataFrame,
    attributes: DataFrame,
    keys: Sequence[str],
    header_id: str = "id",
    attribute_id: str = "metadataId",
    serial: str = "serialNumber",
    key: str = "key",
    value: str = "value",
) -> DataFrame:
    """Event headers and key/value attributes to wide rows, both sides kept; missing texts become the sentinel.

    The pivot already groups by the join key, so its side reaches the join without another shuffle.
    """
    left = headers.withColumn(IDENT, identity(header_id, serial))
    pairs = attributes.select(identity(attribute_id, serial).alias(IDENT), key, value)
    # Filled after the join alone: a filled identity would be a new column to Spark, which it would shuffle by anew.
    return fill_text(full_outer(left, pivot_first(pairs, IDENT, key, value, keys), IDENT))


def headers_by_identity(headers: DataFrame, header_id: str = "id", serial: str = "serialNumber") -> DataFrame:
    """Headers as they are stored in buckets by identity; headers without one are spread over values that match nothing."""
    spread = spread_nulls(IDENT, *headers.columns)
    return headers.withColumn(IDENT, identity(header_id, serial)).withColumn(IDENT, spread)


def attributes_by_identity(
    attributes: DataFrame, attribute_id: str = "metadataId", serial: str = "serialNumber", key: str = "key", value: str = "value",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Attributes as they are stored in buckets by identity: one row per identity and key, the smallest value of each.

    That is the value the pivot takes, and it leaves an identity no more rows than there are keys.
    """
    pairs = attributes.select(identity(attribute_id, serial).alias(IDENT), F.col(key).alias("key"), F.col(value).alias("value"), *carry)
    return pairs.groupBy(IDENT, "key", *carry).agg(F.min("value").alias("value"))


def widen_stored(headers: DataFrame, attributes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``widen_events`` over both tables as they lie in buckets by identity: neither the pivot nor the join moves a row."""
    both = headers.join(pivot_first(attributes, IDENT, "key", "value", keys), IDENT, "full_outer")
    return fill_text(both.withColumn(IDENT, F.when(~F.startswith(F.col(IDENT), F.lit(NULL_KEY)), F.col(IDENT))))


def bridge_family(bridge: Column | str) -> Column:
    """``/SERVICES`` gives its first path segment, any other bridge its second."""
    bridge = F.col(bridge) if isinstance(bridge, str) else bridge
    return case_first([(bridge == "/SERVICES", segment(bridge, "/", 1)), (bridge != "/SERVICES", segment(bridge, "/", 2))])


class Route(NamedTuple):
    """``take`` is the answer for events on which every entry of ``when`` holds."""

    when: Mapping[str, Any]
    take: Column | str


def route(events: DataFrame, out: str, routes: Sequence[Route], default: str = MISSING) -> DataFrame:
    """First matching route decides; a text answer is a literal, a Column is evaluated on the event."""
    return events.withColumn(out, case_first([(all_hold(r.when), r.take) for r in routes], default))


def route_together(
    events: DataFrame, outs: Sequence[str], table: Sequence[tuple], default: str = MISSING
) -> DataFrame:
    """Several answers from one list of conditions: rows of (condition, answer per column of ``outs``).

    The conditions are tested once, for the number of the row that holds; the answers are picked by that number.
    """
    number = case_first([(all_hold(when), i) for i, (when, *_) in enumerate(table)])
    picked = {
        out: case_first([(F.col("_route") == i, row[n + 1]) for i, row in enumerate(table)], default)
        for n, out in enumerate(outs)
    }
    return events.withColumn("_route", number).withColumns(picked).drop("_route")


def content_site(
    events: DataFrame,
    reference: DataFrame,
    content_type: str = "CONTENT",
    unlinked: str = "unlink",
    dedupe: bool = False,
    out: str = "premise_from_biz",
) -> DataFrame:
    """Site code of content events from the reference list their serial belongs to.

    An unlinked event names the list in the fourth part of its own serial, any other in ``referenceListSerial``. A list
    that occurs with several tenants or values multiplies its events unless ``dedupe``.
    """
    is_content = F.col("thingType") == content_type
    serial = case_first([
        (is_content & (F.col("transactionId") == unlinked), segment("serialNumber", "-", 3)),
        (is_content & (F.col("transactionId") != unlinked), F.col("referenceListSerial")),
    ])
    lists = reference.select("serialNumber", "tenantCode", "value", "rflSiteCode").distinct()
    if dedupe:
        lists = lists.groupBy("serialNumber").agg(F.min("value").alias("value"), F.min("rflSiteCode").alias("rflSiteCode"))
    lists = lists.select(
        F.col("serialNumber").alias("_list"), F.col("value").alias("bizLocation_rfl"), F.col("rflSiteCode").alias(out)
    )
    # Most events are not content and have no list: spread them instead of sending them to one task.
    keyed = events.withColumn("referenceListSerial1", serial)
    keyed = keyed.withColumn("_list", spread_nulls("referenceListSerial1", "serialNumber", IDENT))
    return lookup(keyed, lists, "_list").drop("_list")


def hourly_event_counts(
    events: DataFrame,
    time: str,
    dims: Sequence[str],
    local_zone: str | None = None,
    hour: str = "datetime_h",
    name: str = "event_count",
) -> DataFrame:
    """Events per UTC hour and dimensions, optionally with the local twin of the hour."""
    out = count_by(events.withColumn(hour, hour_of(time)), [hour, *dims], name)
    # One conversion per group instead of one per event.
    return out.withColumn(f"{hour}_local", local_time(hour, local_zone)) if local_zone else out


def hourly_event_counts_local(events: DataFrame, time: str, dims: Sequence[str], zone: str = LOCAL_ZONE) -> DataFrame:
    return hourly_event_counts(events, time, dims, zone)


def add_preaggregated(counts: DataFrame, preaggregated: DataFrame, name: str = "event_count") -> DataFrame:
    """Append a stream that arrives already counted; its count column may still be called ``count``."""
    return union_by_name(preaggregated.withColumnRenamed("count", name), counts)


def count_sets(events: DataFrame, sets: Mapping[str, Sequence[str]], name: str = "event_count") -> DataFrame:
    """Several groupings counted in one pass over the events. ``grouping`` says which one a row belongs to."""
    union = list(dict.fromkeys(c for keys in sets.values() for c in keys))
    names = list(sets)
    out = events.groupingSets([[F.col(c) for c in sets[n]] for n in names], *[F.col(c) for c in union]).agg(
        F.count(F.lit(1)).alias(name), F.grouping_id().alias("_gid")
    )
    # grouping_id has one bit per column, set when the column is not part of the grouping.
    ids = {n: sum(1 << (len(union) - 1 - i) for i, c in enumerate(union) if c not in sets[n]) for n in names}
    tag = case_first([(F.col("_gid") == ids[n], n) for n in names])
    return out.withColumn("grouping", tag).drop("_gid")


def pick_set(counted: DataFrame, sets: Mapping[str, Sequence[str]], grouping: str, name: str = "event_count") -> DataFrame:
    return counted.where(F.col("grouping") == grouping).select(*sets[grouping], name)


def prepare_headers(headers: DataFrame, bridge: str = "bridgeKey") -> DataFrame:
    return headers.withColumn("bridgeKey_2", bridge_family(bridge))


def require_event_columns(events: DataFrame, names: Sequence[str]) -> DataFrame:
    return ensure_columns(events, names)
