"""The daily event classification: headers and attributes to hourly counts by business taxonomy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import hour_of
from tallyloom.operators.events import (
    add_preaggregated, content_site, count_sets, pick_set, prepare_headers, require_event_columns, route_together,
    widen_events,
)
from tallyloom.operators.rules import classify, classify_by_key
from tallyloom.operators.shape import MISSING, rename
from tallyloom.plans import fixed_values as fixed
from tallyloom.session import settle
from tallyloom.sinks import append_day, must_succeed, write_selected

TAXONOMY = ("FeatureSet", "Process", "SubProcess", "EventSource", "StoreCode", "Is_InternalEvent")
SETS = {
    "events_classification": (
        "datetime_h", "tenantCode", "thingType", "specName", "bridgeKey_2", "source", "sourceModule", "Retail_Bizstep",
        *TAXONOMY,
    ),
    "serialNumber_classification": ("datetime_h", "serialNumber", "tenantCode", "thingType", *TAXONOMY),
}


def classified_events(
    headers: DataFrame,
    attributes: DataFrame,
    reference: DataFrame,
    rules: DataFrame,
    routes: Sequence[tuple[dict, object, object]],
    keys: Sequence[str] = fixed.EVENT_KEYS,
) -> DataFrame:
    """Wide events with FeatureSet, Process, SubProcess, Is_InternalEvent, EventSource and StoreCode."""
    wide = require_event_columns(widen_events(prepare_headers(headers), attributes, keys), fixed.EVENT_KEYS)
    wide = content_site(wide, reference.where(F.col("key") == "bizLocation")).withColumn("premise_from_fixture", F.lit(""))
    named = classify(wide, rules, fixed.RULE_KEYS, fixed.RULE_TARGETS)
    named = route_together(named, ["EventSource", "StoreCode"], routes)
    return named.withColumn("datetime_h", hour_of("time"))


def listed_events(headers: DataFrame, attributes: DataFrame, process_list: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The variant that looks the taxonomy up in a process list instead of evaluating rules."""
    wide = require_event_columns(widen_events(prepare_headers(headers), attributes, keys), ("source",))
    found = classify_by_key(wide, rename(process_list, {"KeyField_L": "KeyField"}), fixed.LIST_KEY_PARTS, "KeyField")
    constants = {c: F.lit(MISSING) for c in ("EventSource", "StoreCode", "Is_InternalEvent")}
    return found.withColumns(constants).withColumn("datetime_h", hour_of("time"))


def write_counts(
    classified: DataFrame, preaggregated: DataFrame, paths: dict[str, str], environment: str, process_date: str,
    output: str = "All",
) -> dict[str, str]:
    """Write the selected counts. Both come from one pass over the events, settled once and read per output.

    Rows go to the partition of the environment and of the day that was processed, not of the event: events whose header
    is missing have no time. So a run replaces what the same run has written before, and nothing else.
    """
    wanted = dict(SETS) if output == "All" else {output: SETS[output]}
    counted = settle(count_sets(classified, wanted))
    frames = {n: pick_set(counted, wanted, n) for n in wanted}
    if "events_classification" in frames:
        frames["events_classification"] = add_preaggregated(frames["events_classification"], preaggregated)
    run = {"environment": F.lit(environment), "process_date": F.lit(process_date).cast("date")}
    return must_succeed(write_selected({
        n: (lambda df=df, n=n: append_day(df.withColumns(run), paths[n], list(run))) for n, df in frames.items()
    }, output))
