"""HTTP ingress statistics and API-key audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.cases import case_first
from tallyloom.functions.columns import day_text, hour_of, hour_text, path_prefix, segment
from tallyloom.operators.aggregate import count_by
from tallyloom.operators.joins import lookup

OK_UP_TO = 404  # fixed value: the highest status that still counts as a success


def endpoint_stats(requests: DataFrame) -> DataFrame:
    """Bytes, mean latency and calls per hour, host, first path segment, status and method."""
    return (
        requests.select(
            day_text("time").alias("date"), hour_text("time").alias("hour"), "host",
            segment("uri", "/", 1).alias("uri_lv1"), "status", "method", "length", "latency",
        )
        .where(_complete("host", "uri_lv1", "status", "method"))
        .groupBy("date", "hour", "host", "uri_lv1", "status", "method")
        .agg(
            F.sum("length").alias("length_sum"),
            F.avg("latency").alias("latency_mean"),
            F.count("date").alias("call_count"),
        )
    )


def _complete(*columns: str) -> Column:
    """Groups with a missing key are not reported."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def outcome(ok_up_to: int = OK_UP_TO) -> Column:
    """SUCCESS up to the bound (a missing page still counts as answered), FAILURE beyond, null without a status."""
    return case_first([(F.col("status") <= ok_up_to, "SUCCESS"), (F.col("status") > ok_up_to, "FAILURE")])


def failing_endpoints(requests: DataFrame, ok_up_to: int = OK_UP_TO, limit: int | None = None) -> DataFrame:
    """Failed calls per day, host, method and first three path segments, most calls first."""
    failed = requests.where(F.col("status") > ok_up_to).select(
        day_text("time").alias("date"), "host", "method", path_prefix("uri", 1, 3).alias("uri_1_to_3"),
        "length", "latency",
    )
    out = (
        failed.where(_complete("host", "method", "uri_1_to_3"))
        .groupBy("date", "host", "method", "uri_1_to_3")
        .agg(
            F.sum("length").alias("length_sum"),
            F.avg("latency").alias("latency_mean"),
            F.count("method").alias("call_count"),
        )
        .orderBy(F.desc("call_count"), "date", "host", "method", "uri_1_to_3")
    )
    return out.limit(limit) if limit else out


AUDIT_DIMS = (
    "datetime_h", "host", "user", "auth", "token", "source", "method", "uri", "status", "apikey", "apikey_label",
)


def label_api_keys(requests: DataFrame, known: DataFrame) -> DataFrame:
    """``empty`` for no key, ``known value`` for a listed one, otherwise ``unknown``."""
    listed = lookup(
        requests.withColumns({"datetime_h": hour_of("time"), "endpoint": path_prefix("uri", 1, 4)}),
        known.select(F.col("apiKey_l").alias("apikey"), "Description"),
        "apikey",
    )
    has_key = F.col("apikey") != ""
    return listed.withColumn("apikey_label", case_first([
        (F.col("apikey") == "", "empty"),
        (has_key & (F.col("Description") == "known value"), "known value"),
    ], "unknown"))


def apikey_audit(requests: DataFrame, known: DataFrame) -> DataFrame:
    """Hourly calls per caller, endpoint and key label."""
    return count_by(label_api_keys(requests, known), AUDIT_DIMS, "call_count")
