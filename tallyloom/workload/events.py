"""Scans, hourly counts, widening, rules."""

from __future__ import annotations

import uuid
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import case_first, case_last, contains_rules, pattern, segment, strip_zeros
from tallyloom.operators.aggregate import row_quality, unmatched_share
from tallyloom.operators.events import (
    IDENT, Route, add_preaggregated, attributes_by_identity, content_site, count_sets, headers_by_identity, hourly_event_counts,
    hourly_event_counts_local, identity, route, widen_events, widen_stored,
)
from tallyloom.operators.rules import classify, classify_by_key, rules_schema
from tallyloom.operators.shape import MISSING, ensure_columns, fill_text
from tallyloom.plans.event_job import SETS as COUNT_SETS
from tallyloom.plans.event_job import classified_events
from tallyloom.plans.fixed_values import RULE_KEYS, event_routes
from tallyloom.session import scratch_path
from tallyloom.sinks import BucketedTable, declare, replace_bucketed
from tallyloom.sources import Table, by_environment, day_slice, load_audit, run_sql
from tallyloom.streaming import classified_stream, counts_so_far, read_landed, write_counts_stream
from tallyloom.workload.registry import query
from tallyloom.workload.standins import SCHEMAS, event_attributes, event_headers, k, plain, read

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
WIDTHS = (2, 3, 5, 4, 6, 6, 11, 6, 5, 3, 3, 2, 3, 4)


@query("""
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'
""")
def scan_day_slice(spark: SparkSession, sf: str) -> DataFrame:
    day = read(spark, sf, "events").where(day_slice("ts", "2024-01-15"))
    return day.select("event_id", "ts", "user_id", "event_type", "value")


@query("""
SELECT event_id, ts, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00' AND hour(ts) BETWEEN 8 AND 17
""")
def scan_hour_slice(spark: SparkSession, sf: str) -> DataFrame:
    hours = read(spark, sf, "events").where(day_slice("ts", "2024-01-10", "2024-01-19", 8, 17))
    return hours.select("event_id", "ts", "event_type")


@query("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS table_rows, {w} AS table_columns, 'ok' AS status"
    for t, w in zip(TABLES, WIDTHS)
), name="load_audit")
def source_audit(spark: SparkSession, sf: str) -> DataFrame:
    return load_audit(spark, {t: (lambda t=t: read(spark, sf, t)) for t in TABLES}).drop("date")


@query("SELECT (SELECT count(*) FROM lineitem) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS distinct_rows")
def row_audit(spark: SparkSession, sf: str) -> DataFrame:
    return row_quality(read(spark, sf, "lineitem"))


@query("""
SELECT date_trunc('hour', ts) AS datetime_h, event_type, count(*) AS event_count FROM events GROUP BY ALL
""")
def hourly_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = hourly_event_counts(read(spark, sf, "events"), "ts", ["event_type"])
    return counts.withColumn("datetime_h", plain("datetime_h"))


@query("""
SELECT date_trunc('hour', ts) AS datetime_h, event_type, count(*) AS event_count,
       timezone('America/Los_Angeles', timezone('UTC', date_trunc('hour', ts))) AS datetime_h_local
FROM events GROUP BY 1, 2
""")
def hourly_counts_local(spark: SparkSession, sf: str) -> DataFrame:
    counts = hourly_event_counts_local(read(spark, sf, "events"), "ts", ["event_type"])
    return counts.withColumn("datetime_h", plain("datetime_h"))


@query("""
SELECT date_trunc('hour', ts) AS datetime_h, user_id, event_type, count(*) AS event_count FROM events GROUP BY ALL
""")
def serial_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = hourly_event_counts(read(spark, sf, "events"), "ts", ["user_id", "event_type"])
    return counts.withColumn("datetime_h", plain("datetime_h"))


@query("""
SELECT date_trunc('hour', ts) AS datetime_h,
       CASE event_type WHEN 'click' THEN 'USED' WHEN 'view' THEN 'USED' WHEN 'purchase' THEN 'SOLD' ELSE 'N/A' END AS feature, count(*) AS event_count
FROM events GROUP BY 1, 2
""")
def hourly_counts_streamed(spark: SparkSession, sf: str) -> DataFrame:
    """Files that land twice, classified by rules on the stream and counted in increments by micro-batch."""
    landed, root, state = (scratch_path(spark, n) for n in ("landed", "increments", "state"))
    events = read(spark, sf, "events")
    for _ in range(2):
        events.repartitionByRange(3, "ts").write.mode("append").parquet(landed)
    rules = spark.createDataFrame(
        [("feature", n, kind, answer) for n, (kind, answer) in enumerate((("click", "USED"), ("view", "USED"), ("purchase", "SOLD")))], rules_schema(["event_type"]))
    stream = classified_stream(
        read_landed(spark, landed, SCHEMAS["events"], 2), rules, ["event_type"], ["feature"], ["event_id"], "ts", lateness="60 days")
    running = write_counts_stream(stream, "ts", ["feature"], root, state)
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()
    return counts_so_far(spark, root, "feature string").withColumn("datetime_h", plain("datetime_h"))


SETS = {"by_type": ["datetime_h", "event_type"], "by_user": ["datetime_h", "user_id"]}


@query("""
WITH h AS (SELECT date_trunc('hour', ts) AS datetime_h, event_type, user_id FROM events)
SELECT datetime_h, event_type, CAST(NULL AS BIGINT) AS user_id, count(*) AS event_count, 'by_type' AS grouping
FROM h GROUP BY 1, 2
UNION ALL
SELECT datetime_h, NULL, user_id, count(*), 'by_user' FROM h GROUP BY 1, 3
""")
def counts_in_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    hours = read(spark, sf, "events").withColumn("datetime_h", plain(F.date_trunc("hour", "ts")))
    return count_sets(hours, SETS)


@query("""
SELECT datetime_h, event_type, sum(n)::BIGINT AS event_count FROM (
  SELECT date_trunc('hour', ts) AS datetime_h, event_type, 1 AS n FROM events
) GROUP BY 1, 2
""")
def counts_union_preagg(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events")
    counted_elsewhere = hourly_event_counts(events.where(F.col("event_type") == "error"), "ts", ["event_type"], name="count")
    fresh = hourly_event_counts(events.where(F.col("event_type") != "error"), "ts", ["event_type"])
    return add_preaggregated(fresh, counted_elsewhere).withColumn("datetime_h", plain("datetime_h"))


WIDE_SQL = """
WITH h AS (
  SELECT event_id || '-' || user_id AS id_serial_number, event_type AS thingType FROM events WHERE event_type <> 'error'
), a AS (
  SELECT event_id || '-' || user_id AS id_serial_number, json_extract_string(props, '$.k') AS k, event_type AS type
  FROM events WHERE event_type <> 'view'
)
SELECT coalesce(h.id_serial_number, a.id_serial_number) AS id_serial_number, coalesce(thingType, 'N/A') AS "thingType",
       coalesce(k, 'N/A') AS k, coalesce(type, 'N/A') AS type
FROM h FULL JOIN a ON h.id_serial_number = a.id_serial_number
"""


@query(WIDE_SQL)
def eav_widen(spark: SparkSession, sf: str) -> DataFrame:
    wide = widen_events(event_headers(spark, sf), event_attributes(spark, sf), ["k", "type"])
    return wide.select("id_serial_number", "thingType", "k", "type")


@query(WIDE_SQL)
def eav_widen_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Headers and attributes are stored by identity, day by day; the pivot and the join then read them in place."""
    run, day = uuid.uuid4().hex, F.to_date("time").alias("day")
    stored = {
        name: BucketedTable(f"{name}_{run}", scratch_path(spark, name), f"{IDENT} string, {columns}, day date", [IDENT], 8, ["day"])
        for name, columns in (("headers", "thingType string"), ("attributes", "key string, value string"))
    }
    headers = headers_by_identity(event_headers(spark, sf).withColumn("day", day))
    attributes = attributes_by_identity(event_attributes(spark, sf).withColumn("day", day), carry=["day"])
    replace_bucketed(headers, stored["headers"])
    replace_bucketed(attributes, stored["attributes"])
    wide = widen_stored(declare(spark, stored["headers"]), declare(spark, stored["attributes"]), ["k", "type"])
    return wide.select(IDENT, "thingType", "k", "type")


@query("SELECT event_id, event_type, 'N/A' AS \"transactionId\", 'N/A' AS \"doorEvent\" FROM events", name="ensure_columns")
def repair_columns(spark: SparkSession, sf: str) -> DataFrame:
    repaired = ensure_columns(read(spark, sf, "events"), ["event_type", "transactionId", "doorEvent"])
    return fill_text(repaired).select("event_id", "event_type", "transactionId", "doorEvent")


# -- rules -----------------------------------------------------------------------------------------------------------

ORDER_KEYS = ("o_orderstatus", "o_orderpriority", "c_mktsegment", "size_band", "balance", "quarter")
ORDER_TARGETS = ("feature", "process", "internal")


def order_rules() -> list[dict]:
    """A made-up taxonomy over six order attributes, with two guards on the region."""
    rules, n = [], 0
    domains = (
        ("F", "O", "P"), ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
        ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"), ("LARGE", "SMALL"), ("CREDIT", "DEBIT"),
        ("1", "2", "3", "4"),
    )
    for values in product(*domains):
        status, priority, market, band, balance, quarter = values
        keys = dict(zip(ORDER_KEYS, values))
        answers = []
        if status == "F":
            answers.append(("feature", "FULFILMENT", {}))
        elif status == "O":
            answers.append(("feature", "EXPEDITE" if priority < "3" else "BACKLOG", {}))
        if market in ("AUTOMOBILE", "MACHINERY") and band == "LARGE":
            answers.append(("process", "HEAVY EUROPE", {"r_name_is": "EUROPE"}))
            answers.append(("process", "HEAVY", {}))
        elif quarter == "4":
            answers.append(("process", "YEAR END", {}))
        if balance == "DEBIT":
            answers.append(("internal", "1", {"r_name_not": "AFRICA"}))
        else:
            answers.append(("internal", "0", {}))
        for target, value, guard in answers:
            n += 1
            guards = {"r_name_is": None, "r_name_not": None, **guard}
            rules.append({"target": target, "priority": n, **keys, **guards, "value": value})
    return rules


def orders_to_classify(spark: SparkSession, sf: str) -> DataFrame:
    orders, customers = read(spark, sf, "orders"), read(spark, sf, "customer")
    nations, regions = read(spark, sf, "nation"), read(spark, sf, "region")
    places = nations.join(regions, nations.n_regionkey == regions.r_regionkey, "left")
    placed = customers.join(places, customers.c_nationkey == places.n_nationkey, "left")
    rows = orders.join(placed, orders.o_custkey == placed.c_custkey, "left")
    return rows.select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "c_mktsegment", "r_name",
        F.when(F.col("o_totalprice") >= 250000, "LARGE").otherwise("SMALL").alias("size_band"),
        F.when(F.col("c_acctbal") < 0, "DEBIT").otherwise("CREDIT").alias("balance"),
        F.quarter("o_orderdate").cast("string").alias("quarter"),
    )


def order_rule_table(spark: SparkSession) -> DataFrame:
    schema = rules_schema(ORDER_KEYS, ("r_name_is", "r_name_not"))
    names = [f.split()[0].strip("`") for f in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in order_rules()], schema)


@query("""
WITH o AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, c_mktsegment, r_name, o_totalprice >= 250000 AS large,
         c_acctbal < 0 AS debit, quarter(o_orderdate) AS quarter
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey
)
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN 'FULFILMENT'
            WHEN o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'EXPEDITE'
            WHEN o_orderstatus = 'O' THEN 'BACKLOG' ELSE 'N/A' END AS feature,
       CASE WHEN large AND c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') AND r_name = 'EUROPE' THEN 'HEAVY EUROPE'
            WHEN large AND c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'HEAVY'
            WHEN quarter = 4 THEN 'YEAR END' ELSE 'N/A' END AS process,
       CASE WHEN NOT debit THEN '0' WHEN r_name <> 'AFRICA' THEN '1' ELSE 'N/A' END AS internal
FROM o
""")
def rule_classify(spark: SparkSession, sf: str) -> DataFrame:
    named = classify(orders_to_classify(spark, sf), order_rule_table(spark), ORDER_KEYS, ORDER_TARGETS)
    return named.select("o_orderkey", *ORDER_TARGETS)


@query("""
WITH o AS (
  SELECT o_orderstatus = 'P' AS feature, quarter(o_orderdate) <> 4 AND
         NOT (o_totalprice >= 250000 AND c_mktsegment IN ('AUTOMOBILE', 'MACHINERY')) AS process,
         c_acctbal < 0 AND r_name = 'AFRICA' AS internal
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey
), u AS (
  SELECT 'feature' AS "column", feature AS missed FROM o UNION ALL SELECT 'process', process FROM o
  UNION ALL SELECT 'internal', internal FROM o
)
SELECT "column", count(*) AS rows, count(*) FILTER (missed) AS unmatched, count(*) FILTER (missed) / count(*) * 100 AS share
FROM u GROUP BY 1
""")
def rule_coverage(spark: SparkSession, sf: str) -> DataFrame:
    named = classify(orders_to_classify(spark, sf), order_rule_table(spark), ORDER_KEYS, ORDER_TARGETS)
    return unmatched_share(named, ORDER_TARGETS, MISSING)


NAME_RULES = (("bolt", "FASTENER"), ("r", "R-GROUP"), ("ring", "SEAL"), ("blue", "BLUE LINE"), ("gear", "DRIVE"))


@query("""
SELECT p_partkey, CASE WHEN contains(p_name, 'bolt') THEN 'FASTENER' WHEN contains(p_name, 'r') THEN 'R-GROUP'
  WHEN contains(p_name, 'ring') THEN 'SEAL' WHEN contains(p_name, 'blue') THEN 'BLUE LINE'
  WHEN contains(p_name, 'gear') THEN 'DRIVE' ELSE 'N/A' END AS tag FROM part
""")
def rule_first_match(spark: SparkSession, sf: str) -> DataFrame:
    rules = contains_rules(F.col("p_name"), NAME_RULES)
    return read(spark, sf, "part").select("p_partkey", case_first(rules, MISSING).alias("tag"))


@query("""
SELECT p_partkey, CASE WHEN contains(p_name, 'gear') THEN 'DRIVE' WHEN contains(p_name, 'blue') THEN 'BLUE LINE'
  WHEN contains(p_name, 'ring') THEN 'SEAL' WHEN contains(p_name, 'r') THEN 'R-GROUP'
  WHEN contains(p_name, 'bolt') THEN 'FASTENER' ELSE 'N/A' END AS tag FROM part
""")
def rule_last_match(spark: SparkSession, sf: str) -> DataFrame:
    rules = contains_rules(F.col("p_name"), NAME_RULES)
    return read(spark, sf, "part").select("p_partkey", case_last(rules, MISSING).alias("tag"))


@query("""
WITH l AS (
  SELECT DISTINCT p_brand || '-' || p_type AS k, lower(p_type) AS feature, 'P' || split_part(p_brand, '#', 2) AS process
  FROM part WHERE p_type IN ('PROMO', 'ECONOMY', 'LARGE')
)
SELECT p_partkey, p_brand || '-' || p_type AS key_field, feature, process
FROM part LEFT JOIN l ON p_brand || '-' || p_type = l.k
""", name="classify_by_key")
def classify_by_list(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part")
    listed = part.where(F.col("p_type").isin("PROMO", "ECONOMY", "LARGE")).select(
        F.concat_ws("-", "p_brand", "p_type").alias("key_field"), F.lower("p_type").alias("feature"),
        F.concat(F.lit("P"), segment("p_brand", "#", 1)).alias("process"),
    ).distinct()
    found = classify_by_key(part, listed, ["p_brand", "p_type"], "key_field")
    return found.select("p_partkey", "key_field", "feature", "process")


@query("""
SELECT p_partkey,
       CASE WHEN p_type IN ('PROMO', 'ECONOMY') AND contains(p_name, 'bolt') THEN p_brand
            WHEN p_type = 'STANDARD' AND p_brand LIKE 'Brand#1%' THEN split_part(p_brand, '#', 1)
            WHEN p_type = 'LARGE' THEN 'BULK' ELSE 'N/A' END AS event_source,
       CASE WHEN p_type IN ('PROMO', 'ECONOMY') AND contains(p_name, 'bolt') THEN ltrim(lpad(CAST(p_partkey AS VARCHAR), 12, '0'), '0')
            WHEN p_type = 'STANDARD' AND p_brand LIKE 'Brand#1%' THEN split_part(p_brand, '#', 2)
            WHEN p_type = 'LARGE' THEN 'No Store' ELSE 'N/A' END AS store_code
FROM part
""")
def source_and_store(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part").withColumn("store_number", F.lpad(F.col("p_partkey").cast("string"), 12, "0"))
    promo = {"p_type": ["PROMO", "ECONOMY"], "p_name": pattern("%bolt%")}
    standard = {"p_type": "STANDARD", "p_brand": pattern("Brand#1%")}
    large = {"p_type": "LARGE"}
    named = route(part, "event_source", [
        Route(promo, F.col("p_brand")), Route(standard, segment("p_brand", "#", 0)), Route(large, "BULK"),
    ])
    named = route(named, "store_code", [
        Route(promo, strip_zeros("store_number")), Route(standard, segment("p_brand", "#", 1)), Route(large, "No Store"),
    ])
    return named.select("p_partkey", "event_source", "store_code")


@query("""
WITH l AS (
  SELECT DISTINCT s_nationkey AS n, s_nationkey // 5 AS t, CASE WHEN s_acctbal < 0 THEN 'debit' ELSE 'credit' END AS biz,
         n_name AS site
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)
SELECT c_custkey, biz AS "bizLocation_rfl", site AS premise_from_biz
FROM customer LEFT JOIN l ON c_nationkey = n AND c_mktsegment IN ('BUILDING', 'FURNITURE')
""", name="content_site")
def content_sites(spark: SparkSession, sf: str) -> DataFrame:
    customers = read(spark, sf, "customer")
    nation = F.col("c_nationkey").cast("string")
    events = customers.select(
        "c_custkey",
        F.when(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), "CONTENT").otherwise("ITEM").alias("thingType"),
        F.when(F.col("c_acctbal") < 0, "unlink").otherwise("link").alias("transactionId"),
        F.concat(F.lit("a-b-c-RFL"), nation).alias("serialNumber"),
        F.concat(F.lit("RFL"), nation).alias("referenceListSerial"),
    )
    events = events.withColumn("id_serial_number", identity("c_custkey"))
    suppliers, nations = read(spark, sf, "supplier"), read(spark, sf, "nation")
    lists = suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey).select(
        F.concat(F.lit("RFL"), F.col("s_nationkey").cast("string")).alias("serialNumber"),
        F.floor(F.col("s_nationkey") / 5).cast("string").alias("tenantCode"),
        F.when(F.col("s_acctbal") < 0, "debit").otherwise("credit").alias("value"),
        F.col("n_name").alias("rflSiteCode"),
    )
    return content_site(events, lists).select("c_custkey", "bizLocation_rfl", "premise_from_biz")


# -- the daily job ---------------------------------------------------------------------------------------------------


def typed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Views as content, clicks as items, purchases as stores, signups as stock counts; errors come counted."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    return read(spark, sf, "events").where(kind != "error").select(
        F.col("event_id").cast("string").alias("id"), F.concat(F.lit("u-x-y-L"), user).alias("serialNumber"),
        F.lit("T").alias("tenantCode"),
        case_first([(kind == "view", "CONTENT"), (kind == "click", "ITEM"), (kind == "purchase", "STORE")], "SOH").alias("thingType"),
        case_first([(kind == "view", "SERVICES"), (kind == "click", "EPCIS")], "").alias("specName"),
        case_first([(kind == "view", "/SERVICES"), (kind == "click", "/x/EPCIS"),
                    (kind == "purchase", F.concat(F.lit("/x/ALEB_00"), user))], "/x/FEED").alias("bridgeKey"),
        F.col("ts").alias("time"),
    )


def typed_attributes(spark: SparkSession, sf: str) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id").cast("string")

    def pair(key, value):
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    pairs = F.array(
        pair("source", F.when(kind == "click", F.when(F.col("value") >= 80, "STORELESS").when(F.col("value") >= 50, "LISTED"))),
        pair("Retail_Premise", F.when(kind == "click", F.lpad(k().cast("string"), 5, "0"))),
        pair("transactionId", F.when(kind == "view", F.when(F.col("value") >= 30, "unlink").otherwise("link"))),
        pair("referenceListSerial", F.when(kind == "view", F.concat(F.lit("L"), user))),
        pair("Retail_SOHStoreNumber", F.when(kind == "signup", F.lpad(user, 8, "0"))),
    )
    rows = read(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("metadataId"), F.concat(F.lit("u-x-y-L"), user).alias("serialNumber"),
        F.explode(pairs).alias("pair"), F.col("ts").alias("time"),
    )
    return rows.select("metadataId", "serialNumber", "pair.key", "pair.value", "time").where(F.col("value").isNotNull())


def customer_lists(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").where(F.col("c_acctbal") >= 0).select(
        F.concat(F.lit("L"), F.col("c_custkey").cast("string")).alias("serialNumber"), F.lit("T").alias("tenantCode"),
        F.lit("bizLocation").alias("key"), F.lit("biz").alias("value"),
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("rflSiteCode"), F.lit(None).cast("timestamp").alias("time"),
    )


def taxonomy(spark: SparkSession) -> DataFrame:
    content, item = ("CONTENT", "SERVICES", "SERVICES", "N/A", "N/A", "N/A"), ("ITEM", "EPCIS", "EPCIS", "LISTED", "N/A", "N/A")
    rules = [
        ("FeatureSet", 1, *content, "unlink", None, "SUPPLY CHAIN"), ("FeatureSet", 2, *content, None, "unlink", "CATALOGUE"),
        ("Is_InternalEvent", 3, *content, None, None, "0"), ("FeatureSet", 4, *item, None, None, "SOURCING"),
        ("Process", 5, *item, None, None, "COMMISSIONING"), ("Is_InternalEvent", 6, *item, None, None, "1"),
    ]
    return spark.createDataFrame(rules, rules_schema(RULE_KEYS, ("transactionId_is", "transactionId_not")))


@query("""
WITH site AS (SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS code FROM customer WHERE c_acctbal >= 0),
e AS (
  SELECT date_trunc('hour', ts) AS datetime_h, event_type, user_id, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k, code,
         event_type = 'click' AND value >= 50 AND value < 80 AS listed, event_type = 'click' AND value >= 80 AS storeless
  FROM events LEFT JOIN site ON user_id = c_custkey
)
SELECT datetime_h,
       CASE event_type WHEN 'view' THEN 'CONTENT' WHEN 'click' THEN 'ITEM' WHEN 'purchase' THEN 'STORE' WHEN 'error' THEN 'error'
            ELSE 'SOH' END AS "thingType",
       CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN CASE WHEN value >= 30 THEN 'SUPPLY CHAIN' ELSE 'CATALOGUE' END
            ELSE CASE WHEN listed THEN 'SOURCING' ELSE 'N/A' END END AS "FeatureSet",
       CASE WHEN event_type = 'error' THEN NULL WHEN listed THEN 'COMMISSIONING' ELSE 'N/A' END AS "Process",
       CASE event_type WHEN 'view' THEN 'SERVICES' WHEN 'click' THEN CASE WHEN listed THEN 'LISTED' WHEN storeless THEN 'STORELESS' ELSE 'N/A' END
            WHEN 'purchase' THEN 'ALEB' WHEN 'signup' THEN 'FEED' END AS "EventSource",
       CASE event_type WHEN 'view' THEN ltrim(code, '0') WHEN 'click' THEN CASE WHEN listed THEN ltrim(CAST(k AS VARCHAR), '0') ELSE 'N/A' END
            WHEN 'purchase' THEN '00' || user_id WHEN 'signup' THEN ltrim(CAST(user_id AS VARCHAR), '0') END AS "StoreCode",
       CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN '0' WHEN listed THEN '1' ELSE 'N/A' END AS "Is_InternalEvent",
       count(*) AS event_count
FROM e GROUP BY ALL
""")
def classified_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The whole daily classification over all events, with the errors that arrive counted."""
    routes = event_routes(["LISTED"], ["LISTED", "STORELESS"], ["APP"], ["READER"], ["SERVICES"], item_store_sources=["LISTED"])
    named = classified_events(
        typed_headers(spark, sf), typed_attributes(spark, sf), customer_lists(spark, sf), taxonomy(spark), routes
    )
    counted = named.groupBy(*COUNT_SETS["events_classification"]).agg(F.count(F.lit(1)).alias("event_count"))
    errors = read(spark, sf, "events").where(F.col("event_type") == "error")
    elsewhere = hourly_event_counts(errors, "ts", [F.col("event_type").alias("thingType")], name="count")
    wanted = ["datetime_h", "thingType", "FeatureSet", "Process", "EventSource", "StoreCode", "Is_InternalEvent"]
    # The job keeps more dimensions than are shown here.
    shown = add_preaggregated(counted, elsewhere).groupBy(*wanted).agg(F.sum("event_count").alias("event_count"))
    return shown.withColumn("datetime_h", plain("datetime_h"))


# -- sources ---------------------------------------------------------------------------------------------------------


@query("""
SELECT 'demand' AS environment, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 2
UNION ALL SELECT 'supply', s_nationkey, count(*) FROM supplier GROUP BY 2
""")
def environments(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"demand": Table("customer", f"{sf}/customer.parquet"), "supply": Table("supplier", f"{sf}/supplier.parquet")}
    nations = {"demand": "c_nationkey", "supply": "s_nationkey"}
    parts = [by_environment(spark, tables, e).select("environment", F.col(nations[e]).alias("nation")) for e in tables]
    return parts[0].unionByName(parts[1]).groupBy("environment", "nation").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders
WHERE o_orderpriority LIKE '%URGENT%' AND o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1
""")
def sql_text(spark: SparkSession, sf: str) -> DataFrame:
    return run_sql(spark, """
        SELECT date_format(o_orderdate, 'yyyy-MM') AS month, count(*) AS n FROM {orders}
        WHERE o_orderpriority LIKE :like AND o_orderdate >= to_date(:since) GROUP BY 1
    """, {"orders": read(spark, sf, "orders")}, like="%URGENT%", since="1996-01-01")
