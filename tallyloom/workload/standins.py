"""Benchmark tables in the roles of the operators' inputs, in Spark and as SQL fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.cases import case_first
from tallyloom.functions.columns import json_value, to_long
from tallyloom.sources import Table, scan

# The given tables. A declared schema saves the job that reads the files' footers before every query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
STORAGE = "bolt"  # parts of this kind play the storage SKUs


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return scan(spark, Table(name, f"{sf}/{name}.parquet", schema=SCHEMAS[name]))


def plain(time: str | Column) -> Column:
    """Zone-less timestamp, which both engines print alike."""
    return (F.col(time) if isinstance(time, str) else time).cast("timestamp_ntz")


def units(amount: Column | str, per: int = 10_000) -> Column:
    """Money in whole small units. Sums of whole numbers are exact in any order, so both engines agree to the bit."""
    return F.rint((F.col(amount) if isinstance(amount, str) else amount) * F.lit(float(per)))


# -- billing lines ---------------------------------------------------------------------------------------------------

def billing_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as nested billing lines with two credits."""
    line, part, supplier = read(spark, sf, "lineitem"), read(spark, sf, "part"), read(spark, sf, "supplier")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    first = case_first([(flag == "R", "SUSTAINED_USAGE_DISCOUNT"), (flag == "A", "PROMOTION")])
    second = case_first([(status == "F", "COMMITTED_USAGE_DISCOUNT"), (status == "O", "PROMOTION")])
    unit = case_first(
        [(flag == "R", "bytes"), (flag == "A", "requests"), (status == "F", "seconds"), (status == "O", "byte-seconds")]
    )

    def credit(kind: Column, rate: str) -> Column:
        return F.struct(
            F.col("p_type").alias("name"), (-units(F.col("l_extendedprice") * F.col(rate))).alias("amount"), kind.alias("type")
        )

    joined = line.join(part, line.l_partkey == part.p_partkey, "left")
    joined = joined.join(supplier, line.l_suppkey == supplier.s_suppkey, "left")
    return joined.select(
        F.struct(F.col("p_brand").alias("id"), F.col("p_type").alias("description")).alias("service"),
        F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("description")).alias("sku"),
        F.struct(F.col("s_name").alias("id"), F.col("s_suppkey").cast("string").alias("number")).alias("project"),
        F.struct(F.col("l_quantity").alias("amount"), unit.alias("unit")).alias("usage"),
        F.struct(
            F.col("p_name").alias("name"), F.concat(F.lit("//"), "p_brand", F.lit("/"), "p_type").alias("global_name")
        ).alias("resource"),
        F.array(credit(first, "l_discount"), credit(second, "l_tax")).alias("credits"),
        units("l_extendedprice").alias("cost"),
        F.lit("regular").alias("cost_type"),
        F.col("l_shipdate").alias("usage_start_time"),
    )


BILLING = """b AS (
  SELECT p_type AS service_description, p_name AS sku_description, s_name AS id_project, round(l_extendedprice * 10000) AS cost,
         l_quantity AS usage_amount, p_name AS resource_name, '//' || p_brand || '/' || p_type AS resource_global_name,
         l_shipdate AS usage_start_time, timezone('America/Los_Angeles', timezone('UTC', l_shipdate)) AS local_time,
         CASE WHEN l_returnflag = 'R' THEN 'bytes' WHEN l_returnflag = 'A' THEN 'requests'
              WHEN l_linestatus = 'F' THEN 'seconds' WHEN l_linestatus = 'O' THEN 'byte-seconds' END AS usage_unit,
         CASE l_returnflag WHEN 'R' THEN 'SUSTAINED_USAGE_DISCOUNT' WHEN 'A' THEN 'PROMOTION' END AS t1,
         -round(l_extendedprice * l_discount * 10000) AS a1,
         CASE l_linestatus WHEN 'F' THEN 'COMMITTED_USAGE_DISCOUNT' WHEN 'O' THEN 'PROMOTION' END AS t2,
         -round(l_extendedprice * l_tax * 10000) AS a2
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
), c AS (
  SELECT *, sku_description LIKE '%bolt%' AS is_storage,
         CASE WHEN t1 LIKE '%DISCOUNT%' THEN a1 ELSE 0 END + CASE WHEN t2 LIKE '%DISCOUNT%' THEN a2 ELSE 0 END AS disc,
         CASE WHEN t1 LIKE '%PROMOTION%' THEN a1 ELSE 0 END + CASE WHEN t2 LIKE '%PROMOTION%' THEN a2 ELSE 0 END AS promo,
         CASE WHEN t1 = 'PROMOTION' THEN 0 ELSE a1 END + CASE WHEN t2 = 'PROMOTION' THEN 0 ELSE a2 END AS disc_exact,
         CASE WHEN t1 = 'PROMOTION' THEN a1 ELSE 0 END + CASE WHEN t2 = 'PROMOTION' THEN a2 ELSE 0 END AS promo_exact
  FROM b
)"""


# -- events ----------------------------------------------------------------------------------------------------------

def k(props: str = "props") -> Column:
    """The number every event carries in its JSON properties."""
    return to_long(json_value(props, "$.k"))


def event_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Headers. Errors arrive counted already, on another feed."""
    return read(spark, sf, "events").where(F.col("event_type") != "error").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("serialNumber"), F.col("event_type").alias("thingType"),
        F.col("ts").alias("time"),
    )


def event_attributes(spark: SparkSession, sf: str) -> DataFrame:
    """Key/value attributes. The feed leaves views out."""
    events = read(spark, sf, "events").where(F.col("event_type") != "view")
    pair = F.explode(F.array(
        F.struct(F.lit("k").alias("key"), json_value("props", "$.k").alias("value")),
        F.struct(F.lit("type").alias("key"), F.col("event_type").alias("value")),
    ))
    rows = events.select(
        F.col("event_id").alias("metadataId"), F.col("user_id").alias("serialNumber"), F.col("ts").alias("time"),
        pair.alias("pair"),
    )
    return rows.select("metadataId", "serialNumber", "time", "pair.key", "pair.value")


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases as the hourly cost pool."""
    sales = read(spark, sf, "events").where(F.col("event_type") == "purchase")
    return sales.select(
        F.date_trunc("hour", "ts").alias("datetime_h"), (units("value", 100) * 10).alias("cost"),
        (units("value", 100) * 9).alias("cost_after_discount"),
    )


PURCHASES = """pool AS (
  SELECT date_trunc('hour', ts) AS datetime_h, round(value * 100) * 10 AS cost, round(value * 100) * 9 AS after
  FROM events WHERE event_type = 'purchase'
)"""


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as an HTTP request."""
    kind = F.col("event_type")
    key = F.when(kind == "view", "").otherwise(F.concat(F.lit("K"), F.col("user_id").cast("string")))
    return read(spark, sf, "events").select(
        F.col("ts").alias("time"),
        case_first([(kind.isin("purchase", "signup"), "POST")], "GET").alias("method"),
        F.concat(F.lit("/"), kind, F.lit("/u"), F.col("user_id").cast("string"), F.lit("/"), k().cast("string"),
                 F.lit("/items")).alias("uri"),
        F.concat(F.lit("host-"), F.substring(kind, 1, 1)).alias("host"),
        case_first([(kind == "error", 500), (kind == "signup", 404), (kind == "click", 429)], 200).alias("status"),
        k().alias("length"),
        units("value", 100).alias("latency"),
        F.lit("edge").alias("source"), F.col("user_id").cast("string").alias("user"), key.alias("apikey"),
        F.lit("basic").alias("auth"), F.lit("-").alias("token"),
    )


REQUESTS = """r AS (
  SELECT ts AS time, CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
         '/' || event_type || '/u' || user_id || '/' || CAST(json_extract(props, '$.k') AS BIGINT) || '/items' AS uri,
         'host-' || substr(event_type, 1, 1) AS host,
         CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 WHEN 'click' THEN 429 ELSE 200 END AS status,
         CAST(json_extract(props, '$.k') AS BIGINT) AS length, round(value * 100) AS latency, CAST(user_id AS VARCHAR) AS usr,
         CASE WHEN event_type = 'view' THEN '' ELSE 'K' || user_id END AS apikey
  FROM events
)"""


# -- calendar --------------------------------------------------------------------------------------------------------

def quarters(spark: SparkSession, sf: str) -> DataFrame:
    """First day of every quarter in which something was ordered: name, start of the quarter."""
    start = F.date_trunc("quarter", "o_orderdate")
    days = read(spark, sf, "orders").select(start.cast("timestamp_ntz").alias("boundary")).distinct()
    name = F.concat(F.lit("v"), F.year("boundary").cast("string"), F.lit("Q"), F.quarter("boundary").cast("string"))
    return days.withColumn("name", name)


QUARTERS = """q AS (
  SELECT DISTINCT CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS boundary FROM orders
), cal AS (
  SELECT boundary AS e, lag(boundary) OVER (ORDER BY boundary) AS s, row_number() OVER (ORDER BY boundary) - 1 AS ord,
         'v' || year(boundary) || 'Q' || quarter(boundary) AS name,
         lead(boundary) OVER (ORDER BY boundary) IS NULL AS is_last
  FROM q
)"""
