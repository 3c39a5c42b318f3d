"""Traffic, catalogues, enrichment, payloads and scalar functions."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import (
    collapse_separator, correct_dates, day_text, hour_of, hour_text, hours_between, join_present, json_value,
    local_time, month_text, nth, parse_time, path_prefix, segment, shift, strip_zeros, to_long, week_label, weekday_flag,
)
from tallyloom.operators import catalog, traffic
from tallyloom.operators.aggregate import distinct_counts, first_per_key, last_per_key, pivot_sum, positions
from tallyloom.operators.bitmaps import counts_of_bitmaps, distinct_bitmaps, new_numbers, with_row_counts
from tallyloom.operators.joins import split_by_match
from tallyloom.operators.shape import clean_names, union_by_name
from tallyloom.schemas import SALES, all_text
from tallyloom.session import scratch_path, settle
from tallyloom.sinks import append_day, commit_batch, conform, is_committed, overwrite, read_batches, write_all, write_selected
from tallyloom.sources import arrays_to_rows, flatten_structs, read_checked, read_csv, read_json, read_variants, shred
from tallyloom.workload.registry import query
from tallyloom.workload.standins import REQUESTS, k, plain, read, requests, units

# -- traffic ---------------------------------------------------------------------------------------------------------


@query(f"""
WITH {REQUESTS}
SELECT strftime(time, '%Y-%m-%d') AS date, strftime(time, '%H') AS hour, host, split_part(uri, '/', 2) AS uri_lv1, status,
       method, sum(length)::BIGINT AS length_sum, avg(latency) AS latency_mean, count(*) AS call_count
FROM r GROUP BY 1, 2, 3, 4, 5, 6
""")
def endpoint_stats(spark: SparkSession, sf: str) -> DataFrame:
    return traffic.endpoint_stats(requests(spark, sf))


@query(f"""
WITH {REQUESTS}
SELECT strftime(time, '%Y-%m-%d') AS date, host, method,
       split_part(uri, '/', 2) || '/' || split_part(uri, '/', 3) || '/' || split_part(uri, '/', 4) AS uri_1_to_3,
       sum(length)::BIGINT AS length_sum, avg(latency) AS latency_mean, count(*) AS call_count
FROM r WHERE status > 404 GROUP BY 1, 2, 3, 4
""")
def failing_endpoints(spark: SparkSession, sf: str) -> DataFrame:
    return traffic.failing_endpoints(requests(spark, sf))


@query(f"""
WITH {REQUESTS}
SELECT method, status, CASE WHEN status <= 404 THEN 'SUCCESS' WHEN status > 404 THEN 'FAILURE' END AS outcome, count(*) AS calls
FROM r GROUP BY 1, 2, 3
""")
def request_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    judged = requests(spark, sf).withColumn("outcome", traffic.outcome())
    return judged.groupBy("method", "status", "outcome").agg(F.count(F.lit(1)).alias("calls"))


@query(f"""
WITH {REQUESTS}
SELECT date_trunc('hour', time) AS datetime_h, host, usr AS user, 'basic' AS auth, '-' AS token, 'edge' AS source, method,
       uri, status, apikey,
       CASE WHEN apikey = '' THEN 'empty' WHEN c_acctbal >= 0 THEN 'known value' ELSE 'unknown' END AS apikey_label,
       count(*) AS call_count
FROM r LEFT JOIN customer ON apikey = 'K' || c_custkey GROUP BY ALL
""")
def apikey_audit(spark: SparkSession, sf: str) -> DataFrame:
    known = read(spark, sf, "customer").select(
        F.concat(F.lit("K"), F.col("c_custkey").cast("string")).alias("apiKey_l"),
        F.when(F.col("c_acctbal") >= 0, "known value").otherwise("revoked").alias("Description"),
    )
    return traffic.apikey_audit(requests(spark, sf), known).withColumn("datetime_h", plain("datetime_h"))


@query("""
SELECT page_id, split_part(url, '/', 3) AS host, nullif(split_part(url, '/', 4), '') AS uri_lv1,
       CASE WHEN len(string_split(url, '/')) > 5 THEN string_split(url, '/')[6] END AS uri_lv3
FROM pages
""")
def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").select(
        "page_id", segment("url", "/", 2).alias("host"), F.nullif(segment("url", "/", 3), F.lit("")).alias("uri_lv1"),
        segment("url", "/", 5).alias("uri_lv3"),
    )


# -- catalogue and enrichment ----------------------------------------------------------------------------------------


@query("""
SELECT s_suppkey AS id, CASE WHEN s_acctbal < 0 THEN 'south' ELSE 'north' END AS tenant, n_name AS "locationCode",
       CASE WHEN n_regionkey IS NOT NULL THEN n_nationkey END AS zone_number, r_name AS premise, r_regionkey AS premise_number
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def site_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    supplier, nation, region = (read(spark, sf, t) for t in ("supplier", "nation", "region"))
    places = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    tenant = F.when(F.col("s_acctbal") < 0, "south").otherwise("north").alias("tenant")
    fixtures = supplier.join(places, supplier.s_nationkey == places.n_nationkey, "left").select(
        F.col("s_suppkey").alias("id"), tenant, F.col("n_name").alias("locationCode"), F.col("r_name").alias("premise")
    )
    tenants = F.explode(F.array(F.lit("south"), F.lit("north"))).alias("tenant")
    zones = nation.select(tenants, F.col("n_name").alias("code"), F.col("n_nationkey").alias("number"))
    premises = region.select(tenants, F.col("r_name").alias("code"), F.col("r_regionkey").alias("number"))
    return catalog.site_catalogue(fixtures, zones, premises)


@query("""
SELECT 'all' AS tenant, n_name AS code, 'R' || n_regionkey AS premise, r_name AS premise_name
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
""")
def zone_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    def code(c: str):
        return F.concat(F.lit("R"), F.col(c).cast("string"))

    zones = read(spark, sf, "nation").select(
        F.lit("all").alias("tenant"), F.col("n_name").alias("code"),
        F.struct(code("n_regionkey").alias("premiseId")).alias("hierarchy"),
    )
    premises = read(spark, sf, "region").select(
        F.lit("all").alias("tenant"), code("r_regionkey").alias("code"), F.col("r_name").alias("name")
    )
    return catalog.zone_catalogue(zones, premises)


@query("""
SELECT l_suppkey AS premise, l_returnflag AS disposition, l_linestatus AS action, count(DISTINCT l_partkey) AS distinct_gtin,
       count(DISTINCT l_orderkey) AS distinct_sku, count(DISTINCT l_shipdate) AS distinct_hexa, count(*) AS item_count
FROM lineitem WHERE l_returnflag NOT IN ('R') GROUP BY 1, 2, 3
""")
def item_counts(spark: SparkSession, sf: str) -> DataFrame:
    items = read(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("premise"), F.col("l_returnflag").alias("disposition"),
        F.col("l_linestatus").alias("action"), F.col("l_partkey").alias("gtin"), F.col("l_orderkey").alias("sku"),
        F.col("l_shipdate").alias("hexa"),
    )
    return catalog.item_counts(items, ["premise", "disposition", "action"], excluded=["R"])


VOCABULARIES = ("urn:epcglobal:cbv:disp:", "urn:econnectware:epcis:disp:")
STATES = ("blacklisted", "missing", "retail_sold", "active", "in_transit")


@query(f"""
WITH t AS (
  SELECT l_suppkey AS premise, l_partkey AS gtin, l_orderkey AS sku, l_shipdate AS hexa,
         {list(VOCABULARIES)}[l_linenumber % 2 + 1] || {list(STATES)}[l_partkey % 5 + 1] AS disposition FROM lineitem)
SELECT premise, disposition, count(DISTINCT gtin) AS distinct_gtin, count(DISTINCT sku) AS distinct_sku,
       count(DISTINCT hexa) AS distinct_hexa, count(*) AS item_count
FROM t WHERE NOT (disposition LIKE 'urn:epcglobal:cbv:disp:%' AND disposition NOT LIKE '%:active')
  AND disposition <> 'urn:econnectware:epcis:disp:blacklisted'
GROUP BY 1, 2
""")
def item_counts_default(spark: SparkSession, sf: str) -> DataFrame:
    """The default exclusions, over states of two vocabularies of which only one is excluded almost whole."""
    words = F.array(*[F.lit(v) for v in VOCABULARIES]), F.array(*[F.lit(s) for s in STATES])
    items = read(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("premise"), F.col("l_partkey").alias("gtin"), F.col("l_orderkey").alias("sku"),
        F.col("l_shipdate").alias("hexa"),
        F.concat(F.get(words[0], F.col("l_linenumber") % 2), F.get(words[1], (F.col("l_partkey") % 5).cast("int"))).alias("disposition"),
    )
    return catalog.item_counts(items, ["premise", "disposition"])


@query("""
WITH t AS (
  SELECT l_returnflag AS environment, CASE WHEN l_linestatus = 'F' THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS process_date,
         CASE WHEN l_linenumber < 6 THEN l_shipdate END AS datetime_h FROM lineitem)
SELECT environment, process_date::TIMESTAMP AS process_date, datetime_h, count(*) AS event_count FROM t GROUP BY ALL
""")
def write_two_environments(spark: SparkSession, sf: str) -> DataFrame:
    """Several environments and days into one table, each written twice, with rows that have no time: none lost, none doubled."""
    path = scratch_path(spark, "environments")
    counts = read(spark, sf, "lineitem").groupBy(
        F.col("l_returnflag").alias("environment"),
        F.when(F.col("l_linestatus") == "F", F.lit("2024-01-01")).otherwise("2024-01-02").cast("date").alias("process_date"),
        F.when(F.col("l_linenumber") < 6, F.col("l_shipdate")).alias("datetime_h"),
    ).agg(F.count(F.lit(1)).alias("event_count"))
    for environment in ("A", "N", "R"):
        for day in ("2024-01-01", "2024-01-02"):
            part = counts.where((F.col("environment") == environment) & (F.col("process_date") == F.lit(day).cast("date")))
            for _ in range(2):
                write_selected({"counts": lambda part=part: append_day(part, path, ["environment", "process_date"])}, "counts")
    out = spark.read.schema("datetime_h timestamp_ntz, event_count bigint, environment string, process_date date").parquet(path)
    return out.withColumn("process_date", F.col("process_date").cast("timestamp_ntz"))


@query("""
WITH t AS (SELECT DISTINCT s_nationkey, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT c_custkey, n_regionkey AS premise_from_biz FROM customer LEFT JOIN t ON c_nationkey = s_nationkey
""")
def premise_by_location(spark: SparkSession, sf: str) -> DataFrame:
    suppliers, nations = read(spark, sf, "supplier"), read(spark, sf, "nation")
    sites = suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey).select(
        F.lit("all").alias("tenant"), F.col("s_nationkey").alias("bizLocation"), F.col("n_regionkey").alias("code")
    )
    customers = read(spark, sf, "customer").select(
        "c_custkey", F.lit("all").alias("tenantCode"), F.col("c_nationkey").alias("bizLocation_rfl")
    )
    found = catalog.premise_of_location(customers, sites, "bizLocation", "bizLocation_rfl", "code", "premise_from_biz")
    return found.select("c_custkey", "premise_from_biz")


@query("""
WITH w AS (
  SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, user_id AS code, max(value) AS temperature
  FROM events WHERE event_type = 'click' GROUP BY 1, 2
)
SELECT event_id, user_id AS premise, c_mktsegment AS segment, p_name AS product, temperature
FROM events LEFT JOIN customer ON user_id = c_custkey
     LEFT JOIN part ON CAST(json_extract(props, '$.k') AS BIGINT) = p_partkey
     LEFT JOIN w ON CAST(w.hour AS TIMESTAMP) = date_trunc('hour', ts) AND w.code = user_id
""")
def enrich_events(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events")
    facts = events.select(
        "event_id", F.col("ts").alias("time"), F.col("user_id").alias("premise"), k().alias("gtin")
    )
    sites = read(spark, sf, "customer").select(F.col("c_custkey").alias("code"), F.col("c_mktsegment").alias("segment"))
    products = read(spark, sf, "part").select(F.col("p_partkey").alias("gtin"), F.col("p_name").alias("product"))
    clicks = events.where(F.col("event_type") == "click")
    weather = clicks.groupBy(
        F.date_format(hour_of("ts"), "yyyy-MM-dd HH:mm:ss").alias("hour"), F.col("user_id").alias("code")
    ).agg(F.max("value").alias("temperature"))
    return catalog.enrich_events(facts, sites, products, weather).select(
        "event_id", "premise", "segment", "product", "temperature"
    )


# -- payloads and files ----------------------------------------------------------------------------------------------


@query("""
SELECT vec_id, label, unnest(generate_series(0, len(embedding) - 1)) AS position, unnest(embedding)::DOUBLE AS temperature
FROM embeddings
""", name="arrays_to_rows")
def arrays_as_rows(spark: SparkSession, sf: str) -> DataFrame:
    vectors = read(spark, sf, "embeddings").withColumn("hour", F.sequence(F.lit(0), F.size("embedding") - 1))
    rows = arrays_to_rows(vectors, {"position": "hour", "temperature": "embedding"}, "vec_id", "label")
    return rows.withColumns({"temperature": F.col("temperature").cast("double"), "position": F.col("position").cast("bigint")})


@query("""
SELECT c_custkey AS code, c_name AS name, c_nationkey AS "hierarchy.nation.key", n_name AS "hierarchy.nation.name"
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def payload_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Nested JSON landed in the shared folder, read back with a schema and flattened to dotted names."""
    customers, nations = read(spark, sf, "customer"), read(spark, sf, "nation")
    nested = customers.join(nations, customers.c_nationkey == nations.n_nationkey, "left").select(
        F.col("c_custkey").alias("code"), F.col("c_name").alias("name"),
        F.struct(F.struct(F.col("c_nationkey").alias("key"), F.col("n_name").alias("name")).alias("nation")).alias("hierarchy"),
    )
    path = scratch_path(spark, "payload")
    overwrite(nested, path, fmt="json")
    schema = "code bigint, name string, hierarchy struct<nation:struct<key:int,name:string>>"
    return flatten_structs(read_json(spark, path, schema))


@query("""
SELECT c_custkey AS code, CASE WHEN c_mktsegment <> 'BUILDING' THEN round(c_acctbal * 100) END::BIGINT AS cents,
       CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS nation_key, n_name AS nation_name, c_mktsegment = 'BUILDING' AS unread
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def payload_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads whose fields differ by row: a balance that is a number, a text or no number at all, a nation with parts or by name."""
    customers, nations = read(spark, sf, "customer"), read(spark, sf, "nation")
    segment, nation = F.col("c_mktsegment"), F.struct(F.col("c_nationkey").alias("key"), F.col("n_name").alias("name"))
    cents = F.rint(F.col("c_acctbal") * 100).cast("bigint")
    balance = F.when(segment == "BUILDING", '"unknown"').when(
        segment == "MACHINERY", F.concat(F.lit('"'), cents.cast("string"), F.lit('"'))).otherwise(cents.cast("string"))
    where = F.when(F.col("c_acctbal") >= 0, F.to_json(nation)).otherwise(F.concat(F.lit('"'), "n_name", F.lit('"')))
    joined = customers.join(nations, customers.c_nationkey == nations.n_nationkey, "left")
    path = scratch_path(spark, "variants")
    joined.select(F.concat(
        F.lit('{"code":'), F.col("c_custkey").cast("string"), F.lit(',"balance":'), balance, F.lit(',"nation":'), F.coalesce(where, F.lit("null")), F.lit("}"),
    ).alias("value")).write.text(path)
    read_back = shred(read_variants(spark, path), "payload", {
        "code": ("$.code", "bigint"), "cents": ("$.balance", "bigint"), "nation_key": ("$.nation.key", "int"),
        "inner": ("$.nation.name", "string"), "plain": ("$.nation", "string"), "text": ("$.balance", "string"),
    })
    # An object asked for as text gives its JSON, so the name inside it comes first.
    return read_back.select("code", "cents", "nation_key", F.coalesce("inner", "plain").alias("nation_name"), (F.col("text") == "unknown").alias("unread"))


@query("""
SELECT c_custkey, c_nationkey, n_name AS "Name", CAST(n_regionkey AS VARCHAR) AS "Region"
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def csv_reference(spark: SparkSession, sf: str) -> DataFrame:
    """A reference list kept as CSV, every column text, joined to the facts it describes."""
    path = scratch_path(spark, "reference")
    listed = read(spark, sf, "nation").select(
        F.col("n_nationkey").alias("Key"), F.col("n_name").alias("Name"), F.col("n_regionkey").alias("Region")
    )
    overwrite(listed, path, fmt="csv", options={"header": "true"})
    from tallyloom.operators.joins import lookup

    nations = read_csv(spark, path, all_text("Key", "Name", "Region"))
    customers = read(spark, sf, "customer").withColumn("Key", F.col("c_nationkey").cast("string"))
    return lookup(customers, nations, "Key").select("c_custkey", "c_nationkey", "Name", "Region")


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(sum(round(o_totalprice * 100)) AS DOUBLE) AS cost, count(*) AS orders,
       CAST(NULL AS DOUBLE) AS promotion_credits
FROM orders GROUP BY 1
""", name="write_day_partition")
def write_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Written twice with replacement by partition, in the declared schema: nothing doubles."""
    path = scratch_path(spark, "monthly")
    orders = read(spark, sf, "orders").withColumn("month", month_text("o_orderdate"))
    monthly = orders.groupBy("month").agg(F.sum(units("o_totalprice", 100)).alias("cost"), F.count(F.lit(1)).alias("orders"))
    declared = conform(monthly, "month string, cost double, orders bigint, promotion_credits double")
    for _ in range(2):
        write_selected({"monthly": lambda: append_day(declared, path, "month")}, "monthly")
    return spark.read.schema("cost double, orders bigint, promotion_credits double, month string").parquet(path)


@query("""
WITH r AS (SELECT CAST(ts AS DATE) AS day, event_type, user_id, value FROM events)
SELECT 'stats' AS output, event_type AS key, count(*) AS requests, sum(round(value * 100))::DOUBLE AS latency FROM r GROUP BY 2
UNION ALL
SELECT 'users', CAST(user_id AS VARCHAR), count(*), NULL FROM r GROUP BY 2
""")
def append_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A batch for each week with two outputs, each sent twice, one broken off between the outputs before: every row once."""
    root = scratch_path(spark, "batches")
    events = read(spark, sf, "events").withColumn("week", F.date_trunc("week", "ts").cast("date"))
    broken = F.assert_true(F.lit(False), F.lit("broken off"))
    for number, r in enumerate(events.select("week").distinct().orderBy("week").collect()):  # the calendar's weeks
        part = events.where(F.col("week").eqNullSafe(F.lit(r["week"])))
        outputs = {
            "stats": part.groupBy("event_type").agg(F.count(F.lit(1)).alias("requests"), F.sum(units("value", 100)).alias("latency")),
            "users": part.groupBy("user_id").agg(F.count(F.lit(1)).alias("requests")),
        }
        if number == 1:
            try:
                commit_batch(spark, root, f"week-{r['week']}", {**outputs, "users": outputs["users"].where(broken.isNull())})
            except (PySparkException, Py4JError):
                pass  # the broken batch, whose first output is written and must stay unseen
        for _ in range(2):
            commit_batch(spark, root, f"week-{r['week']}", outputs)
    stats = read_batches(spark, root, "stats", "event_type string, requests bigint, latency double")
    users = read_batches(spark, root, "users", "user_id bigint, requests bigint")
    totals = [
        stats.groupBy(F.col("event_type").alias("key")).agg(F.sum("requests").alias("requests"), F.sum("latency").alias("latency")),
        users.groupBy(F.col("user_id").cast("string").alias("key")).agg(F.sum("requests").alias("requests"), F.lit(None).cast("double").alias("latency")),
    ]
    named = [t.select(F.lit(n).alias("output"), "key", "requests", "latency") for n, t in zip(("stats", "users"), totals)]
    return named[0].unionByName(named[1])


@query("""
WITH t AS (
  SELECT l_suppkey AS site, round(l_extendedprice * 100) / 100 AS usd, l_quantity::BIGINT AS qty,
         CASE WHEN l_tax = 0 THEN '11 cells instead of 12' WHEN l_discount = 0.1 THEN '13 cells instead of 12'
              WHEN l_discount = 0 THEN 'totalSalesUSD is no double: n/a' WHEN l_linestatus = 'F' AND l_linenumber = 7 THEN 'siteCode is empty' END AS reason
  FROM lineitem)
SELECT CASE WHEN reason IS NULL THEN 'S' || site END AS site, reason, count(*) AS rows,
       sum(CASE WHEN reason IS NULL THEN round(usd * 100) END)::DOUBLE AS cents, sum(CASE WHEN reason IS NULL THEN qty END)::BIGINT AS qty
FROM t GROUP BY 1, 2
""")
def sales_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Sales files with short and long lines, cells of the wrong type and empty cells: good rows counted, refused ones by reason."""
    path, cell = scratch_path(spark, "sales"), lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    late = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 7)
    usd = F.format_string("%.2f", F.rint(F.col("l_extendedprice") * 100) / 100)
    cells = [
        F.lit("SALE"), F.concat(cell("l_orderkey"), F.lit("-"), cell("l_linenumber")), F.lit('"a, b"'), F.lit(">G"), F.lit(""), F.to_date("l_shipdate").cast("string"),
        cell("l_linestatus"), F.when(late, "").otherwise(F.concat(F.lit("S"), cell("l_suppkey"))), F.lit("Site"), F.lit("F"),
        F.when(F.col("l_discount") == 0, "n/a").otherwise(usd), F.col("l_quantity").cast("int").cast("string"),
    ]
    line = F.when(F.col("l_tax") == 0, F.concat_ws(",", *cells[:-1])).when(
        F.col("l_discount") == 0.1, F.concat_ws(",", *cells, F.lit("more"))).otherwise(F.concat_ws(",", *cells))
    read(spark, sf, "lineitem").select(line.alias("value")).write.text(path)
    good, refused = read_checked(spark, path, SALES, required=("siteCode",), header=False)
    overwrite(refused, f"{path}-refused")
    kept = good.groupBy(F.col("siteCode").alias("site")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(units("totalSalesUSD", 100)).alias("cents"), F.sum("totalSalesQty").cast("bigint").alias("qty"))
    wrong = spark.read.schema("file string, line string, reason string").parquet(f"{path}-refused").groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    return union_by_name(kept.withColumn("reason", F.lit(None).cast("string")), wrong).select("site", "reason", "rows", "cents", "qty")


@query("""
SELECT * FROM (VALUES ('good', 'ok'), ('last', 'ok'), ('broken', 'USER_RAISED_EXCEPTION')) s(sink, status),
  (SELECT count(*) AS rows, sum(round(o_totalprice * 100))::DOUBLE AS cents FROM orders) t WHERE sink <> 'broken'
UNION ALL SELECT 'broken', 'USER_RAISED_EXCEPTION', 0, NULL
""")
def failing_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Three sinks of the same orders, the second of which fails half way: the others hold every row, and its status says why."""
    orders = read(spark, sf, "orders").select("o_orderkey", units("o_totalprice", 100).alias("cents"))
    broken = orders.withColumn("cents", F.when(F.col("o_orderkey") > 0, F.raise_error(F.lit("half way")).cast("double")))
    paths = {n: scratch_path(spark, n) for n in ("good", "broken", "last")}
    frames = {"good": orders, "broken": broken, "last": orders}
    status = write_all({n: (lambda n=n: overwrite(frames[n], paths[n])) for n in paths})
    out = []
    for n, path in paths.items():
        rows = spark.read.schema("o_orderkey bigint, cents double").parquet(path) if status[n] == "ok" else orders.limit(0)
        out.append(rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("cents").alias("cents")).select(
            F.lit(n).alias("sink"), F.lit(status[n]).alias("status"), "rows", "cents"))
    return union_by_name(*out)


@query(f"""
WITH {REQUESTS}, g AS (
  SELECT strftime(time, '%Y-%m-%d') AS date, host, method,
         split_part(uri, '/', 2) || '/' || split_part(uri, '/', 3) || '/' || split_part(uri, '/', 4) AS uri_1_to_3, count(*) AS call_count
  FROM r WHERE status > 404 GROUP BY 1, 2, 3, 4)
SELECT row_number() OVER (ORDER BY call_count DESC, date, host, method, uri_1_to_3) AS rank, date, host, method, uri_1_to_3, call_count FROM g
""")
def failing_endpoints_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """The order itself, as a number: most calls first, equal ones by their keys."""
    found = traffic.failing_endpoints(requests(spark, sf)).withColumn("_down", -F.col("call_count"))
    keys = ["date", "host", "method", "uri_1_to_3"]
    ranked = positions(found, ["_down", *keys], "rank")
    return ranked.select((F.col("rank") + 1).alias("rank"), *keys, "call_count")


# -- keys, sets and scalars ------------------------------------------------------------------------------------------


@query("""
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate
FROM orders GROUP BY 1
""")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return last_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("""
SELECT user_id, ts, event_id, event_type FROM (
  SELECT user_id, ts, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events
) WHERE n = 1
""")
def earliest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return first_per_key(events, ["user_id"], ["ts", "event_id"])


@query("SELECT c_mktsegment, count(DISTINCT c_nationkey) AS nations, count(*) AS customers FROM customer GROUP BY 1")
def distinct_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_counts(read(spark, sf, "customer"), ["c_mktsegment"], {"nations": "c_nationkey"}, "customers")


@query("""
WITH e AS (SELECT date_trunc('month', ts) AS month, event_type, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT month, event_type, count(DISTINCT user_id) AS users, count(DISTINCT k) AS codes, count(*) AS events FROM e GROUP BY 1, 2
UNION ALL SELECT month, 'all', count(DISTINCT user_id), count(DISTINCT k), count(*) FROM e GROUP BY 1
""")
def distinct_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Sets kept by day, loaded in two batches with the numbers they need, and merged to months, by type and over all types."""
    root, columns = scratch_path(spark, "sets"), ("user_id", "k")
    events = read(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_type", "user_id", k().alias("k"))
    known_as = "value bigint, number bigint"
    for batch, part in (("until-15", events.where(F.dayofmonth("day") <= 15)), ("from-16", events.where(F.dayofmonth("day") > 15))):
        while not is_committed(spark, root, batch):
            known = {c: read_batches(spark, root, c, known_as) for c in columns}
            fresh = {c: settle(new_numbers(part, c, known[c])) for c in columns}
            days = distinct_bitmaps(part, ["day", "event_type"], {c: known[c].unionByName(fresh[c]) for c in columns})
            counts = part.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("events"))
            commit_batch(spark, root, batch, {**fresh, "days": days, "counts": counts})
    days = read_batches(spark, root, "days", "day date, event_type string, measure string, bucket bigint, bitmap binary")
    counts = read_batches(spark, root, "counts", "day date, event_type string, events bigint")
    month, out = F.trunc("day", "month").cast("timestamp_ntz"), []
    for kind in (F.col("event_type"), F.lit("all")):
        sets, rows = (t.withColumns({"month": month, "event_type": kind}) for t in (days, counts))
        found = counts_of_bitmaps(sets, ["month", "event_type"], {"users": "user_id", "codes": "k"})
        out.append(with_row_counts(found, rows.groupBy("month", "event_type").agg(F.sum("events").alias("events")), ["month", "event_type"]))
    return out[0].unionByName(out[1])


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select("p_brand", "p_type").distinct()


@query("""
SELECT l_suppkey, sum(l_quantity) FILTER (l_returnflag = 'A') AS "flag_A", sum(l_quantity) FILTER (l_returnflag = 'N') AS "flag_N",
       sum(l_quantity) FILTER (l_returnflag = 'R') AS "flag_R"
FROM lineitem GROUP BY 1
""")
def pivot_sums(spark: SparkSession, sf: str) -> DataFrame:
    flagged = read(spark, sf, "lineitem").withColumn("flag", F.concat(F.lit("flag "), "l_returnflag"))
    return pivot_sum(flagged, "l_suppkey", "flag", "l_quantity", ["flag A", "flag N", "flag R"])


@query("""
SELECT doc_id, lang AS "document_lang", 'doc' AS kind, CAST(NULL AS INTEGER) AS quality FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT d.doc_id, lang, 'labelled', quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id
""")
def matched_and_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    documents = read(spark, sf, "documents").select("doc_id", F.col("lang").alias("document lang"))
    found, missing = split_by_match(documents, read(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return clean_names(union_by_name(
        found.withColumn("kind", F.lit("labelled")), missing.withColumn("kind", F.lit("doc"))
    ))


@query("""
SELECT p_partkey, p_brand || '/' || p_type AS joined, split_part(p_name, ' ', 2) AS second,
       CASE WHEN len(string_split(p_name, ' ')) > 2 THEN split_part(p_name, ' ', 3) END AS third,
       ltrim(lpad(CAST(p_size AS VARCHAR), 6, '0'), '0') AS bare, p_type || ':' || p_brand AS collapsed,
       concat_ws('-', p_type, CASE WHEN p_size > 25 THEN 'big' END) AS present, replace(p_brand, '#', ' ') AS spaced,
       TRY_CAST(split_part(p_brand, '#', 2) AS BIGINT) AS number, TRY_CAST(p_name AS BIGINT) AS no_number,
       split_part(p_brand, '#', 1) || '#' || split_part(p_brand, '#', 2) AS prefix,
       p_name LIKE 'blue%' AS is_blue, regexp_matches(p_brand, '[1-3]$') AS low_brand
FROM part
""")
def text_functions(spark: SparkSession, sf: str) -> DataFrame:
    wide = F.concat(F.lit("::"), "p_type", F.lit(":::"), "p_brand", F.lit(":"))
    return read(spark, sf, "part").select(
        "p_partkey", F.concat("p_brand", F.lit("/"), "p_type").alias("joined"), segment("p_name", " ", 1).alias("second"),
        segment("p_name", " ", 2).alias("third"), strip_zeros(F.lpad(F.col("p_size").cast("string"), 6, "0")).alias("bare"),
        collapse_separator(wide).alias("collapsed"),
        join_present("-", "p_type", F.when(F.col("p_size") > 25, "big").otherwise("")).alias("present"),
        F.regexp_replace("p_brand", "#", " ").alias("spaced"), to_long(segment("p_brand", "#", 1)).alias("number"),
        to_long("p_name").alias("no_number"), path_prefix("p_brand", 0, 1, "#").alias("prefix"),
        F.col("p_name").like("blue%").alias("is_blue"), F.col("p_brand").rlike("[1-3]$").alias("low_brand"),
    )


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hour, strftime(ts, '%Y-%m') AS month,
       date_trunc('hour', ts) AS hour_start, timezone('America/Los_Angeles', timezone('UTC', ts)) AS local,
       'W' || weekofyear(ts) || '-' || year(ts) AS week, 'W' || weekofyear(ts) || '-' || isoyear(ts) AS iso_week,
       CASE WHEN isodow(ts) <= 5 THEN 1 ELSE 0 END AS weekday,
       (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 3.6e9 AS hours,
       CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS parsed,
       CASE WHEN strftime(ts, '%Y-%m-%d') = '2024-01-07' THEN '2024-01-08' ELSE strftime(ts, '%Y-%m-%d') END AS corrected,
       ts + INTERVAL 1 DAY AS next_day, ts + INTERVAL 86399 SECOND AS day_end, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events
""")
def time_functions(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(
        "event_id", day_text("ts").alias("day"), hour_text("ts").alias("hour"), month_text("ts").alias("month"),
        plain(hour_of("ts")).alias("hour_start"), local_time("ts").alias("local"), week_label("ts").alias("week"),
        week_label("ts", iso_year=True).alias("iso_week"), weekday_flag("ts").alias("weekday"),
        hours_between(F.lit("2024-01-01 00:00:00"), "ts").alias("hours"),
        plain(parse_time(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))).alias("parsed"),
        correct_dates(F.date_format("ts", "yyyy-MM-dd"), {"2024-01-07": "2024-01-08"}).alias("corrected"),
        shift("ts", days=1).alias("next_day"),
        shift("ts", seconds=86399).alias("day_end"), to_long(json_value("props", "$.k")).alias("k"),
    )


@query("""
SELECT doc_id, string_split(text, ' ')[1] AS first_word,
       CASE WHEN len(string_split(text, ' ')) > 1 THEN string_split(text, ' ')[2] END AS second_word,
       length(text) AS letters
FROM documents
""")
def words_by_position(spark: SparkSession, sf: str) -> DataFrame:
    words = F.split("text", " ")
    return read(spark, sf, "documents").select(
        "doc_id", nth(words, 0).alias("first_word"), nth(words, 1).alias("second_word"),
        F.length("text").cast("bigint").alias("letters"),
    )
