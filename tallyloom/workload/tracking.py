"""Work tracking over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import case_first
from tallyloom.operators.aggregate import delimited_values
from tallyloom.operators.capacity import capacity_grid, utilisation, weekday_time_off
from tallyloom.operators.intervals import assign_interval, build_intervals
from tallyloom.operators.overlaps import assign_latest
from tallyloom.operators.tickets import ticket_facts, ticket_time_in_status, ticket_worklogs
from tallyloom.operators.work import (
    deepest_present, issue_hierarchy, issue_wide, spread_points, status_milestones, work_type,
)
from tallyloom.session import settle
from tallyloom.workload.registry import query
from tallyloom.workload.standins import QUARTERS, k, quarters, read, units


def key(prefix: str, *columns: str):
    parts = [F.lit(prefix)]
    for n, c in enumerate(columns):
        parts += ([F.lit("-")] if n else []) + [F.col(c).cast("string")]
    return F.concat(*parts)


# -- labels, milestones, wide rows -----------------------------------------------------------------------------------


@query("""
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ':') AS priorities FROM orders GROUP BY 1
""", name="delimited_values")
def label_lists(spark: SparkSession, sf: str) -> DataFrame:
    return delimited_values(read(spark, sf, "orders"), "o_custkey", "o_orderpriority", "priorities")


MILESTONES = (
    ("signed", "signup", "time"), ("bought", "purchase", "time"), ("bought_value", "purchase", "value"),
    ("failed", "err", "time"),
)


@query("""
SELECT 'U' || user_id AS "ISSUE_KEY", min(ts) FILTER (event_type = 'signup') AS signed,
       min(ts) FILTER (event_type = 'purchase') AS bought,
       arg_min(value, (ts, event_id)) FILTER (event_type = 'purchase') AS bought_value,
       min(ts) FILTER (event_type LIKE '%err%') AS failed
FROM events GROUP BY 1
""")
def milestones(spark: SparkSession, sf: str) -> DataFrame:
    history = read(spark, sf, "events").select(
        key("U", "user_id").alias("ISSUE_KEY"), F.col("event_type").alias("ISSUE_STATUS_NAME"),
        F.col("ts").alias("time"), "event_id", "value",
    )
    return status_milestones(history, MILESTONES, order=("time", "event_id"), prefix="U")


@query("""
WITH last AS (
  SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS k FROM orders GROUP BY 1
), labels AS (
  SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ':') AS priorities,
         array_to_string(list_sort(list(DISTINCT o_orderstatus)), ':') AS statuses
  FROM orders GROUP BY 1
), m AS (
  SELECT user_id, min(ts) FILTER (event_type = 'signup') AS signed, min(ts) FILTER (event_type = 'purchase') AS bought,
         min(ts) FILTER (event_type LIKE '%err%') AS failed
  FROM events GROUP BY 1
)
SELECT 'U' || c_custkey AS "ISSUE_KEY", c_mktsegment, k AS "SPRINT_ID", o_orderstatus AS "STATE", o_orderdate AS "START_DATE",
       priorities, statuses, signed, bought, failed
FROM customer LEFT JOIN last ON c_custkey = last.o_custkey LEFT JOIN orders o ON o.o_orderkey = k
     LEFT JOIN labels ON labels.o_custkey = c_custkey LEFT JOIN m ON user_id = c_custkey
""")
def issue_rows(spark: SparkSession, sf: str) -> DataFrame:
    customers, orders, events = (read(spark, sf, t) for t in ("customer", "orders", "events"))
    issues = customers.select(key("U", "c_custkey").alias("ISSUE_KEY"), "c_mktsegment")
    of_customer = key("U", "o_custkey").alias("ISSUE_KEY")
    # Sprint numbers rise with the date here, so that the greatest number is the latest.
    number = F.struct("o_orderdate", "o_orderkey")
    sprints = orders.select(
        number.alias("SPRINT_ID"), F.col("o_orderkey").alias("SPRINT_NAME"), F.col("o_orderstatus").alias("STATE"),
        F.col("o_orderdate").alias("START_DATE"),
    )
    assigned = orders.select(of_customer, number.alias("SPRINT_ID"), F.col("o_orderkey").alias("SPRINT_NAME"))
    history = events.select(
        key("U", "user_id").alias("ISSUE_KEY"), F.col("event_type").alias("ISSUE_STATUS_NAME"),
        F.col("ts").alias("time"), "event_id",
    )
    marks = status_milestones(history, [m for m in MILESTONES if m[2] == "time"], order=("time", "event_id"), prefix="U")
    labels = {
        "priorities": (orders.select(of_customer, "o_orderpriority"), "o_orderpriority"),
        "statuses": (orders.select(of_customer, "o_orderstatus"), "o_orderstatus"),
    }
    wide = issue_wide(issues, assigned, sprints, labels, marks)
    return wide.select(
        "ISSUE_KEY", "c_mktsegment", F.col("SPRINT_NAME").alias("SPRINT_ID"), "STATE", "START_DATE", "priorities",
        "statuses", "signed", "bought", "failed",
    )


# -- hierarchy -------------------------------------------------------------------------------------------------------


def order_issues(spark: SparkSession, sf: str, root: str) -> DataFrame:
    """Nations, customers, orders and lines as issues: root, linked, child, sub."""
    nation, customer, orders, line = (read(spark, sf, t) for t in ("nation", "customer", "orders", "lineitem"))

    def issue(df, ident, parent, kind, points):
        return df.select(
            ident.alias("ISSUE_KEY"), parent.cast("string").alias("PARENT_ISSUE_KEY"), F.lit(kind).alias("ISSUE_TYPE_NAME"),
            points.cast("double").alias("STORYPOINTS"),
        )

    finished = F.when(F.col("l_returnflag") != "N", units("l_extendedprice", 100))
    parent = F.when(F.col("l_linestatus") == "F", key("O", "l_orderkey"))  # open lines are issues that belong nowhere yet
    return (
        issue(nation, key("N", "n_nationkey"), F.lit(None), root, F.lit(None))
        .unionAll(issue(customer, key("C", "c_custkey"), F.lit(None), "Epic", units("c_acctbal", 100)))
        .unionAll(issue(orders, key("O", "o_orderkey"), key("C", "o_custkey"), "Story", units("o_totalprice", 100)))
        .unionAll(issue(line, key("L", "l_orderkey", "l_partkey", "l_suppkey"), parent, "Sub-task", finished))
    )


def nation_links(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Customers with a positive balance are linked to their nation; the others only loosely."""
    return read(spark, sf, "customer").select(
        key("N", "c_nationkey").alias("ISSUE_KEY"), key("C", "c_custkey").alias("LINKED_ISSUE_KEY"),
        F.when(F.col("c_acctbal") >= 0, kind).otherwise("Relates").alias("TYPE"), F.lit("Outward").alias("DIRECTION"),
    )


HIERARCHY = """WITH sub AS (
  SELECT DISTINCT 'L' || l_orderkey || '-' || l_partkey || '-' || l_suppkey AS sub, 'O' || l_orderkey AS child,
         CASE WHEN l_returnflag <> 'N' THEN round(l_extendedprice * 100) END AS points
  FROM lineitem WHERE l_linestatus = 'F'
)
SELECT 'N' || c_nationkey AS "ISSUE_KEY", 'C' || c_custkey AS "LINKED_1_ISSUE_KEY", 'O' || o_orderkey AS "CHILD_ISSUE_KEY",
       sub AS "SUB_ISSUE_KEY",
       CASE WHEN sub IS NOT NULL THEN sub.points WHEN o_orderkey IS NOT NULL THEN round(o_totalprice * 100)
            ELSE round(c_acctbal * 100) END AS "TOTAL_STORYPOINTS"
FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN sub ON sub.child = 'O' || o_orderkey
WHERE c_acctbal >= 0"""
TREE = ("ISSUE_KEY", "LINKED_1_ISSUE_KEY", "CHILD_ISSUE_KEY", "SUB_ISSUE_KEY", "TOTAL_STORYPOINTS")


@query(HIERARCHY, name="issue_hierarchy")
def request_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    issues = order_issues(spark, sf, "Product Request")
    return issue_hierarchy(issues, nation_links(spark, sf, "Depends"), "Product Request", []).select(*TREE)


@query(HIERARCHY + """
UNION ALL
SELECT 'N' || n_nationkey, NULL, NULL, NULL, NULL FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)
""")
def idea_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    issues = order_issues(spark, sf, "Idea")
    return issue_hierarchy(issues, nation_links(spark, sf, "Polaris issue link"), "Idea", []).select(*TREE)


@query("""
WITH n AS (SELECT o_custkey, count(o_orderpriority) AS n FROM orders GROUP BY 1)
SELECT c_custkey, o.o_orderpriority AS label, round(c_acctbal * 100) AS points, round(c_acctbal * 100) / n AS part
FROM customer c JOIN orders o ON o.o_custkey = c_custkey JOIN n ON n.o_custkey = c_custkey
""", name="spread_points")
def points_by_label(spark: SparkSession, sf: str) -> DataFrame:
    """Points of a customer in equal parts to the labels of its orders."""
    tree = read(spark, sf, "customer").select(
        "c_custkey", key("C", "c_custkey").alias("LINKED_1_ISSUE_KEY"), units("c_acctbal", 100).alias("SUB_STORYPOINTS")
    )
    labels = read(spark, sf, "orders").select(
        key("C", "o_custkey").alias("ISSUE_KEY"), F.col("o_orderpriority").alias("label")
    )
    spread = spread_points(tree, labels, "label")
    return spread.select("c_custkey", "label", F.col("SUB_STORYPOINTS").alias("points"), F.col("ADJ_SUB_STORYPOINTS").alias("part"))


@query("""
SELECT p_partkey, CASE WHEN p_name LIKE '%bolt' THEN 'Dev' WHEN p_name LIKE '%ring' THEN 'Bug' WHEN p_name LIKE '%rod' THEN 'Task'
  WHEN p_name LIKE '%gear' THEN 'Infra' WHEN p_name LIKE '%plate' THEN 'Doc' ELSE 'Unk' END AS work_type,
  CASE WHEN p_type = 'PROMO' THEN p_size WHEN p_brand LIKE '%1' THEN NULL ELSE p_size * 2 END AS points
FROM part
""")
def work_types(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part")
    name = F.col("p_name")
    kind = case_first([
        (name.endswith("bolt"), "Sub-task"), (name.endswith("ring"), "Sub-bug"), (name.endswith("rod"), "Sub-Design"),
        (name.endswith("gear"), "Sub-CloudOps"), (name.endswith("plate"), "Doc"),
    ], "Epic")
    sub = F.when(F.col("p_type") == "PROMO", F.col("p_name"))
    child = F.when(F.col("p_brand").endswith("1"), F.col("p_name"))
    points = deepest_present([
        (sub, F.col("p_size")), (child, F.lit(None).cast("int")), (F.col("p_name"), F.col("p_size") * 2)
    ])
    return part.select("p_partkey", work_type(kind).alias("work_type"), points.alias("points"))


# -- intervals -------------------------------------------------------------------------------------------------------


def _placed(spark: SparkSession, sf: str, closed: bool) -> DataFrame:
    calendar = build_intervals(quarters(spark, sf), "boundary", "name")
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return assign_interval(orders, calendar, "o_orderdate", "release", closed=closed).select("o_orderkey", "release")


def _placed_sql(condition: str) -> str:
    return f"""
WITH {QUARTERS}
SELECT o_orderkey, arg_max(lpad(CAST(ord AS VARCHAR), 2, '0') || ' ' || name, ord) AS release
FROM orders LEFT JOIN cal ON (s IS NULL OR o_orderdate >= s) AND {condition} GROUP BY 1
"""


@query(_placed_sql("o_orderdate <= e"))
def interval_closed(spark: SparkSession, sf: str) -> DataFrame:
    return _placed(spark, sf, closed=True)


@query(_placed_sql("o_orderdate < e"), name="interval_halfopen")
def interval_half_open(spark: SparkSession, sf: str) -> DataFrame:
    return _placed(spark, sf, closed=False)


def _campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """Every purchase opens a campaign for as many hours as it is worth; campaigns nest and cross. Users' lists follow each other."""
    sales = read(spark, sf, "events").where(F.col("event_type") == "purchase")
    hours = F.make_dt_interval(hours=F.floor("value").cast("int"))
    return sales.select(F.col("ts").alias("start"), (F.col("ts") + hours).alias("end"), "user_id", "event_id", key("C", "event_id").alias("campaign"))


def _campaign_of(spark: SparkSession, sf: str, closed: bool) -> DataFrame:
    """The campaign every event falls in, the last one of the list where there are several; a campaign's own purchase is one too."""
    facts = read(spark, sf, "events").select("event_id", "event_type", "ts")
    return assign_latest(facts, _campaigns(spark, sf), "ts", ["user_id", "event_id"], ["campaign"], closed=closed)


def _campaign_sql(condition: str) -> str:
    return f"""
WITH c AS (
  SELECT ts AS s, ts + to_hours(CAST(floor(value) AS INTEGER)) AS e, user_id, event_id AS id FROM events WHERE event_type = 'purchase')
SELECT f.event_id, f.event_type, f.ts, 'C' || arg_max(id, (c.user_id, c.id)) AS campaign
FROM events f LEFT JOIN c ON f.ts >= s AND {condition} GROUP BY 1, 2, 3
"""


@query(_campaign_sql("f.ts <= e"))
def interval_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    return _campaign_of(spark, sf, closed=True)


@query(_campaign_sql("f.ts < e"))
def interval_overlaps_halfopen(spark: SparkSession, sf: str) -> DataFrame:
    return _campaign_of(spark, sf, closed=False)


# -- capacity --------------------------------------------------------------------------------------------------------


def absences(spark: SparkSession, sf: str) -> DataFrame:
    """Every order keeps its customer away from the order date on, for as many days as its priority says."""
    days = F.substring("o_orderpriority", 1, 1).cast("int")
    return read(spark, sf, "orders").select(
        key("C", "o_custkey").alias("name"), F.to_date("o_orderdate").alias("start"),
        F.date_add("o_orderdate", days - 1).alias("end"),
    )


def _time_off_sql(year: str) -> str:
    return f"""
WITH d AS (
  SELECT 'C' || o_custkey AS name, unnest(generate_series(o_orderdate, o_orderdate + to_days(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1), INTERVAL 1 DAY)) AS day
  FROM orders
)
SELECT name AS "NAME", 'W' || weekofyear(day) || '-' || {year}(day) AS "YEAR_WEEK",
       sum(CASE WHEN isodow(day) <= 5 THEN 1 ELSE 0 END)::BIGINT AS days
FROM d GROUP BY 1, 2
"""


@query(_time_off_sql("year"), name="weekday_time_off")
def time_off_weeks(spark: SparkSession, sf: str) -> DataFrame:
    return weekday_time_off(absences(spark, sf))


@query(_time_off_sql("isoyear"))
def time_off_iso_weeks(spark: SparkSession, sf: str) -> DataFrame:
    return weekday_time_off(absences(spark, sf), iso_year=True)


def sprint_table(spark: SparkSession, sf: str) -> DataFrame:
    return quarters(spark, sf).select(
        F.col("name").alias("SPRINT_NAME"), F.col("boundary").alias("START_DATE"),
        F.when(F.year("boundary") < 2000, "closed").otherwise("active").alias("STATE"),
    )


def seats(spark: SparkSession, sf: str) -> DataFrame:
    suppliers, line, orders = (read(spark, sf, t) for t in ("supplier", "lineitem", "orders"))

    def quarter(day: str):
        return F.concat(F.lit("v"), F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))

    names = suppliers.select(F.col("s_suppkey"), F.col("s_name").alias("NAME"))
    off = line.where(F.col("l_returnflag") == "R").groupBy("l_suppkey", quarter("l_shipdate").alias("RESOURCE_SPRINT_NAME"))
    off = off.agg(F.count_distinct("l_shipdate").alias("PTO")).join(names, F.col("l_suppkey") == F.col("s_suppkey"))
    free = orders.where(F.col("o_orderpriority") == "1-URGENT").groupBy(quarter("o_orderdate").alias("RESOURCE_SPRINT_NAME"))
    free = free.agg(F.count_distinct("o_orderdate").alias("HOLIDAYS")).where(F.col("HOLIDAYS") > 5)
    # Sprints and holidays are lists; here they are derived from the orders, so derive them once.
    return capacity_grid(
        names.drop("s_suppkey"), settle(sprint_table(spark, sf)), settle(free), off.select("NAME", "RESOURCE_SPRINT_NAME", "PTO")
    )


SEATS = f"""{QUARTERS}, off AS (
  SELECT s_name, 'v' || year(l_shipdate) || 'Q' || quarter(l_shipdate) AS q, count(DISTINCT l_shipdate) AS n
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R' GROUP BY 1, 2
), free AS (
  SELECT 'v' || year(o_orderdate) || 'Q' || quarter(o_orderdate) AS q, count(DISTINCT o_orderdate) AS n
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1 HAVING count(DISTINCT o_orderdate) > 5
), seats AS (
  SELECT supplier.s_name AS name, cal.name AS sprint, CASE WHEN year(e) < 2000 THEN 'closed' ELSE 'active' END AS state,
         coalesce(free.n, 0)::INTEGER AS holidays, coalesce(off.n, 0)::INTEGER AS pto
  FROM supplier CROSS JOIN cal LEFT JOIN free ON free.q = cal.name
       LEFT JOIN off ON off.s_name = supplier.s_name AND off.q = cal.name
)"""


@query(f"""
WITH {SEATS}
SELECT name AS "NAME", sprint AS "RESOURCE_SPRINT_NAME", state AS "RESOURCE_STATE_SPRINT_NAME", holidays AS "HOLIDAYS", pto AS "PTO"
FROM seats
""", name="capacity_grid")
def capacity(spark: SparkSession, sf: str) -> DataFrame:
    return seats(spark, sf)


@query(f"""
WITH {SEATS}, logs AS (
  SELECT CASE l_returnflag WHEN 'R' THEN 'TICKET-' || l_orderkey WHEN 'A' THEN 'S' || l_orderkey ELSE 'O' || l_orderkey END AS logged,
         CASE WHEN p_name LIKE '%bolt' THEN 'Sub-task' WHEN p_name LIKE '%ring' THEN 'Bug' WHEN p_name LIKE '%rod' THEN 'Test'
              WHEN p_name LIKE '%gear' THEN 'Troubleshooting' ELSE 'Epic' END AS kind,
         s_name AS person, l_shipdate AS day, l_quantity * 3600 AS seconds
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
), matched AS (
  SELECT logs.*, coalesce(c.o_custkey, s.o_custkey) AS root
  FROM logs LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'F') c ON logged = 'O' || c.o_orderkey
       LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') s ON logged = 'S' || s.o_orderkey
), typed AS (
  SELECT *, CASE WHEN kind = 'Troubleshooting' OR logged LIKE 'TICKET%' THEN 'Incident' WHEN root IS NULL THEN 'Operational'
                 ELSE 'Idea' END AS use
  FROM matched
), placed AS (
  SELECT typed.*, cal.name AS sprint,
         CASE WHEN use = 'Incident' THEN 'Support' WHEN kind = 'Bug' THEN 'Bug'
              WHEN use = 'Idea' AND kind = 'Sub-task' THEN 'Dev' WHEN use = 'Idea' AND kind = 'Test' THEN 'Task'
              WHEN use = 'Operational' AND kind = 'Test' THEN 'Dev' WHEN use = 'Operational' AND kind = 'Sub-task' THEN 'Task'
              ELSE 'Unk' END AS work
  FROM typed LEFT JOIN cal ON (s IS NULL OR day >= s) AND day < e
)
SELECT coalesce(person, name, 'Unknown') AS "UPDATE_NAME", coalesce(placed.sprint, seats.sprint) AS "SPRINT_ASSIGNED",
       use AS "UTILIZATION_TYPE", work AS "WORKLOG_TYPE", count(logged) AS logs, sum(seconds) AS seconds, max(holidays) AS holidays,
       max(pto) AS pto
FROM placed FULL JOIN seats ON person = name AND placed.sprint = seats.sprint
GROUP BY 1, 2, 3, 4
""", name="utilisation")
def utilisation_by_sprint(spark: SparkSession, sf: str) -> DataFrame:
    line, part, supplier, orders = (read(spark, sf, t) for t in ("lineitem", "part", "supplier", "orders"))
    name = F.col("p_name")
    rows = line.join(part, line.l_partkey == part.p_partkey, "left").join(supplier, line.l_suppkey == supplier.s_suppkey, "left")
    logs = rows.select(
        case_first([
            (F.col("l_returnflag") == "R", key("TICKET-", "l_orderkey")), (F.col("l_returnflag") == "A", key("S", "l_orderkey")),
        ], key("O", "l_orderkey")).alias("ISSUE_KEY_LOGGED"),
        case_first([
            (name.endswith("bolt"), "Sub-task"), (name.endswith("ring"), "Bug"), (name.endswith("rod"), "Test"),
            (name.endswith("gear"), "Troubleshooting"),
        ], "Epic").alias("ISSUE_TYPE_NAME_LOGGED"),
        F.col("s_name").alias("UPDATE_NAME"), F.col("l_shipdate").alias("START_DATE"),
        (F.col("l_quantity") * 3600).alias("LOGGED_TIME"),
    )
    done = F.col("o_orderstatus") == "F"
    tree = orders.select(
        key("C", "o_custkey").alias("ISSUE_KEY"), key("O", "o_orderkey").alias("CHILD_ISSUE_KEY"),
        F.when(done, key("S", "o_orderkey")).alias("SUB_ISSUE_KEY"),
    )
    calendar = build_intervals(sprint_table(spark, sf), "START_DATE", "SPRINT_NAME", numbered=False)
    used = utilisation(logs, tree, seats(spark, sf), calendar, ["ISSUE_KEY"])
    return used.groupBy("UPDATE_NAME", "SPRINT_ASSIGNED", "UTILIZATION_TYPE", "WORKLOG_TYPE").agg(
        F.count("ISSUE_KEY_LOGGED").alias("logs"), F.sum("LOGGED_TIME").alias("seconds"),
        F.max("HOLIDAYS").alias("holidays"), F.max("PTO").alias("pto"),
    )


# -- tickets ---------------------------------------------------------------------------------------------------------

KEYWORDS = (("the", "ALPHA"), ("Einen", "BETA"), ("The", "BETA"), ("que", "GAMMA"), ("ung", "DELTA"), ("@", "EPSILON"))
TAG = """CASE WHEN contains(text, '@') THEN 'EPSILON' WHEN contains(text, 'ung') THEN 'DELTA'
            WHEN contains(text, 'que') THEN 'GAMMA' WHEN contains(text, 'The') THEN 'BETA' WHEN contains(text, 'Einen') THEN 'BETA'
            WHEN contains(text, 'the') THEN 'ALPHA' END"""


def document_tickets(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    rows = documents.join(labels.select("doc_id", "quality"), "doc_id", "left")
    return rows.select(
        F.when(F.col("lang").isin("en", "de"), key("TICKET-", "doc_id")).otherwise(key("TASK-", "doc_id")).alias("ISSUE_KEY"),
        F.col("text").alias("SUMMARY"), F.col("source").alias("ISSUE_TYPE_NAME"), start.alias("CREATED"),
        F.when(F.col("quality") == 1, start + F.make_dt_interval(mins=F.col("n_chars").cast("int"))).alias("RESOLUTION_DATE"),
        F.when(F.col("quality").isNotNull(), start + F.make_dt_interval(hours=F.col("quality") + 1)).alias("FIRST_RESPONSE_DATE"),
    )


@query(f"""
SELECT 'TICKET-' || d.doc_id AS "ISSUE_KEY", {TAG} AS "TENANT",
       CASE WHEN quality = 1 THEN n_chars * 6e7 / 3.6e9 END AS "HOURS_TO_RESOLVED", (quality + 1) * 1.0::DOUBLE AS "HOURS_TO_FIRST_RESPONSE"
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE lang IN ('en', 'de')
""", name="ticket_facts")
def ticket_rows(spark: SparkSession, sf: str) -> DataFrame:
    facts = ticket_facts(document_tickets(spark, sf), KEYWORDS)
    return facts.select("ISSUE_KEY", "TENANT", "HOURS_TO_RESOLVED", "HOURS_TO_FIRST_RESPONSE")


@query(f"""
WITH t AS (SELECT 'TICKET-' || doc_id AS ticket, source, {TAG} AS tenant FROM documents WHERE lang IN ('en', 'de'))
SELECT 'TICKET-' || conv_id AS "ISSUE_KEY", turn, length(text) / 3600.0::DOUBLE AS "LOGGED_HOURS", source AS "ISSUE_TYPE_NAME",
       tenant AS "TENANT"
FROM conversations LEFT JOIN t ON ticket = 'TICKET-' || conv_id
""")
def ticket_logs(spark: SparkSession, sf: str) -> DataFrame:
    logs = read(spark, sf, "conversations").select(
        key("TICKET-", "conv_id").alias("ISSUE_KEY"), "turn", F.length("text").alias("LOGGED_TIME")
    )
    facts = ticket_facts(document_tickets(spark, sf), KEYWORDS)
    return ticket_worklogs(logs, facts, ["ISSUE_TYPE_NAME", "TENANT"]).drop("LOGGED_TIME")


STATUSES = ("click now", "error now", "purchase now", "signup now", "view now")


@query("""
SELECT 'TICKET-' || user_id AS "ISSUE_KEY", {sums} FROM events GROUP BY 1
""".format(sums=", ".join(
    f"sum(CAST(json_extract(props, '$.k') AS BIGINT) * 3600 / 3600.0::DOUBLE) FILTER (event_type = '{s.split()[0]}') AS \"{s.replace(' ', '_')}\""
    for s in STATUSES
)), name="status_pivot")
def ticket_statuses(spark: SparkSession, sf: str) -> DataFrame:
    history = read(spark, sf, "events").select(
        key("TICKET-", "user_id").alias("ISSUE_KEY"), F.concat("event_type", F.lit(" now")).alias("ISSUE_STATUS_NAME"),
        (k() * 3600).cast("string").alias("DURATION_IN_BUSINESS_DAYS_BH"),
    )
    return ticket_time_in_status(history, STATUSES)
