import datetime as dt

from frames import rows
from pyspark.sql import functions as F

from tallyloom.functions import week_label
from tallyloom.operators import capacity, tickets, work
from tallyloom.operators.intervals import build_intervals

D = lambda day, h=0: dt.datetime(2024, 1, day, h)
ISSUE = "ISSUE_KEY string, ISSUE_TYPE_NAME string, PARENT_ISSUE_KEY string, STORYPOINTS double"
LINK = "ISSUE_KEY string, LINKED_ISSUE_KEY string, TYPE string, DIRECTION string"


def issues(spark, *data):
    return spark.createDataFrame(list(data), ISSUE)


def test_hierarchy_takes_the_points_of_the_deepest_level_present(spark):
    df = issues(
        spark, ("R1", "Product Request", None, None), ("R2", "Product Request", None, None), ("R3", "Product Request Old", None, None),
        ("E1", "Epic", None, 5.0), ("E2", "Epic", None, 6.0), ("E3", "Epic", None, 7.0),
        ("S1", "Story", "E1", 3.0), ("S2", "Story", "E1", 2.0),
        ("T1", "Sub-task", "S1", 1.0), ("T2", "Sub-task", "S1", None),
    )
    links = spark.createDataFrame([
        ("R1", "E1", "Depends", "Outward"), ("R1", "E2", "Depends", "Outward"), ("R1", "E3", "Depends", "Inward"),
        ("R3", "E3", "Depends", "Outward"), ("R3", "gone", "Depends", "Outward"), ("E1", "R1", "Depends", "Outward"),
    ], LINK)
    got = work.issue_hierarchy(df, links, "Product Request", [])
    assert rows(got, "ISSUE_KEY", "LINKED_1_ISSUE_KEY", "CHILD_ISSUE_KEY", "SUB_ISSUE_KEY", "TOTAL_STORYPOINTS") == [
        ("R1", "E1", "S1", "T1", 1.0), ("R1", "E1", "S1", "T2", None), ("R1", "E1", "S2", None, 2.0),
        ("R1", "E2", None, None, 6.0), ("R3", "E3", None, None, 7.0), ("R3", "gone", None, None, None),
    ]


def test_ideas_count_with_polaris_links_or_without_any(spark):
    df = issues(spark, ("I1", "Idea", None, None), ("I2", "Idea", None, None), ("I3", "Idea", None, None), ("E", "Epic", None, 4.0))
    links = spark.createDataFrame([("I1", "E", "Polaris issue link", "Inward"), ("I2", "E", "Relates", "Inward")], LINK)
    got = work.issue_hierarchy(df, links, "Idea", [])
    assert rows(got, "ISSUE_KEY", "LINKED_1_ISSUE_KEY", "TOTAL_STORYPOINTS") == [("I1", "E", 4.0), ("I3", None, None)]


def test_milestones_take_the_first_row_of_a_status(spark):
    data = [
        ("IDEA-1", "Delivered", D(5), D(9), "7200"), ("IDEA-1", "Delivered late", D(6), D(8), "1"),
        ("IDEA-1", "Architecture review", D(2), D(3), "1800"), ("IDEA-2", "Backlog", D(1), D(4), "0"), ("X-1", "Backlog", D(1), D(1), "0"),
    ]
    df = spark.createDataFrame(
        data, "ISSUE_KEY string, ISSUE_STATUS_NAME string, FIRST_TRANSITION_TO_STATUS timestamp, "
        "LAST_TRANSITION_TO_STATUS timestamp, DURATION_IN_BUSINESS_DAYS_BH string",
    ).withColumn("DURATION_IN_BUSINESS_DAYS_BH", F.col("DURATION_IN_BUSINESS_DAYS_BH").cast("bigint"))
    got = work.status_milestones(df)
    assert rows(got, "ISSUE_KEY", "DELIVERED_DATE", "BACKLOG_DATE", "PRD_DATE", "ARCHITECTURE_BUSINESS_HOURS_DURATION") == [
        ("IDEA-1", D(9), None, None, 0.5), ("IDEA-2", None, D(4), None, None),
    ]


def test_releases(spark):
    df = spark.createDataFrame([("v1.0",), ("v0.9",), ("x v1",), ("v9 z",)], "VERSION_NAME string")
    assert rows(work.releases(df)) == [("v1.0",), ("v9 z",)]


def test_points_are_spread_over_values(spark):
    tree = spark.createDataFrame([("E1", 6.0), ("E1", 3.0), ("E2", 1.0), ("E3", 1.0)], "LINKED_1_ISSUE_KEY string, SUB_STORYPOINTS double")
    labels = spark.createDataFrame([("E1", "a"), ("E1", "b"), ("E1", "c"), ("E2", "a")], "ISSUE_KEY string, label string")
    got = work.spread_points(tree, labels, "label")
    assert rows(got, "LINKED_1_ISSUE_KEY", "label", "ADJ_SUB_STORYPOINTS") == [
        ("E1", "a", 1.0), ("E1", "a", 2.0), ("E1", "b", 1.0), ("E1", "b", 2.0), ("E1", "c", 1.0), ("E1", "c", 2.0), ("E2", "a", 1.0),
    ]
    assert got.agg(F.sum("ADJ_SUB_STORYPOINTS")).first()[0] == 10.0


def test_work_type_and_last_assignee(spark):
    df = spark.createDataFrame([("Sub-task", "c", "s"), ("Sub-bug", "c", ""), ("Epic", "", None), (None, "c", None)], "k string, c string, s string")
    got = df.select(work.work_type("k").alias("w"), work.last_assignee("c", "s").alias("a"))
    assert [tuple(r) for r in got.collect()] == [("Dev", "s"), ("Bug", "c"), ("Unk", None), ("Unk", "c")]


def test_time_off_counts_weekdays_per_week(spark):
    days = [("ann", dt.date(2024, 12, 27), dt.date(2024, 12, 31)), ("bob", dt.date(2024, 1, 6), dt.date(2024, 1, 7)),
            ("cyd", dt.date(2024, 1, 3), dt.date(2024, 1, 3)), ("dan", dt.date(2024, 1, 3), dt.date(2024, 1, 2))]
    df = spark.createDataFrame(days, "name string, start date, end date")
    assert rows(capacity.weekday_time_off(df)) == [
        ("ann", "W1-2024", 2), ("ann", "W52-2024", 1), ("bob", "W1-2024", 0), ("cyd", "W1-2024", 1),
    ]
    iso = spark.createDataFrame([(dt.date(2024, 12, 30),)], "d date").select(week_label("d"), week_label("d", iso_year=True))
    assert tuple(iso.first()) == ("W1-2024", "W1-2025")


def sprints(spark):
    return spark.createDataFrame([("v2", "active", D(15)), ("v1", "closed", D(1))], "SPRINT_NAME string, STATE string, START_DATE timestamp")


def test_grid_holds_every_resource_in_every_sprint(spark):
    people = spark.createDataFrame([("ann", "QA"), ("bob", "DEV")], "NAME string, AREA string")
    free = spark.createDataFrame([("v1", 2)], "RESOURCE_SPRINT_NAME string, HOLIDAYS bigint")
    off = capacity.time_off_per_sprint(
        spark.createDataFrame([("Anne", "W1-2024", 3), ("Anne", "W2-2024", 1), ("bob", "W9-2024", 5)], "NAME string, YEAR_WEEK string, days bigint"),
        spark.createDataFrame([("W1-2024", "v1"), ("W2-2024", "v1")], "YEAR_WEEK string, RESOURCE_SPRINT_NAME string"),
        ["NAME"], "PTO", {"Anne": "ann"},
    )
    got = capacity.capacity_grid(people, sprints(spark), free, off)
    assert rows(got, "NAME", "AREA", "RESOURCE_SPRINT_NAME", "RESOURCE_STATE_SPRINT_NAME", "HOLIDAYS", "PTO") == [
        ("ann", "QA", "v1", "closed", 2, 4), ("ann", "QA", "v2", "active", 0, 0),
        ("bob", "DEV", "v1", "closed", 2, 0), ("bob", "DEV", "v2", "active", 0, 0),
    ]
    assert "CartesianProduct" not in got._jdf.queryExecution().toString() and "NestedLoop" not in got._jdf.queryExecution().toString()


def test_utilisation_shows_logs_once_and_idle_seats(spark):
    logs = spark.createDataFrame([
        ("T1", "Sub-task", "ann", D(2), 10), ("S2", "Bug", "ann", D(20), 20), ("TICKET-9", "Task", "bob", D(2), 30),
        ("CM-1", "Task", "bob", D(3), 40), ("Z-1", "Epic", None, D(3), 50), ("S1", "Improvement", "bob", D(4), 60),
    ], "ISSUE_KEY_LOGGED string, ISSUE_TYPE_NAME_LOGGED string, UPDATE_NAME string, START_DATE timestamp, LOGGED_TIME bigint")
    # S1 has the sub T1, S2 has none: only S2 can be matched as a child
    tree = spark.createDataFrame([("I1", "S1", "T1"), ("I1", "S2", None)], "ISSUE_KEY string, CHILD_ISSUE_KEY string, SUB_ISSUE_KEY string")
    grid = spark.createDataFrame(
        [("ann", "v1", 1), ("bob", "v1", 0), ("cyd", "v1", 0)], "NAME string, RESOURCE_SPRINT_NAME string, PTO int")
    ends = spark.createDataFrame([(D(10), "v1"), (D(19), "v2")], "END_DATE timestamp, SPRINT_NAME string")
    calendar = build_intervals(ends, "END_DATE", "SPRINT_NAME", numbered=False)
    got = capacity.utilisation(logs, tree, grid, calendar, ["ISSUE_KEY"])
    assert rows(got, "ISSUE_KEY_LOGGED", "UPDATE_NAME", "SPRINT_ASSIGNED", "ISSUE_KEY", "UTILIZATION_TYPE", "WORKLOG_TYPE", "PTO") == [
        ("CM-1", "bob", "v1", None, "Operational", "Infra", 0),
        ("S1", "bob", "v1", None, "Operational", "Task", 0),
        ("S2", "ann", None, "I1", "Idea", "Bug", None),
        ("T1", "ann", "v1", "I1", "Idea", "Dev", 1),
        ("TICKET-9", "bob", "v1", None, "Incident", "Support", 0),
        ("Z-1", "Unknown", "v1", None, "Operational", "Unk", None),
        (None, "cyd", "v1", None, None, None, 0),
    ]


def test_kinds_of_work_are_parameters(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    logs = spark.createDataFrame([("OPS-1", "Chore", "ann", day(2)), ("TICKET-1", "Chore", "ann", day(2)), ("X-1", "Chore", "ann", day(2))],
                                 "ISSUE_KEY_LOGGED string, ISSUE_TYPE_NAME_LOGGED string, UPDATE_NAME string, START_DATE timestamp")
    tree = spark.createDataFrame([], "ISSUE_KEY string, CHILD_ISSUE_KEY string, SUB_ISSUE_KEY string")
    calendar = build_intervals(spark.createDataFrame([(day(9), "v1")], "at timestamp, name string"), "at", "name", numbered=False)
    grid = spark.createDataFrame([("ann", "v1", 0)], "NAME string, RESOURCE_SPRINT_NAME string, PTO int")
    got = capacity.utilisation(
        logs, tree, grid, calendar, ["ISSUE_KEY"], incidents=["OPS"], operational=[("Home", ("Chore",), ("X",)), ("Any", ("Errand",), ())])
    assert rows(got, "ISSUE_KEY_LOGGED", "UTILIZATION_TYPE", "WORKLOG_TYPE") == [
        ("OPS-1", "Incident", "Support"), ("TICKET-1", "Operational", "Unk"), ("X-1", "Operational", "Home")]


def test_tickets(spark):
    df = spark.createDataFrame([
        ("TICKET-1", "RED Zuberel printer", D(1), D(2), D(1, 6)), ("TICKET-2", "nothing", D(1), None, None), ("A-1", "RED", D(1), D(1), D(1)),
    ], "ISSUE_KEY string, SUMMARY string, CREATED timestamp, RESOLUTION_DATE timestamp, FIRST_RESPONSE_DATE timestamp")
    facts = tickets.ticket_facts(df, [("RED", "R"), ("Zuberel", "H")])
    assert rows(facts, "ISSUE_KEY", "TENANT", "HOURS_TO_RESOLVED", "HOURS_TO_FIRST_RESPONSE") == [
        ("TICKET-1", "H", 24.0, 6.0), ("TICKET-2", None, None, None),
    ]
    logs = spark.createDataFrame([("TICKET-1", 1800), ("TICKET-7", 3600), ("A-1", 1)], "ISSUE_KEY string, LOGGED_TIME bigint")
    assert rows(tickets.ticket_worklogs(logs, facts, ["TENANT"]), "ISSUE_KEY", "LOGGED_HOURS", "TENANT") == [
        ("TICKET-1", 0.5, "H"), ("TICKET-7", 1.0, None),
    ]
    spent = spark.createDataFrame([("TICKET-1", "In Progress", "3600"), ("TICKET-1", "In Progress", "1800"), ("TICKET-1", "Done", "x"),
                                   ("A-1", "Done", "5")], "ISSUE_KEY string, ISSUE_STATUS_NAME string, DURATION_IN_BUSINESS_DAYS_BH string")
    got = tickets.ticket_time_in_status(spent, ["In Progress", "Done"])
    assert got.columns == ["ISSUE_KEY", "In_Progress", "Done"] and rows(got) == [("TICKET-1", 1.5, None)]
