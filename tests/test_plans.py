"""The jobs from input tables to outputs."""

import datetime as dt

from frames import rows
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators.billing import project_cost_summary
from tallyloom.operators.events import route_together
from tallyloom.operators.rules import rules_schema
from tallyloom.plans import cost_jobs, event_job, work_job
from tallyloom.plans import fixed_values as fixed
from tallyloom.sinks import conform

T = dt.datetime(2024, 1, 2, 10, 20)
def routes():
    return fixed.event_routes(["LISTED"], ["LISTED", "MOBILE"], ["", "APP"], ["READER"], ["SERVICES"])


def inputs(spark):
    headers = spark.createDataFrame([
        ("1", "s1", "ten", "ITEM", "APP", "/x/MOBILE", T), ("2", "s2", "ten", "SOH", "z", "/x/FEED", T),
        ("3", "a-b-c-L1", "ten", "CONTENT", "SERVICES", "/SERVICES", T), ("4", "s4", "ten", "STORE", "", "/x/ALEB_0042", T),
        ("4", "s4", "ten", "STORE", "", "/x/ALEB_0042", T), ("5", "s5", "ten", "NEW", "", "/x/OTHER", T),
        ("6", "s6", "ten", "ITEM", "POE_IINTERFACE", "/x/Y", T), ("7", "s7", "ten", "EPCISEVENT", "EPCIS", "/x/EPCIS", T),
    ], schemas.EVENT_HEADER)
    attributes = spark.createDataFrame([
        ("1", "s1", "source", "MOBILE", T), ("2", "s2", "Retail_SOHStoreNumber", "00017", T), ("3", "a-b-c-L1", "transactionId", "unlink", T),
        ("6", "s6", "source", "FLOW_ALE", T), ("6", "s6", "doorEvent", "a/b/c", T),
        ("7", "s7", "source", "LISTED", T), ("7", "s7", "Retail_Premise", "0009", T),
    ], schemas.EVENT_ATTRIBUTE)
    reference = spark.createDataFrame([("L1", "ten", "bizLocation", "biz", "0012", T), ("L1", "ten", "other", "biz", "0", T)], schemas.REFERENCE_LIST)
    content = ("CONTENT", "SERVICES", "SERVICES", "N/A", "N/A", "N/A")
    rules = spark.createDataFrame(
        [("FeatureSet", 1, *content, "unlink", None, "SUPPLY CHAIN"), ("FeatureSet", 2, *content, None, "unlink", "OTHER"),
         ("Is_InternalEvent", 1, *content, None, None, "0")],
        rules_schema(fixed.RULE_KEYS, ["transactionId_is", "transactionId_not"]),
    )
    return headers, attributes, reference, rules


EXPECTED = [  # thingType, EventSource, StoreCode, FeatureSet, Is_InternalEvent
    ("CONTENT", "SERVICES", "12", "SUPPLY CHAIN", "0"), ("EPCISEVENT", "LISTED", "9", "N/A", "N/A"), ("ITEM", "FLOW_ALE", "c", "N/A", "N/A"),
    ("ITEM", "MOBILE", "", "N/A", "N/A"), ("NEW", "N/A", "N/A", "N/A", "N/A"), ("SOH", "FEED", "17", "N/A", "N/A"),
    ("STORE", "ALEB", "0042", "N/A", "N/A"), ("STORE", "ALEB", "0042", "N/A", "N/A"),
]


def test_an_item_may_have_a_source_and_no_store(spark):
    both = fixed.event_routes([], ["LISTED", "REPORTS"], [], [], [], ["LISTED", "STORED"])
    columns = ["Retail_Premise", "premise_from_fixture", "Retail_SOHStoreNumber", "premise_from_biz", "doorEvent", "zone", "Retail_StoreNumber",
               "sourceModule", "Retail_Bizstep"]
    df = spark.createDataFrame([("ITEM", "EPCIS", "EPCIS", s) for s in ("LISTED", "REPORTS", "STORED", "OTHER")], "thingType string, specName string, bridgeKey_2 string, source string")
    got = route_together(df.withColumns({c: F.lit("07") for c in columns}), ["EventSource", "StoreCode"], both)
    assert rows(got, "source", "EventSource", "StoreCode") == [
        ("LISTED", "LISTED", "7"), ("OTHER", "N/A", "N/A"), ("REPORTS", "REPORTS", "N/A"), ("STORED", "N/A", "7")]


def test_classification_of_a_day(spark):
    got = event_job.classified_events(*inputs(spark), routes())
    assert rows(got, "thingType", "EventSource", "StoreCode", "FeatureSet", "Is_InternalEvent") == EXPECTED
    assert {r.datetime_h for r in got.collect()} == {dt.datetime(2024, 1, 2, 10)}


def test_counts_are_written_once_however_often_the_job_runs(spark, tmp_path):
    classified = event_job.classified_events(*inputs(spark), routes())
    counted = spark.createDataFrame([(dt.datetime(2024, 1, 2, 9), "ten", "SOHSTREAM", 7)], "datetime_h timestamp, tenantCode string, thingType string, count bigint")
    paths = {n: str(tmp_path / n) for n in event_job.SETS}
    for _ in range(2):
        assert event_job.write_counts(classified, counted, paths, "one", "2024-01-02") == dict.fromkeys(event_job.SETS, "ok")
    wide = spark.read.parquet(paths["events_classification"])
    assert rows(wide, "thingType", "event_count") == [
        ("CONTENT", 1), ("EPCISEVENT", 1), ("ITEM", 1), ("ITEM", 1), ("NEW", 1), ("SOH", 1), ("SOHSTREAM", 7), ("STORE", 2),
    ]
    serial = spark.read.parquet(paths["serialNumber_classification"])
    assert rows(serial, "serialNumber", "event_count") == [
        ("a-b-c-L1", 1), ("s1", 1), ("s2", 1), ("s4", 2), ("s5", 1), ("s6", 1), ("s7", 1),
    ]
    for environment, day in (("one", "2024-01-03"), ("two", "2024-01-02"), ("two", "2024-01-02")):
        event_job.write_counts(classified, counted, paths, environment, day)
    assert spark.read.parquet(paths["events_classification"]).count() == 3 * wide.count()
    only = {n: str(tmp_path / f"only-{n}") for n in event_job.SETS}
    assert event_job.write_counts(classified, counted, only, "one", "2024-01-02", "serialNumber_classification") == {"serialNumber_classification": "ok"}


def test_process_list_variant(spark):
    headers, attributes, *_ = inputs(spark)
    listed = spark.createDataFrame([("ten-ITEM-MOBILE-APP-MOBILE", "F", "P", "S")], schemas.PROCESS_LIST)
    got = event_job.listed_events(headers, attributes, listed, ["source"])
    assert rows(got.where("FeatureSet is not null"), "KeyField", "Process", "StoreCode") == [("ten-ITEM-MOBILE-APP-MOBILE", "P", "N/A")]
    assert got.count() == 8


def billing(spark):
    def one(hour, sku, cost, credits):
        return (("1", "svc"), ("2", sku), ("p", "9"), (5.0, "seconds"), ("r", "g"), credits, cost, "regular", dt.datetime(2024, 1, 2, hour))

    credit = ("n", -10.0, "f", "i", "SUSTAINED_USAGE_DISCOUNT")
    return spark.createDataFrame([one(10, "CPU", 100.0, [credit]), one(10, "SSD", 40.0, [credit]), one(11, "CPU", 7.0, [])], schemas.BILLING_LINE)


def test_compute_and_storage_allocation(spark):
    counts = spark.createDataFrame([(dt.datetime(2024, 1, 2, 10), "a", 30), (dt.datetime(2024, 1, 2, 10), "b", 10)], "datetime_h timestamp, who string, event_count bigint")
    got = cost_jobs.compute_allocation(counts, billing(spark))
    assert rows(got, "who", "allocated_cost", "allocated_cost_after_discount") == [("a", 75.0, 67.5), ("b", 25.0, 22.5)]
    sizes = spark.createDataFrame([(dt.datetime(2024, 1, 2), "t", "c", 1, 3, 1), (dt.datetime(2024, 1, 2), "u", "c", 1, 1, 1)], schemas.COLLECTION_SIZE)
    got = cost_jobs.storage_allocation(sizes, billing(spark), "ENV", "2024-01-02")
    assert rows(got, "tenant", "storage_cost_assigned", "storage_cost_assigned_after_discounts", "environment") == [("t", 30.0, 22.5, "ENV"), ("u", 10.0, 7.5, "ENV")]


def test_outputs_fill_their_declared_schemas(spark):
    named = event_job.classified_events(*inputs(spark), routes())
    counts = named.groupBy(*event_job.SETS["events_classification"]).agg(F.count(F.lit(1)).alias("event_count"))
    projects = spark.createDataFrame([("p", *["x"] * 12)], schemas.PROJECT_DIMENSION)
    sizes = spark.createDataFrame([(dt.datetime(2024, 1, 2), "t", "c", 1, 3, 1)], schemas.COLLECTION_SIZE)
    outputs = [
        (cost_jobs.compute_allocation(counts, billing(spark)), schemas.ALLOCATED_EVENTS),
        (project_cost_summary(billing(spark), projects), schemas.PROJECT_COSTS),
        (cost_jobs.monthly_allocation(counts, billing(spark), "2024-01", "E"), schemas.MONTHLY_ALLOCATION),
        (cost_jobs.storage_allocation(sizes, billing(spark), "E", "2024-01-02"), schemas.STORAGE_ALLOCATION),
    ]
    for df, schema in outputs:
        got = conform(df, schema)
        assert set(got.columns) <= set(df.columns), set(got.columns) - set(df.columns)
        assert got.count() == df.count() > 0


def test_issues_are_shuffled_once_for_all_their_labels(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    plan = work_job.wide_issues(tracker(spark))._jdf.queryExecution().executedPlan().toString()
    # issues, latest sprint, five labels, milestones
    assert plan.count("Exchange hashpartitioning(ISSUE_KEY") == 8


def test_monthly_allocation(spark):
    counts = spark.createDataFrame([(dt.datetime(2024, 1, 2, 10), "t", "ITEM", 3), (dt.datetime(2024, 2, 1, 7), "t", "ITEM", 1)],
                                   "datetime_h timestamp, tenantCode string, thingType string, event_count bigint")
    got = cost_jobs.monthly_allocation(counts, billing(spark), "2024-01", "E")
    assert rows(got, "event_count_h", "cost_assigned", "cost_assigned_after_discount") == [(1, 26.75, 24.25), (3, 80.25, 72.75)]


def test_request_allocation(spark):
    stats = spark.createDataFrame([("2024-01-02", "10", "a", 10, 1.0, 1), ("2024-01-02", "10", "b", 30, 1.0, 1), ("2024-02-02", "10", "b", 30, 1.0, 1)],
                                  "date string, hour string, host string, length_sum bigint, latency_mean double, call_count bigint")
    got = cost_jobs.request_allocation(stats, billing(spark), "2024-01")
    assert rows(got, "host", "cost_assigned_length", "cost_assigned_call_count", "seconds_h") == [("a", 25.0, 50.0, 5.0), ("b", 75.0, 50.0, 5.0)]


def tracker(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    issue = "ISSUE_KEY string, ISSUE_TYPE_NAME string, PARENT_ISSUE_KEY string, STORYPOINTS double, ISSUE_STATUS_NAME string, CURRENT_ASSIGNEE_NAME string"
    issues = spark.createDataFrame([
        ("IDEA-1", "Idea", None, None, "Open", "x"), ("IDEA-2", "Idea", None, None, "Open", "x"), ("R-1", "Product Request", None, None, "Open", "x"),
        ("E-1", "Epic", None, 8.0, "Open", "x"), ("S-1", "Story", "E-1", 5.0, "Open", "ann"), ("T-1", "Sub-task", "S-1", 2.0, "Done", "bob"),
        ("S-2", "Story", "E-1", 3.0, "Open", "ann"),
    ], issue)
    sprints = spark.createDataFrame([(1, "v1", "closed", day(1), day(10)), (2, "v2", "active", day(10), day(20)), (9, "other", "closed", day(1), day(2))],
                                    "SPRINT_ID int, SPRINT_NAME string, STATE string, START_DATE timestamp, END_DATE timestamp")
    issues = issues.withColumns({
        "CREATED": F.lit(day(1)), "SUMMARY": F.concat(F.lit("about "), "ISSUE_KEY"), "STATUS_CATEGORY_CHANGE_DATE": F.lit(day(2)),
        "REPORTER_NAME": F.lit("eve"), "PROGRESS": F.lit(0.5),
    })
    sprints = sprints.withColumn("COMPLETE_DATE", F.col("END_DATE"))
    labels = {
        name: (spark.createDataFrame([("E-1", "a"), ("E-1", "b")], f"ISSUE_KEY string, {name.lower()} string"), name.lower())
        for name in ("CUSTOMERS", "CATEGORY", "THEME", "BU", "VERSION_NAME")
    }
    return work_job.Tracker(
        issues=issues,
        issue_sprints=spark.createDataFrame([("S-1", 1, "v1"), ("S-1", 2, "v2"), ("S-2", 1, "v1"), ("T-1", 2, "v2")], "ISSUE_KEY string, SPRINT_ID int, SPRINT_NAME string"),
        sprints=sprints,
        links=spark.createDataFrame([("IDEA-1", "E-1", "Polaris issue link", "Outward"), ("R-1", "E-1", "Depends", "Outward")],
                                    "ISSUE_KEY string, LINKED_ISSUE_KEY string, TYPE string, DIRECTION string"),
        versions=spark.createDataFrame([("v8", day(9)), ("v9", day(25)), ("x", day(12))], "VERSION_NAME string, RELEASE_DATE timestamp"),
        labels=labels,
        time_in_status=spark.createDataFrame([("IDEA-1", "Delivered", day(3), day(4), 3600)],
                                             "ISSUE_KEY string, ISSUE_STATUS_NAME string, FIRST_TRANSITION_TO_STATUS timestamp, LAST_TRANSITION_TO_STATUS timestamp, DURATION_IN_BUSINESS_DAYS_BH bigint"),
        worklogs=spark.createDataFrame([("T-1", "bob", day(12), 3600), ("S-2", "ann", day(2), 60), ("TICKET-5", "ann", day(2), 30)],
                                       "ISSUE_KEY string, UPDATE_NAME string, START_DATE timestamp, LOGGED_TIME bigint"),
        resources=spark.createDataFrame([("ann", "DEV"), ("bob", "QA")], "NAME string, AREA string"),
        time_off=spark.createDataFrame([("Anne", dt.date(2024, 1, 4), dt.date(2024, 1, 6))], schemas.TIME_OFF),
        holidays=spark.createDataFrame([("New Year", dt.date(2024, 1, 1), dt.date(2024, 1, 1))], schemas.TIME_OFF),
        weeks=spark.createDataFrame([("W1-2024", "v1"), ("W2-2024", "v2")], schemas.WEEK_TO_SPRINT),
        aliases={"Anne": "ann"},
    )


def test_work_tracking(spark):
    out = work_job.work_tracking(tracker(spark))
    tree = ["ISSUE_KEY", "LINKED_1_ISSUE_KEY", "CHILD_ISSUE_KEY", "SUB_ISSUE_KEY", "TOTAL_STORYPOINTS", "CHILD_SPRINT_NAME", "CHILD_SPRINT_DATE_VERSION", "CHILD_SPRINT_END_DATE_VERSION"]
    assert rows(out["requests"], *tree) == [
        ("R-1", "E-1", "S-1", "T-1", 2.0, "v2", "01 v9", "01 v9"), ("R-1", "E-1", "S-2", None, 3.0, "v1", "00 v8", "01 v9"),
    ]
    ideas = out["ideas"]
    assert rows(ideas, "ISSUE_KEY", "CHILD_ISSUE_KEY", "LAST_ASSIGNEE_NAME", "CHILD_SPRINT_NAME", "HOLIDAYS", "PTO", "WORK_TYPE", "DELIVERED_DATE") == [
        ("IDEA-1", "S-1", "bob", "v2", 0, 0, "Dev", dt.datetime(2024, 1, 4)), ("IDEA-1", "S-2", "ann", "v1", 1, 2, "Unk", dt.datetime(2024, 1, 4)),
        ("IDEA-2", None, None, None, None, None, "Unk", None),
        (None, None, "ann", "v2", 0, 0, "Unk", None), (None, None, "bob", "v1", 1, 0, "Unk", None),
    ]
    assert rows(out["worklogs"], "ISSUE_KEY_LOGGED", "UPDATE_NAME", "SPRINT_ASSIGNED", "ISSUE_KEY", "UTILIZATION_TYPE", "WORKLOG_TYPE") == [
        ("S-2", "ann", "v1", "IDEA-1", "Idea", "Unk"), ("T-1", "bob", "v2", "IDEA-1", "Idea", "Dev"), ("TICKET-5", "ann", "v1", None, "Incident", "Support"),
        (None, "ann", "v2", None, None, None), (None, "bob", "v1", None, None, None),
    ]
    assert rows(out["worklogs"], "ISSUE_KEY_LOGGED", "UPDATE_NAME_AREA", "SUB_SPRINT_NAME")[:2] == [("S-2", "DEV", "Unknown"), ("T-1", "QA", "v2")]
    assert rows(ideas, "CHILD_ISSUE_KEY", "SUB_ISSUE_KEY", "RESOURCE_AREA")[:2] == [("S-1", "T-1", "QA"), ("S-2", "", "DEV")]
    spread = rows(out["requests_customers"], "customers", "SUB_STORYPOINTS", "ADJ_SUB_STORYPOINTS")
    assert spread == [("a", 2.0, 1.0), ("a", None, None), ("b", 2.0, 1.0), ("b", None, None)]
    wide = work_job.wide_issues(tracker(spark)).where(F.col("ISSUE_KEY") == "E-1").first()
    assert wide["CUSTOMERS"] == "a:b"
    assert rows(out["worklogs"].where("ISSUE_KEY is not null"), "ISSUE_KEY_LOGGED", "SUMMARY", "SUB_ISSUE_TYPE_NAME", "SUB_PROGRESS")[1] == ("T-1", "about IDEA-1", "Sub-task", 0.5)
    for prefix in ("LINKED_1_", "CHILD_", "SUB_"):
        assert {prefix + c for c in work_job.LEVEL} <= set(ideas.columns)
