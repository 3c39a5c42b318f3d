import datetime as dt

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.plans import reports
from tallyloom.sources import Table

T = dt.datetime(2024, 3, 5, 10, 30)


def test_requests_of_a_day(spark, tmp_path):
    data = [(t, "GET", "/a/b/c", "h", 500, 10, 2.0, "s", "u", "K", "x", "y") for t in (T, T + dt.timedelta(days=1))]
    spark.createDataFrame(data, schemas.INGRESS_REQUEST).write.parquet(str(tmp_path / "r"))
    got = reports.request_reports(spark, {"A": Table("requests", str(tmp_path / "r"))}, "A", "2024-03-05")
    assert rows(got["stats"], "date", "hour", "call_count") == [("2024-03-05", "10", 1)]
    assert rows(got["failures"], "uri_1_to_3", "call_count") == [("a/b/c", 1)]
    with pytest.raises(KeyError):
        reports.request_reports(spark, {}, "A", "2024-03-05")


def test_api_keys_of_a_window(spark):
    data = [(t, "GET", "/", "h", 200, 1, 1.0, "s", "u", "K", "x", "y") for t in (T, T + dt.timedelta(hours=2))]
    df = spark.createDataFrame(data, schemas.INGRESS_REQUEST)
    known = spark.createDataFrame([("K", "known value")], schemas.API_KEY)
    got = reports.apikey_report(df, known, F.lit(T), F.lit(T + dt.timedelta(hours=2)))
    assert rows(got, "apikey_label", "call_count") == [("known value", 1)]


def test_each_sandbox_counts_its_own_headers(spark):
    def headers(n):
        return spark.createDataFrame([(str(i), "s", "t", "ITEM", "", "/x/y", T) for i in range(n)], schemas.EVENT_HEADER)

    got = reports.sandbox_counts({"one": headers(1), "two": headers(2)}, "2024-03-05")
    assert {n: rows(df, "event_count", "datetime_h_local") for n, df in got.items()} == {
        "one": [(1, dt.datetime(2024, 3, 5, 2))], "two": [(2, dt.datetime(2024, 3, 5, 2))],
    }


def test_site_costs(spark):
    costs = spark.createDataFrame([(dt.date(2024, 3, 5), "OLD", 1.0, 2.0), (dt.date(2024, 4, 1), "OLD", 9.0, 9.0)], schemas.TENANT_COST)
    deployed = spark.createDataFrame([
        (T, "e", "NEW", "1", "x"), (T, "e", "NEW", "2", "x"), (T, "other", "NEW", "3", "x"), (T, "e", "OUT", "4", "x"),
        (dt.datetime(2024, 4, 1), "e", "NEW", "5", "x"),
    ], schemas.DEPLOYED_SITE)
    got = reports.site_costs(costs, deployed, "e", "2024-03", {"NEW": ["OLD"]}, excluded=["OUT"])
    assert rows(got, "day", "tenant", "total_cost", "deployed_sites", "total_sites") == [("2024-03-05", "NEW", 3.0, 2, 2)]


def test_catalogues_of_all_tenants(spark):
    fixture = spark.createDataFrame([("f", "z", "p", "b")], "id string, locationCode string, premise string, bizLocation string")
    zone = spark.createDataFrame([("z", "zb", ("p",))], "code string, bizLocation string, hierarchy struct<premiseId:string>")
    premise = spark.createDataFrame([("p", "Main")], "code string, name string")
    got = reports.site_catalogues({"t": fixture, "u": fixture}, {"t": zone}, {"t": premise, "u": premise})
    assert rows(got, "tenant", "zone_bizLocation", "zone_hierarchy_premiseId", "premise_name") == [
        ("t", "zb", "p", "Main"), ("u", None, None, "Main"),
    ]


def test_enrichment_from_landed_payloads(spark):
    facts = spark.createDataFrame([("1", "P", "G", T)], "id string, premise string, gtin string, time timestamp")
    sites = spark.createDataFrame([("P", "Main")], "code string, name string")
    products = spark.createDataFrame([("G", "Shirt")], "gtin string, label string")
    weather = spark.createDataFrame([("P", (["2024-03-05T10:00", "2024-03-05T11:00"], [5.0, 6.0]))], schemas.WEATHER_PAYLOAD)
    assert rows(reports.enriched_events(facts, sites, products, weather), "name", "label", "temperature") == [("Main", "Shirt", 5.0)]
    assert "temperature" not in reports.enriched_events(facts, sites, products).columns


def test_tickets_and_items(spark):
    issues = spark.createDataFrame([("TICKET-1", "Bug", "Open", "big RED one", T, None, T)],
                                   "ISSUE_KEY string, ISSUE_TYPE_NAME string, ISSUE_STATUS_NAME string, SUMMARY string, "
                                   "CREATED timestamp, RESOLUTION_DATE timestamp, FIRST_RESPONSE_DATE timestamp")
    logs = spark.createDataFrame([("TICKET-1", 7200)], "ISSUE_KEY string, LOGGED_TIME bigint")
    spent = spark.createDataFrame([("TICKET-1", "Open", "3600")], "ISSUE_KEY string, ISSUE_STATUS_NAME string, DURATION_IN_BUSINESS_DAYS_BH string")
    got = reports.ticket_reports(issues, logs, spent, [("RED", "R")], ["Open"])
    assert rows(got["worklogs"], "TENANT", "LOGGED_HOURS") == [("R", 2.0)] and rows(got["time_in_status"]) == [("TICKET-1", 1.0)]
    items = spark.createDataFrame([("t", "p", "urn:x:disp:active", "b", "ADD", "g", "s", "h")], schemas.ITEM_STATUS)
    assert rows(reports.sites_and_items(items, "2024-03-05"), "item_count", "extraction_date") == [(1, dt.date(2024, 3, 5))]
