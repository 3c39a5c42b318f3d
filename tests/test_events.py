import datetime as dt

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators import catalog, events, traffic
from tallyloom.operators.aggregate import delimited_values, first_per_key, last_per_key, pivot_first, row_quality
from tallyloom.operators.shape import ensure_columns, fill_text

T = dt.datetime(2024, 1, 2, 3, 4, 5)


def headers(spark, *data):
    return spark.createDataFrame(list(data), "id string, serialNumber string, thingType string, time timestamp")


def attributes(spark, *data):
    return spark.createDataFrame(list(data), "metadataId string, serialNumber string, key string, value string")


def test_widening_keeps_both_sides_and_fills_texts(spark):
    got = events.widen_events(
        headers(spark, ("1", "s", "ITEM", T), ("2", "s", None, T), ("3", None, "ITEM", T)),
        attributes(spark, ("1", "s", "a", "x"), ("1", "s", "a", "x"), ("1", "s", "b", ""), ("9", "s", "a", "y"), ("8", "s", "other", "z")),
        ["a", "b"],
    )
    assert rows(got, "id_serial_number", "id", "thingType", "a", "b", "time") == [
        ("1-s", "1", "ITEM", "x", "", T), ("2-s", "2", "N/A", "N/A", "N/A", T), ("8-s", "N/A", "N/A", "N/A", "N/A", None),
        ("9-s", "N/A", "N/A", "y", "N/A", None), ("N/A", "3", "ITEM", "N/A", "N/A", T),
    ]


def test_a_key_with_two_values_is_decided_by_the_value(spark):
    df = spark.createDataFrame([("1", "a", "y"), ("1", "a", "x")], "i string, k string, v string")
    assert rows(pivot_first(df, "i", "k", "v", ["a"])) == [("1", "x")]


def test_only_missing_columns_are_added(spark):
    df = ensure_columns(spark.createDataFrame([(None, 1)], "a string, n int"), ["a", "b"])
    assert rows(df) == [(None, 1, "N/A")] and rows(fill_text(df)) == [("N/A", 1, "N/A")]


@pytest.mark.parametrize("dedupe, count", [(False, 2), (True, 1)])
def test_content_site(spark, dedupe, count):
    wide = spark.createDataFrame([
        ("1", "CONTENT", "unlink", "a-b-c-L1", "zzz"), ("2", "CONTENT", "link", "a", "L1"), ("3", "ITEM", "unlink", "a-b-c-L1", "L1"),
        ("4", "CONTENT", "unlink", "short", "L1"),
    ], "id_serial_number string, thingType string, transactionId string, serialNumber string, referenceListSerial string")
    lists = spark.createDataFrame([("L1", t, "bizLocation", "biz", "007", T) for t in ("t1", "t1", "t2")],
                                  schemas.REFERENCE_LIST)
    got = events.content_site(wide, lists, dedupe=dedupe)
    sites = {}
    for r in got.collect():
        sites.setdefault(r.id_serial_number, []).append(r.premise_from_biz)
    assert sites == {"1": ["007"] * count, "2": ["007"] * count, "3": [None], "4": [None]}


def test_counts_in_one_pass_equal_separate_counts(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, "x"), ("b", 2, None), ("b", 1, None)], "p string, q int, r string")
    sets = {"one": ["p", "r"], "two": ["q"]}
    counted = events.count_sets(df, sets)
    for name, keys in sets.items():
        assert rows(events.pick_set(counted, sets, name)) == rows(df.groupBy(*keys).agg(F.count(F.lit(1))))


def test_preaggregated_counts_are_matched_by_name(spark):
    fresh = spark.createDataFrame([("a", 1)], "k string, event_count bigint")
    given = spark.createDataFrame([(5, "b")], "count bigint, k string")
    assert rows(events.add_preaggregated(fresh, given), "k", "event_count") == [("a", 1), ("b", 5)]


def test_last_first_labels_and_quality(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "w")], "k string, n int, v string")
    assert rows(last_per_key(df, ["k"], ["n", "v"])) == [("a", 3, "z"), ("b", None, "w")]
    assert rows(first_per_key(df, ["k"], ["n"])) == [("a", 1, "x"), ("b", None, "w")]
    assert rows(delimited_values(df.unionAll(df), "k", "v", "all")) == [("a", "x:y:z"), ("b", "w")]
    empty = spark.createDataFrame([("c", None)], "k string, v string")
    assert delimited_values(empty, "k", "v", "all").count() == 0
    assert tuple(row_quality(df.unionAll(df)).first()) == (8, 4)


def requests(spark, *data):
    return spark.createDataFrame([
        (dt.datetime(2024, 1, 1, h), m, u, "h", s, 10, lat, "src", "usr", key, "auth", "tok") for h, m, u, s, lat, key in data
    ], schemas.INGRESS_REQUEST)


def test_endpoint_statistics(spark):
    df = requests(spark, (1, "GET", "/a/b/c/d", 200, 1.0, "k"), (1, "GET", "/a/x", 200, 3.0, "k"), (2, "GET", "/a/b/c/d", 404, 1.0, ""),
                  (2, "PUT", "/a/b/c/d", 405, 2.0, "k"), (3, "PUT", "/a/b", 500, 2.0, "k"), (3, "PUT", "/a/b/c/e", 500, 4.0, None), (3, "GET", "none", 200, 1.0, "q"))
    got = traffic.endpoint_stats(df)
    assert rows(got, "hour", "uri_lv1", "status", "length_sum", "latency_mean", "call_count") == [
        ("01", "a", 200, 20, 2.0, 2), ("02", "a", 404, 10, 1.0, 1), ("02", "a", 405, 10, 2.0, 1), ("03", "a", 500, 20, 3.0, 2),
    ]
    got = traffic.failing_endpoints(df)
    assert rows(got, "uri_1_to_3", "call_count", "latency_mean") == [("a/b/c", 2, 3.0)]
    assert traffic.failing_endpoints(df, ok_up_to=403, limit=1).count() == 1


def test_api_keys(spark):
    df = requests(spark, (1, "GET", "/a/b/c/d/e", 200, 1.0, "K1"), (1, "GET", "/a/b/c/d/e", 200, 1.0, "K1"), (1, "GET", "/", 200, 1.0, ""),
                  (1, "GET", "/", 200, 1.0, "K2"), (1, "GET", "/", 200, 1.0, "K3"), (1, "GET", "/", 200, 1.0, None))
    known = spark.createDataFrame([("K1", "known value"), ("K2", "revoked")], schemas.API_KEY)
    assert rows(traffic.apikey_audit(df, known), "apikey", "apikey_label", "call_count") == [
        ("", "empty", 1), ("K1", "known value", 2), ("K2", "unknown", 1), ("K3", "unknown", 1), (None, "unknown", 1),
    ]
    assert {r.endpoint for r in traffic.label_api_keys(df, known).collect()} == {"a/b/c/d", None}


def test_items(spark):
    gone = "urn:epcglobal:cbv:disp:retail_sold"
    df = spark.createDataFrame([
        ("t", "p", "active", "b", "ADD", "g1", "s1", "h1"), ("t", "p", "active", "b", "ADD", "g1", "s2", "h2"),
        ("t", "p", gone, "b", "ADD", "g9", "s9", "h9"), ("t", "p", None, "b", "ADD", "g9", "s9", "h9"),
        ("t", "p", "urn:econnectware:epcis:disp:missing", "b", "ADD", "g1", "s1", "h1"),
    ], schemas.ITEM_STATUS)
    assert rows(catalog.item_counts(df), "disposition", "distinct_gtin", "distinct_sku", "distinct_hexa", "item_count") == [
        ("active", 1, 2, 2, 2), ("urn:econnectware:epcis:disp:missing", 1, 1, 1, 1),
    ]


def test_site_catalogue(spark):
    fixtures = spark.createDataFrame([("t", "f1", "z1", "p1", "b"), ("t", "f2", "z9", "p1", "b"), ("u", "f3", "z1", "p1", "b")], schemas.FIXTURE)
    zones = spark.createDataFrame([("t", "z1", "zb", ("p1",))], schemas.ZONE)
    premises = spark.createDataFrame([("t", "p1", "pb", "Main", "premise", "x", "US", 1.0, 2.0)], schemas.PREMISE)
    got = catalog.site_catalogue(fixtures, zones, premises)
    assert rows(got, "id", "zone_bizLocation", "premise_name") == [("f1", "zb", "Main"), ("f2", None, "Main"), ("f3", None, None)]
    assert rows(catalog.zone_catalogue(zones, premises), "code", "premise", "premise_name") == [("z1", "p1", "Main")]


def test_premise_by_location_and_by_fixture(spark):
    sites = spark.createDataFrame([("t", "c1", "biz1", "f1", "p1"), ("t", "c1", "biz1", "f2", "p1"), ("u", "c2", "biz1", "f1", "p2")],
                                  "tenant string, code string, bizLocation string, fixture string, premise string")
    facts = spark.createDataFrame([("1", "t", "biz1", "f2"), ("2", "u", "biz1", "f2"), ("3", "t", "x", None)],
                                  "id string, tenantCode string, bizLocation_rfl string, zone string")
    got = catalog.premise_of_location(facts, sites, "bizLocation", "bizLocation_rfl", "code", "premise_from_biz")
    got = catalog.premise_of_location(got, sites, "fixture", "zone", "premise", "premise_from_fixture")
    assert rows(got, "id", "premise_from_biz", "premise_from_fixture") == [("1", "c1", "p1"), ("2", "c2", None), ("3", None, None)]


def test_enrichment_keeps_every_event(spark):
    facts = spark.createDataFrame([("1", "P", "G", T), ("2", "Q", None, T)], "id string, premise string, gtin string, time timestamp")
    sites = spark.createDataFrame([("P", "Main")], "code string, name string")
    products = spark.createDataFrame([("G", "Shirt")], "gtin string, label string")
    weather = spark.createDataFrame([("P", "2024-01-02T03:00", 7.5)], "code string, hour string, temperature double")
    assert rows(catalog.enrich_events(facts, sites, products, weather), "id", "name", "label", "temperature") == [
        ("1", "Main", "Shirt", 7.5), ("2", None, None, None),
    ]
