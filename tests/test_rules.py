import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.functions import all_hold, case_first, case_last, contains_rules, pattern
from tallyloom.operators.aggregate import unmatched_share
from tallyloom.operators.billing import map_component, map_subcomponent
from tallyloom.operators.events import Route, bridge_family, route, route_together
from tallyloom.operators.rules import classify, classify_by_key, rules_as_case, rules_schema

KEYS, GUARDS, TARGETS = ["a", "b"], ["t_is", "t_not"], ["x", "y"]
SCHEMA = rules_schema(KEYS, GUARDS)


def table(spark, rules):
    names = ["target", "priority", *KEYS, *GUARDS, "value"]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rules], SCHEMA)


def random_rules(seed, n=120):
    rng = random.Random(seed)
    values = ["", "N/A", "p", "q", "r"]
    return [
        {
            "target": rng.choice(TARGETS), "priority": i, "a": rng.choice(values), "b": rng.choice(values),
            "t_is": rng.choice([None, None, "u", "w"]), "t_not": rng.choice([None, None, None, "u"]),
            "value": rng.choice(["one", "two", "", "three"]),
        }
        for i in rng.sample(range(1000), n)
    ]


def random_events(spark, seed, n=400):
    rng = random.Random(seed)
    values = ["", "N/A", "p", "q", "r", None]
    data = [(i, rng.choice(values), rng.choice(values), rng.choice(["u", "w", "", None])) for i in range(n)]
    return spark.createDataFrame(data, "id int, a string, b string, t string")


@pytest.mark.parametrize("max_bytes", [0, 10_000])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rule_join_equals_the_case_chain(spark, seed, max_bytes):
    rules, events = random_rules(seed), random_events(spark, seed)
    joined = classify(events, table(spark, rules), KEYS, TARGETS, max_bytes=max_bytes)
    chain = events.withColumns({t: rules_as_case(rules, KEYS, t) for t in TARGETS})
    assert rows(joined, "id", *TARGETS) == rows(chain, "id", *TARGETS)


def test_duplicate_and_overlapping_rules_do_not_multiply_events(spark):
    rule = {"target": "x", "priority": 1, "a": "p", "b": "q", "value": "first"}
    rules = [rule, rule, {**rule, "priority": 2, "value": "second"}, {**rule, "priority": 0, "t_is": "u", "value": "guarded"}]
    events = spark.createDataFrame([(1, "p", "q", "u"), (2, "p", "q", None), (3, "p", None, "u")], "id int, a string, b string, t string")
    got = classify(events, table(spark, rules), KEYS, ["x"])
    assert rows(got, "id", "x") == [(1, "guarded"), (2, "first"), (3, "N/A")]


def test_a_negative_guard_does_not_hold_on_null(spark):
    rules = [{"target": "x", "priority": 1, "a": "p", "b": "q", "t_not": "u", "value": "v"}]
    events = spark.createDataFrame([(1, "p", "q", "u"), (2, "p", "q", None), (3, "p", "q", "w")], "id int, a string, b string, t string")
    assert rows(classify(events, table(spark, rules), KEYS, ["x"]), "id", "x") == [(1, "N/A"), (2, "N/A"), (3, "v")]


def test_empty_text_sentinel_and_null_are_three_things(spark):
    rules = [{"target": "x", "priority": 1, "a": "", "b": "N/A", "value": "v"}]
    events = spark.createDataFrame([(1, "", "N/A", "u"), (2, "N/A", "N/A", "u"), (3, None, "N/A", "u")], "id int, a string, b string, t string")
    assert rows(classify(events, table(spark, rules), KEYS, ["x"]), "id", "x") == [(1, "v"), (2, "N/A"), (3, "N/A")]


def test_first_and_last_match(spark):
    df = spark.createDataFrame([("abc",), ("b",), ("zzz",), (None,)], "s string")
    rules = contains_rules(F.col("s"), [("a", "A"), ("b", "B")])
    got = df.select("s", case_first(rules, "-").alias("f"), case_last(rules, "-").alias("l"))
    assert rows(got) == [("abc", "A", "B"), ("b", "B", "B"), ("zzz", "-", "-"), (None, "-", "-")]


def test_conditions_by_value_list_and_pattern(spark):
    df = spark.createDataFrame([("a", "x1"), ("b", "x2"), ("c", "y1")], "k string, v string")
    assert rows(df.where(all_hold({"k": ["a", "b", "c"], "v": pattern("x%")})), "k") == [("a",), ("b",)]
    assert df.where(all_hold({})).count() == 3


def test_routes_answer_with_columns_or_literals(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, v string")
    got = route(df, "out", [Route({"k": "a"}, F.col("v")), Route({"k": ["a", "b"]}, "lit")])
    assert rows(got, "k", "out") == [("a", "1"), ("b", "lit"), ("c", "N/A")]


def test_answers_given_together_are_those_given_apart(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), (None, "4")], "k string, v string")
    table = [({"k": "a"}, F.col("v"), "x"), ({"k": ["a", "b"]}, "lit", F.col("v"))]
    got = route_together(df, ["one", "two"], table)
    apart = df
    for n, out in enumerate(["one", "two"]):
        apart = route(apart, out, [Route(row[0], row[n + 1]) for row in table])
    assert rows(got) == rows(apart) and got.columns == ["k", "v", "one", "two"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("k#") < apart._jdf.queryExecution().optimizedPlan().toString().count("k#")


def test_bridge_family(spark):
    df = spark.createDataFrame([("/SERVICES",), ("/x/NAME",), ("/x",), ("",), (None,)], "b string")
    got = df.select("b", bridge_family("b").alias("f"))
    assert rows(got) == [("", None), ("/SERVICES", "SERVICES"), ("/x", None), ("/x/NAME", "NAME"), (None, None)]


def test_components_first_and_last(spark):
    df = spark.createDataFrame(
        [("db-gke-1", None), (None, "//gke"), (None, None), ("zzz", "//gke")], "resource_name string, resource_global_name string"
    )
    first = map_component(df, [("%db%", "DB"), ("%gke%", "GKE")], [("%gke%", "global")])
    assert [r.component for r in first.collect()] == ["DB", "global", None, "global"]
    last = map_component(df, [("db", "DB"), ("gke", "GKE")], [("gke", "global")], mode="last")
    assert [r.component for r in last.collect()] == ["GKE", "global", None, "global"]
    sub = map_subcomponent(first, [("%-1", "one")], verbatim=["z%"])
    assert [r.sub_component for r in sub.collect()] == ["one", "N/A", "N/A", "zzz"]


def test_list_lookup_by_joined_key(spark):
    events = spark.createDataFrame([("a", "b"), ("a", "c")], "x string, y string")
    listed = spark.createDataFrame([("a-b", "F")], "k string, feature string")
    assert rows(classify_by_key(events, listed, ["x", "y"], "k"), "x", "y", "feature") == [("a", "b", "F"), ("a", "c", None)]


def test_unmatched_share(spark):
    df = spark.createDataFrame([("a", "N/A"), (None, "b"), ("N/A", "c"), ("", "d")], "x string, y string")
    assert rows(unmatched_share(df, ["x", "y"], "N/A")) == [("x", 4, 2, 50.0), ("y", 4, 1, 25.0)]
