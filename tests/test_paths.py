"""The ways taken for hot keys and for tables too large to broadcast give the same rows."""

import pytest
from oracle import connect, difference

import __spark_entry__ as entry
from tallyloom.operators import aggregate, capacity, intervals, joins, rules, work

SF = "/root/testdata/sf0.001"
OUTER = ["alloc_component", "classified_counts", "eav_widen", "idea_hierarchy", "issue_hierarchy", "utilisation"]
LOOKUPS = [
    "apikey_audit", "capacity_grid", "classified_counts", "classify_by_key", "content_site", "csv_reference", "enrich_events",
    "interval_closed", "interval_halfopen", "premise_by_location", "project_summary", "rule_classify", "site_catalogue",
    "utilisation", "weekday_time_off", "zone_catalogue",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("hot", [True, False])
@pytest.mark.parametrize("name", OUTER)
def test_hot_keys(spark, con, monkeypatch, name, hot):
    for module in (joins, work):
        monkeypatch.setattr(module, "may_have_hot_key", lambda *a, **k: hot)
    assert difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", LOOKUPS)
def test_nothing_fits_a_broadcast(spark, con, monkeypatch, name):
    for module in (aggregate, capacity, intervals, joins, rules):
        monkeypatch.setattr(module, "fits_broadcast", lambda *a, **k: False)
    assert difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None
