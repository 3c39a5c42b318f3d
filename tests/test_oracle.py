"""Every query against its SQL."""

import pytest
from oracle import connect, difference

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, con, sql) is None


def test_entry_is_lazy_and_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "datetime_h" and df.count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
