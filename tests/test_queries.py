"""Every query with a SQL counterpart must equal it on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import database, differences

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_counterpart_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    assert differences(got, con.execute(SQL[name]).df()) == ""
