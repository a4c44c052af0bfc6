"""Every query with SQL gives the same rows as the SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import canonical, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, con, name):
    got = queries()[name](spark, SF).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    assert entry(spark).count() > 0
