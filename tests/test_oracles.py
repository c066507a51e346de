"""Every registered query that has an SQL twin against it on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import duck, normal
from registry.oracles import ORACLES
from registry.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_same_rows(spark, con, name):
    df = queries()[name](spark, SF)
    cols, rows = normal(df.columns, df.collect())
    cur = con.execute(oracle_sql()[name])
    want_cols, want = normal([c[0] for c in cur.description], cur.fetchall())
    assert cols == want_cols
    assert rows == want


def test_every_query_of_the_registry_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["rid", "sample"]
