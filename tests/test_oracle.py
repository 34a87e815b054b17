"""Every registered check against DuckDB on the same parquet tables."""

import pytest

import __spark_entry__ as E
from tests import oracle as O

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return O.duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_check(spark, con, name):
    r = O.compare(spark, con, name, QUERIES[name], SQL.get(name), SF)
    assert r["status"] in ("ok", "rows-only"), r


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "is_outlier" in df.columns
