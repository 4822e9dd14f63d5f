"""Every registered query at the smallest scale, against DuckDB where it has an SQL twin."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")


@pytest.fixture(scope="module")
def duck():
    pytest.importorskip("duckdb")
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    assert compare(spark, duck, entry.queries()[name], SQL[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_has_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_every_twin_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_flagship_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["fold", "score", "mape", "n", "dt_diff", "ratio"]
    assert df.count() == 5
