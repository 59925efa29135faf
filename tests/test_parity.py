"""Every registered query with SQL against DuckDB on the smallest tables; the others must give rows."""

import parity
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return parity.connect(SF)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLE)))
def test_same_rows(spark, duck, name):
    assert parity.compare(QUERIES[name](spark, SF), duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert {"client_id", "segment", "rfm_score"} <= set(df.columns)
    assert df.count() > 0
