"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    df = QUERIES[key](spark, SF_DIR)
    if key in ORACLES:
        assert compare(df, con, ORACLES[key]) is None
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_a_row_per_month(spark):
    months = [r["_ano_mes"] for r in entry.entry(spark).collect()]
    assert months and len(months) == len(set(months))
