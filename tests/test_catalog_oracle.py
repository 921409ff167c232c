"""Every catalog query against its DuckDB oracle on sf0.001 (the driver checks sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.oracle import canon, duck, run_duck

from keelson.plans.catalog import ORACLES, QUERIES

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, con, key):
    df = E.queries()[key](spark, sf_small)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert rows is not None
        return
    ocols, orows = run_duck(con, sql)
    assert sorted(cols) == sorted(ocols)
    assert canon(cols, rows) == canon(ocols, orows)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "user_id" in df.columns
