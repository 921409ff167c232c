"""Corpus queries against their DuckDB SQL on sf0.001."""

import pytest

from keelson.llm.catalog import ORACLES, QUERIES
from tests.oracle import canon, duck, run_duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    ocols, orows = run_duck(duck(sf_small), ORACLES[name])
    assert sorted(cols) == sorted(ocols)
    assert canon(cols, rows) == canon(ocols, orows)
