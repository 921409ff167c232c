"""Plan properties the scale design relies on (checked on the physical plan)."""

import re

import pytest

import __spark_entry__ as E


def _plan(spark, key, sf):
    spark.catalog.clearCache()  # a table cached by another test would replace the file scan
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    return E.queries()[key](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_cursor_bounds_reach_the_scan(spark, sf_small):
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", _plan(spark, "cursor_range", sf_small))
    assert pushed and "GreaterThan(ts" in pushed[0] and "LessThanOrEqual(ts" in pushed[0]


def test_batch_cap_is_a_pushed_literal_without_shuffle(spark, sf_small):
    plan = _plan(spark, "batch_cap", sf_small)
    assert "Exchange" not in plan
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(o_orderdate", plan)


def test_scd1_aggregates_before_the_shuffle(spark, sf_small):
    plan = _plan(spark, "latest_per_key", sf_small)
    lines = plan.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(user_id" in line)
    assert any("partial_max_by" in line for line in lines[exchange:])
    assert "Window" not in plan


@pytest.mark.parametrize("table,cols", [("customer", {"c_custkey", "c_name", "c_nationkey"}),
                                        ("region", {"r_regionkey", "r_name"})])
def test_expand_reads_only_referenced_columns(spark, sf_small, table, cols):
    plan = _plan(spark, "expand_nested", sf_small)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?" + table + r"\.parquet", plan)
    assert scans and {c.split("#")[0] for c in scans[0].split(",")} == cols
