"""The reference's connector test shapes (FIXTURES.md A2, A3) on literal inputs."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators import cursor as R
from keelson.sources import pages as P

BASE = "https://api.example.test/v1/"
ROW = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])


def _pages(spark, bodies, links=None, nexts=None):
    rows = []
    for i, b in enumerate(bodies):
        req = (links or [None] * len(bodies))[i] or (f"{BASE}items" if i == 0 else f"/items?p={i}")
        nxt = (nexts or [None] * len(bodies))[i]
        rows.append(("items", "r1", i, i * 100, req, nxt, json.dumps(b)))
    return spark.createDataFrame(rows, "table_name string, run_id string, page int, page_offset int, "
                                       "request_link string, next_link string, body string")


def test_single_results_page(spark):
    p = _pages(spark, [{"results": [{"id": "1", "name": "a"}, {"id": "2"}], "next_link": None}])
    rows = sorted(tuple(r) for r in P.unnest_results(p, ROW).collect())
    assert rows == [("1", "a"), ("2", None)]
    assert [r.status for r in P.page_chain(p, BASE).collect()] == ["end"]


def test_results_missing_gives_no_rows(spark):
    p = _pages(spark, [{"data": [{"id": "1"}]}])
    assert P.unnest_results(p, ROW).count() == 0


def test_two_pages_relative_link(spark):
    p = _pages(spark, [{"results": [{"id": "1"}], "next_link": "/items/more?after=k17"},
                       {"results": [{"id": "2"}], "next_link": None}],
               links=[f"{BASE}items", "/items/more?after=k17"],
               nexts=["/items/more?after=k17", None])
    chain = {r.page: (r.status, r.next_abs) for r in P.page_chain(p, BASE).collect()}
    assert chain[0] == ("ok", "https://api.example.test/v1/items/more?after=k17")
    assert chain[1][0] == "end"
    assert P.unnest_results(p, ROW).count() == 2


def test_broken_and_unread_chain(spark):
    p = _pages(spark, [{"results": []}, {"results": []}],
               links=[f"{BASE}items", "/items?p=9"], nexts=["/items?p=1", "/items?p=2"])
    chain = {r.page: r.status for r in P.page_chain(p, BASE).collect()}
    assert chain == {0: "broken", 1: "unread"}


def test_repeated_link(spark):
    p = _pages(spark, [{"results": []}, {"results": []}],
               links=[f"{BASE}items", f"{BASE}items"], nexts=["/items", None])
    assert {r.status for r in P.page_chain(p, BASE).collect()} == {"repeated"}


def test_bare_list_pages(spark):
    full = [{"id": str(i)} for i in range(100)]
    one_short = _pages(spark, [[{"id": "x"}]])
    assert P.unnest_list(P.stop_at_short_page(one_short), ROW).count() == 1
    then_one = _pages(spark, [full, [{"id": "last"}], [{"id": "never"}]])
    kept = P.unnest_list(P.stop_at_short_page(then_one), ROW)
    assert kept.count() == 101 and kept.where(F.col("id") == "never").count() == 0
    then_empty = _pages(spark, [full, [], full])
    assert P.unnest_list(P.stop_at_short_page(then_empty), ROW).count() == 100


def test_list_or_results_object(spark):
    p = _pages(spark, [[{"id": "1"}], {"results": [{"id": "2"}]}])
    assert sorted(r.id for r in P.unnest_list(p, ROW).collect()) == ["1", "2"]


def _broken(spark):
    """Three pages, the middle one cut off."""
    rows = [("items", "r1", i * 2, body) for i, body in enumerate(
        ['{"results": [{"id": "1"}, {"id": "2"}]}', '{"results": [{"id": "3"}, {"id"', '[{"id": "5"}, {"id": "6"}]', '[{"id": "7"}]'])]
    return spark.createDataFrame(rows, "table_name string, run_id string, page_offset int, body string")


@pytest.mark.parametrize("read", [P.unnest_results, P.unnest_list])
def test_a_page_that_is_cut_off_is_an_error(spark, read):
    p = _broken(spark)
    with pytest.raises(Exception, match="page body is not JSON"):
        read(p, ROW).collect()
    with pytest.raises(Exception, match="page body is not JSON"):
        P.stop_at_short_page(p, 2).collect()
    rows = read(P.stop_at_short_page(p, 2, mode="permissive"), ROW, keep=["page_offset"], mode="permissive").collect()
    assert [(r.id, len(r._errors)) for r in rows if r.page_offset == 2] == [(None, 1)]
    if read is P.unnest_list:                            # the bad page did not end the chain
        assert sorted(r.id for r in rows if r.id) == ["1", "2", "5", "6", "7"]


def test_object_pages_count_as_pages(spark):
    full = [{"id": str(i)} for i in range(100)]
    p = _pages(spark, [{"results": full}, full, {"results": full[:3]}, full])
    assert P.unnest_list(P.stop_at_short_page(p), ROW).count() == 203


CHILD = T.StructType([T.StructField("id", T.StringType()), T.StructField("company_id", T.StringType())])


def _parents(spark, parents):
    return spark.createDataFrame([(json.dumps(p),) for p in parents], "body string")


def test_derived_table_cases(spark):
    parents = _parents(spark, [
        {"id": "c1", "legal_entities": [{"id": "e1", "company_id": "own"}, {"id": "e2"}]},
        {"id": "c2"},                                            # no array: no rows
        {"id": "c3", "legal_entities": "not a list"},            # not a list: no rows
        {"id": "c4", "legal_entities": ["plain", {"id": "e3", "company_id": None}]},
    ])
    exact = {r.id: r.company_id for r in
             P.derived_table(parents, "legal_entities", "id", "company_id", CHILD).collect()}
    assert exact == {"e1": "own", "e2": "c1", "e3": None}     # explicit null stays null
    lenient = {r.id: r.company_id for r in
               P.derived_table(parents, "legal_entities", "id", "company_id", CHILD, exact=False).collect()}
    assert lenient["e3"] == "c4"


def test_derived_children_are_filled_before_they_are_typed(spark):
    need = T.StructType([T.StructField("id", T.LongType()), T.StructField("company_id", T.LongType(), False)])
    parents = _parents(spark, [{"id": 7, "kids": [{}, {"id": 1}, {"id": 2, "company_id": 9}]}])
    got = P.derived_table(parents, "kids", "id", "company_id", need).collect()
    assert sorted(map(tuple, got), key=str) == [(1, 7), (2, 9), (None, 7)]
    bad = _parents(spark, [{"id": "zz", "kids": [{"id": 4}]}])
    with pytest.raises(Exception, match="cannot convert zz"):
        P.derived_table(bad, "kids", "id", "company_id", need).collect()
    row = P.derived_table(bad, "kids", "id", "company_id", need, mode="permissive").first()
    assert (row.id, row.company_id) == (4, None) and "zz" in row._errors[0]


def test_nested_array_rows_keeps_empty_parents(spark):
    df = spark.createDataFrame([(1, [("a", "x")]), (2, [])],
                               "id int, emails array<struct<value:string, type:string>>")
    rows = sorted((r.id, r.pos, r.value) for r in P.nested_array_rows(df, "emails").collect())
    assert rows == [(1, 0, "a"), (2, None, None)]


# ---------------------------------------------------------------- cursor cases (A3)
def _ts_rows(spark, values):
    return spark.createDataFrame([(v,) for v in values], "updated_at string")


def test_first_read_and_offset(spark):
    df = _ts_rows(spark, ["2023-03-19T00:00:00Z"])
    assert R.after_cursor(df, "updated_at", None).count() == 1
    assert R.end_offset(df, "updated_at").first().end_offset == "2023-03-19T00:00:00Z"


def test_filter_equal_and_repeat(spark):
    df = _ts_rows(spark, ["2023-02-11T00:00:00Z", "2023-04-23T00:00:00Z"])
    start = "2023-03-05T00:00:00Z"
    got = R.after_cursor(df, "updated_at", start)
    assert [r.updated_at for r in got.collect()] == ["2023-04-23T00:00:00Z"]
    end = R.end_offset(got, "updated_at", start).first().end_offset
    assert end == "2023-04-23T00:00:00Z"
    again = R.after_cursor(df, "updated_at", end)          # equal to the cursor: nothing
    assert again.count() == 0
    assert R.end_offset(again, "updated_at", end).first().end_offset == end


def test_typed_cursor_and_since_until(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00"), (3, None)],
                               "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert sorted(r.id for r in R.cursor_range(df, "ts", since="2024-01-01 00:00:00").collect()) == [2]
    assert sorted(r.id for r in R.cursor_range(df, "ts", until="2024-01-01 00:00:00").collect()) == [1, 3]
    assert R.next_page(df, 1, 2).first().next_page == 2
    assert R.next_page(df, 2, 2).first().next_page is None


def test_lookback_rereads(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-03 00:00:00")],
                               "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert R.lookback(df, "ts", "2024-01-03 00:00:00", "3 days").count() == 2
    assert R.lookback(df, "ts", "2024-01-03 00:00:00", "1 day").count() == 1


@pytest.mark.parametrize("cursor,interval,bound", [
    ("2024-01-21T12:00:00Z", "3 days", "2024-01-18T12:00:00Z"), ("2024-01-21 12:00:00.250", "12 hours", "2024-01-21 00:00:00.250"),
    ("2024-01-21T12:00:00+02:00", "1 day", "2024-01-20T12:00:00+02:00"), ("2024-01-21", "7 days", "2024-01-14")])
def test_lookback_on_text_cursors(spark, cursor, interval, bound):
    """The bound is written in the cursor's form: a row at it is dropped, one after it kept."""
    after = bound[:-1] + chr(ord(bound[-1]) + 1)
    df = spark.createDataFrame([(bound,), (after,), (bound[:10] if len(bound) > 10 else "2024-01-13",), (None,)], "c string")
    assert {r.c for r in R.lookback(df, "c", cursor, interval).collect()} == {after, None}


def test_page_slice_of_any_depth(spark):
    """Pages of all depths, with ties, nulls and repeated rows, against a sorted list."""
    values = [(i * 7 % 40, i % 5 if i % 4 else None) for i in range(83)] + [(3, None)] * 3
    df = spark.createDataFrame(values, "id int, c int").repartition(5)
    want = sorted(values, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    for page, size in ((1, 10), (2, 3), (5, 10), (9, 10), (20, 10), (1, 1000)):
        got = [tuple(r) for r in R.page_slice(df, "c", ["id"], page, size).collect()]
        assert got == want[(page - 1) * size:page * size], (page, size)


def test_link_chains_branches_cycles_and_repeats(spark):
    """Two heads that meet, a page that leads to itself, a cycle with a way in, a page landed twice, two runs
    with the same links, empty and relative links."""
    from keelson.sources.pages import link_chains
    rows = [("t", "a", "/1", "/2"), ("t", "a", "/2", "http://x/3"), ("t", "a", "/3", ""), ("t", "a", "/9", "/2"), ("t", "a", "/8", "/9"),
            ("t", "a", "/5", "/5"), ("t", "a", "/6", "/7"), ("t", "a", "/7", "/6"), ("t", "a", "/4", "/6"), ("t", "a", "/0", "/gone"),
            ("t", "a", "/3", None), ("t", "b", "/1", "/2")]
    df = spark.createDataFrame(rows, "table_name string, run_id string, request_link string, next_link string")
    got = {(r.run_id, r.request_abs[-2:]): (r.landed, r.n_before, r.tail and r.tail[-2:], r.ahead, r.position, r.status)
           for r in link_chains(df, "http://x/").collect()}
    assert got == {("a", "/1"): (1, 0, "/3", 2, 1, "ok"), ("a", "/2"): (1, 2, "/3", 1, 2, "ok"), ("a", "/3"): (2, 1, "/3", 0, 3, "end"),
                   ("a", "/9"): (1, 1, "/3", 2, 1, "ok"), ("a", "/8"): (1, 0, "/3", 3, 0, "ok"), ("a", "/5"): (1, 1, None, None, None, "cycle"),
                   ("a", "/6"): (1, 2, None, None, None, "cycle"), ("a", "/7"): (1, 1, None, None, None, "cycle"),
                   ("a", "/4"): (1, 0, None, None, None, "to_cycle"), ("a", "/0"): (1, 0, "/0", 0, 0, "unread"),
                   ("b", "/1"): (1, 0, "/1", 0, 0, "unread")}
    assert link_chains(df.limit(0), "http://x").collect() == []


def test_link_chains_rank_a_long_chain(spark):
    from keelson.sources.pages import link_chains
    df = spark.range(1500).select(F.lit("t").alias("table_name"), F.lit("r").alias("run_id"), F.concat(F.lit("/"), "id").alias("request_link"),
                                  F.when(F.col("id") < 1499, F.concat(F.lit("/"), F.col("id") + 1)).alias("next_link")).orderBy(F.rand(1))
    assert all(r.position == int(r.request_abs.rsplit("/")[-1]) for r in link_chains(df, "http://x").collect())
