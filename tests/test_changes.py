"""Change application: arrival order and batching do not change the target (E1–E4, E9),
range order gives the plain window's answer, snapshot and cursor edge cases."""

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from keelson.operators import changes as C
from keelson.operators import cursor as R
from keelson.operators import ordering
from keelson.operators.ordering import next_in_key
from keelson.operators.snapshot import snapshot_diff
from keelson.plans import inputs as I

K, S, T_ = I.EVENT_KEYS, I.EVENT_SEQ, I.EVENT_TIE


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def events(spark, sf_small):
    return I.events(spark, sf_small).cache()


@pytest.mark.parametrize("n,touched", [(2, False), (3, True), (5, True)])
def test_scd1_any_batching(spark, events, n, touched):
    one = _rows(C.scd1_upsert(None, events, K, S, T_))
    ev = I.arrival_batch(events, S, n)
    target = None
    for b in reversed(range(n)):
        target = C.scd1_upsert(target, ev.where(F.col("__batch") == b).drop("__batch"), K, S, T_,
                               only_touched=touched)
        target = target.cache()
    assert _rows(target) == one


@pytest.mark.parametrize("n", [2, 4])
def test_scd2_any_batching(spark, events, n):
    one = _rows(C.scd2_history(None, events, K, S, T_))
    ev = I.arrival_batch(events, S, n)
    hist = None
    for b in range(n - 1, -1, -1):
        hist = C.scd2_history(hist, ev.where(F.col("__batch") == b).drop("__batch"), K, S, T_).cache()
    assert _rows(hist) == one


def test_scd2_replay_is_idempotent(spark, events):
    hist = C.scd2_history(None, events, K, S, T_).cache()
    again = C.scd2_history(hist, events, K, S, T_)
    assert _rows(again) == _rows(hist)


def test_scd1_delete_beats_older_upsert(spark):
    ts = datetime.datetime(2024, 1, 1)
    ups = spark.createDataFrame([(1, ts, "a"), (1, ts + datetime.timedelta(seconds=1), "b")],
                                "k int, s timestamp, v string")
    dels = spark.createDataFrame([(1, ts + datetime.timedelta(seconds=1), None)], "k int, s timestamp, v string")
    state = C.scd1_with_deletes(None, ups, dels, ["k"], "s")
    assert C.live(state).count() == 0          # equal sequence: the delete wins (D5)
    late = spark.createDataFrame([(1, ts, "old")], "k int, s timestamp, v string")
    state2 = C.scd1_with_deletes(state, late, dels.limit(0), ["k"], "s")
    assert C.live(state2).count() == 0         # an older upsert does not resurrect it (D8)


def test_tombstone_retention(spark):
    ts = datetime.datetime(2024, 1, 1)
    ups = spark.createDataFrame([(1, ts, "a"), (2, ts, "b")], "k int, s timestamp, v string")
    dels = spark.createDataFrame([(1, ts + datetime.timedelta(days=1), None)], "k int, s timestamp, v string")
    state = C.scd1_with_deletes(None, ups, dels, ["k"], "s").cache()
    assert state.where(F.col("_op") == "delete").count() == 1
    kept = C.expire_tombstones(state, "s", "2024-01-01 12:00:00")
    assert kept.where(F.col("_op") == "delete").count() == 1
    gone = C.expire_tombstones(state, "s", "2024-01-03 00:00:00")
    assert gone.where(F.col("_op") == "delete").count() == 0 and gone.count() == 1


def test_null_sequence_fails(spark):
    df = spark.createDataFrame([(1, None)], "k int, s timestamp")
    with pytest.raises(Exception, match="sequence"):
        C.latest_per_key(df, ["k"], "s").collect()


@pytest.mark.parametrize("kind", ["timestamp", "string", "bigint"])
def test_next_in_key_spreads_a_hot_key(spark, kind, monkeypatch):
    """Sequences of any type: the plain window's answer, with the hot key in many ranges."""
    ts = datetime.datetime(2024, 1, 1)
    rows = [(0 if i % 3 else i if i % 2 else None, ts + datetime.timedelta(seconds=i), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, s timestamp, t long").withColumn(
        "s", F.col("s").cast(kind) if kind != "string" else F.date_format("s", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    w = Window.partitionBy("k").orderBy("s", "t")
    want = sorted((tuple(r) for r in df.withColumn("n", F.lead(F.struct("s", "t")).over(w)).collect()), key=str)
    got = next_in_key(df, ["k"], ["s", "t"], out="n")
    assert sorted((tuple(r) for r in got.select("k", "s", "t", "n").collect()), key=str) == want
    monkeypatch.setattr(ordering, "HOT_ROWS", 100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = df.repartitionByRange("k", "s", "t").groupBy(F.spark_partition_id().alias("p")).count().collect()
        again = next_in_key(df, ["k"], ["s", "t"], out="n")
        assert sorted((tuple(r) for r in again.select("k", "s", "t", "n").collect()), key=str) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(ranged) > 1 and max(r["count"] for r in ranged) < 1500     # 2000 rows of one key, split


FEED = [(1, 1, "upsert", "a"), (1, 5, "delete", None), (1, 10, "upsert", "c"), (1, 10, "upsert", "d"), (2, 3, "delete", None),
        (2, 3, "upsert", "x"), (None, 2, "upsert", "n"), (None, 4, "upsert", "m"), (3, 7, "upsert", "q"), (3, 7, "upsert", "q")]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.permutations(FEED), st.lists(st.integers(0, len(FEED)), max_size=3))
def test_any_split_and_order_with_deletes(spark, feed, cuts):
    """E3 and E4 over any batches in any order: equal sequences without a tie, null keys,
    replayed rows and deletes that arrive before what they delete."""
    schema = "k int, s int, _op string, v string"

    def run(batches, step, view):
        state = None
        for rows in batches:
            df = spark.createDataFrame(rows, schema)
            ups, dels = (df.where(F.col("_op") == op).drop("_op") for op in ("upsert", "delete"))
            state = step(state, ups, dels)
            state = spark.createDataFrame(state.collect(), state.schema)
        return sorted((tuple(r) for r in view(state).collect()), key=str)

    edges = [0, *sorted(cuts), len(feed)]
    batches = [feed[a:b] for a, b in zip(edges, edges[1:]) if b > a]
    for touched in (False, True):
        one = lambda s, u, d: C.scd1_with_deletes(s, u, d, ["k"], "s", only_touched=touched)  # noqa: E731, B023
        assert run(batches, one, C.live) == run([FEED], one, C.live)
    two = lambda s, u, d: C.scd2_with_deletes(s, u, d, ["k"], "s")
    got = run(batches, two, C.live_history)
    assert got == run([FEED], two, C.live_history)
    assert (1, 1, "a", 1, 5) in got and len(got) == 6 + 1


def test_two_versions_of_one_sequence_are_kept(spark):
    one = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c")], "k int, s int, v string")
    whole = _rows(C.scd2_history(None, one, ["k"], "s"))
    parts = C.scd2_history(C.scd2_history(None, one.where("v <> 'b'"), ["k"], "s"), one.where("v = 'b'"), ["k"], "s")
    assert len(whole) == 3 and _rows(parts) == whole


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 1, "a")], "k int, s int, v string")
    new = spark.createDataFrame([(None, 2, "b")], "k int, s int, v string")
    for touched in (False, True):
        assert _rows(C.scd1_upsert(df, new, ["k"], "s", only_touched=touched)) == [(None, 2, "b")]


def test_touch_upsert_of_repeated_keys(spark):
    target = spark.createDataFrame([(1, "2024-01-01", "old"), (9, "2024-01-01", "stay")], "k int, at string, v string")
    rows = spark.createDataFrame([(1, None, "x"), (1, "2024-03-01", "y"), (2, "2024-02-01", "n"), (3, None, "m")], target.schema)
    got = _rows(C.touch_upsert(target, rows, ["k"], "at", "2024-06-01"))
    assert got == [(1, "2024-06-01", "y"), (2, "2024-02-01", "n"), (3, "2024-06-01", "m"), (9, "2024-01-01", "stay")]


def test_quarantine_splits_off_rows_without_sequence(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "k int, s int")
    good, bad = C.quarantine(df, "s")
    assert _rows(good) == [(1, 5)] and _rows(bad) == [(2, None)]


def test_merge_into_needs_a_table_with_row_operations(spark):
    df = spark.createDataFrame([(1, 5, "a")], "k int, s int, v string")
    with pytest.raises(Exception):
        C.merge_into(spark, "no_such_table", df, ["k"], "s")


def test_snapshot_history_has_one_join(spark):
    from keelson.operators.snapshot import snapshot_scd1, snapshot_scd2
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    b = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], "k int, v string")
    hist = snapshot_scd2(snapshot_scd2(None, a, ["k"], 1), b, ["k"], 2)
    assert _rows(hist.fillna(-1)) == [(1, "a", 1, -1), (2, "b", 1, 2), (2, "x", 2, -1), (3, "c", 1, 2), (4, "d", 2, -1)]
    plan = hist._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join ") == 1
    assert "Join" not in snapshot_scd1(a, b, ["k"])._jdf.queryExecution().sparkPlan().toString()


def test_snapshot_diff_classes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "n")], "k int, v string")
    got = {r.k: r.change for r in snapshot_diff(old, new, ["k"]).collect()}
    assert got == {1: "same", 2: "update", 3: "same", 4: "insert"}
    got = {r.k: r.change for r in snapshot_diff(new, old, ["k"]).collect()}
    assert got[4] == "delete"


def test_cursor_text_rules(spark):
    df = spark.createDataFrame([("2024-05-01",), ("2024-07-01",), ("",), (None,)], "c string")
    assert sorted("~" if r.c is None else r.c for r in R.after_cursor(df, "c", "2024-06-01").collect()) == ["", "2024-07-01", "~"]
    assert R.after_cursor(df, "c", "2024-07-01").where(F.col("c") != "").count() == 0
    assert R.end_offset(df.limit(0), "c").collect()[0].end_offset == ""
    assert R.end_offset(df, "c", "2024-06-01").collect()[0].end_offset == "2024-07-01"


def test_page_slice_rejects_page_zero(spark, events):
    with pytest.raises(ValueError):
        R.page_slice(events, S, K, 0, 10)


def test_batch_cap_includes_ties(spark):
    df = spark.createDataFrame([(i, i // 3) for i in range(10)], "id int, c int")
    assert R.batch_cap(df, "c", 4).count() == 6    # cut at c=1, the whole tie group kept


def test_match_filters_allow_list(spark, events):
    with pytest.raises(ValueError):
        R.match_filters(events, {"props": "x"}, allowed=["event_type"])


@pytest.mark.parametrize("hot_rows", [10, 10 ** 9])
def test_marks_and_successors_across_ranges(spark, monkeypatch, hot_rows):
    """The last mark at or before a row, and the next row, in one key; with and without ranges."""
    rows = [(i % 7 and 1 or i % 3 or None, i, i * 10 if i % 50 == 0 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, s int, m int")
    w = Window.partitionBy("k").orderBy("s")
    want = df.select("k", "s", F.lead("s").over(w).alias("n"),
                     F.last("m", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"))
    monkeypatch.setattr(ordering, "HOT_ROWS", hot_rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordering.around_in_key(df, ["k"], ["s"], "n", mark=F.col("m"), mark_out="b")
        got = got.select("k", "s", F.col("n.s").alias("n"), F.col("b").alias("m"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_late_batch_touches_only_its_neighbours(spark):
    """Versions that no row of the batch falls into pass through; ends are the neighbours'."""
    state = C.scd2_history(None, spark.createDataFrame([(k, s * 10, f"{k}-{s}") for k in range(20) for s in range(50)],
                                                       "k int, s int, v string"), ["k"], "s").cache()
    feed = spark.createDataFrame([(3, 105, "late"), (3, 495, "new"), (4, -5, "first"), (99, 1, "other"), (5, 200, "same time")],
                                 "k int, s int, v string")
    apart, near = C.neighbours(state, feed, ["k"], "s")
    assert sorted((r.k, r.s) for r in near.collect()) == [(3, 100), (3, 490), (5, 190), (5, 200)]
    assert apart.count() == 20 * 50 - 4
    out = {(r.k, r.s, r.v): r["__END_AT"] for r in C.scd2_history(state, feed, ["k"], "s").collect()}
    assert (out[3, 100, "3-10"], out[3, 105, "late"], out[3, 490, "3-49"], out[3, 495, "new"]) == (105, 110, 495, None)
    assert (out[4, -5, "first"], out[99, 1, "other"]) == (0, None)
    assert {out[5, 200, "5-20"], out[5, 200, "same time"]} == {200, 210} and len(out) == 1005


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), st.integers(0, 12), st.sampled_from("ab")), min_size=1, max_size=25),
       st.integers(1, 4), st.sampled_from(["int", "string", "timestamp"]))
def test_splices_equal_one_pass(spark, rows, n, kind):
    df = spark.createDataFrame([(k, s, v, i % n) for i, (k, s, v) in enumerate(rows)], "k int, s int, v string, b int")
    df = df.withColumn("s", F.lpad(F.col("s").cast("string"), 3, "0") if kind == "string" else F.col("s").cast(kind))
    one = C.scd2_history(None, df.drop("b"), ["k"], "s")
    state = None
    for b in range(n):
        state = C.scd2_history(state, df.where(F.col("b") == b).drop("b"), ["k"], "s").cache()
    assert sorted(map(str, state.collect())) == sorted(map(str, one.collect()))


def test_maps_variants_nested_and_null_keys(spark):
    """E1, E2, E7, E12 on columns that Spark can't hash or compare, with null keys and no tie."""
    def feed(rows):
        df = spark.createDataFrame(rows, "k int, s int, m map<string,int>, j string")
        return df.select("k", "s", "m", F.parse_json("j").alias("j"), F.array(F.struct(F.col("m").alias("m"))).alias("n"))

    a = feed([(1, 1, {"x": 1, "y": 2}, '{"a":1,"b":[1]}'), (1, 1, {"y": 2, "x": 1}, '{"b":[1],"a":1}'), (None, 2, None, None)])
    b = feed([(1, 3, {"x": 5}, "7"), (None, 2, None, None), (None, 1, {}, "[]")])
    latest = {r.k: (r.s, r.m) for r in C.scd1_upsert(a, b, ["k"], "s").collect()}
    assert latest == {1: (3, {"x": 5}), None: (2, None)}
    hist = C.scd2_history(C.scd2_history(None, a, ["k"], "s").cache(), b, ["k"], "s").collect()
    assert sorted((r.k or 0, r.s, r["__END_AT"] or 0) for r in hist) == [(0, 1, 2), (0, 2, 0), (1, 1, 3), (1, 3, 0)]
    touched = C.touch_upsert(a.dropDuplicates(["k", "s"]), b, ["k"], "s", 9)
    assert sorted((r.k or 0, r.s) for r in touched.collect()) == [(0, 9), (1, 9)]
    old, new = a.where("k is null or s = 1").dropDuplicates(["k"]), feed([(1, 1, {"y": 2, "x": 1}, '{"b":[1],"a":1}'), (None, 2, None, "1")])
    assert {r.k: r.change for r in snapshot_diff(old, new, ["k"]).collect()} == {1: "same", None: "update"}


def test_expiry_keeps_live_rows_without_an_op(spark):
    state = spark.createDataFrame([(1, 5, None), (2, 5, "upsert"), (3, 5, "delete"), (4, 50, "delete")], "k int, s int, _op string")
    assert sorted(r.k for r in C.expire_tombstones(state, "s", 10).collect()) == [1, 2, 4]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.one_of(st.none(), st.integers(0, 40)), st.tuples(st.sampled_from("ab"), st.integers(0, 2)), max_size=30),
       st.dictionaries(st.one_of(st.none(), st.integers(0, 40)), st.tuples(st.sampled_from("ab"), st.integers(0, 2)), max_size=30),
       st.sampled_from([1, 3, 4096]))
def test_checksum_changes_equal_the_full_comparison(spark, old, new, buckets):
    from keelson.operators.checksums import checksum_changes
    from keelson.operators.snapshot import snapshot_changes
    a, b = (spark.createDataFrame([(k, v, {"m": m} if m else None) for k, (v, m) in rows.items()], "k int, v string, m map<string,int>")
            for rows in (old, new))
    assert sorted(map(str, checksum_changes(a, b, ["k"], buckets).collect())) == sorted(map(str, snapshot_changes(a, b, ["k"]).collect()))


def test_checksums_join_only_the_changed_buckets(spark):
    from keelson.operators.checksums import changed_rows
    old = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    new = old.where("k <> 5").withColumn("v", F.when(F.col("k") % 2000 == 9, -1).otherwise(F.col("v")))
    a, b = changed_rows(old, new, ["k"])
    n, m = a.count(), b.count()
    assert 101 <= n <= 101 * 100 and n - 1 == m             # 101 changed keys, each with its few neighbours
    assert changed_rows(old, old, ["k"])[0].count() == 0
