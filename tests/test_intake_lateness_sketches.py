"""Error budget and quarantine of streams (C13, D6), measured lateness (F5), merged profiles."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from keelson.functions.coerce import coerce_json
from keelson.operators.cursor import lookback
from keelson.operators.lateness import LatenessLog, arrival_numbers
from keelson.operators.sketches import QUANTILES, ProfileLog
from keelson.plans.ingest import ParquetTables, ingest, plan, read_destination, read_quarantine
from keelson.session import work_dir
from keelson.streaming import flows as FL
from keelson.streaming.intake import REASONS, REJECTED, Intake
from keelson.streaming.target import ChangeTable

SCHEMA = "k int, seq int, v string"


def _land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _stream(spark, folder, **caps):
    return FL.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, **caps)


def test_accepted_and_rejected_rows_are_all_rows(spark):
    base = work_dir(spark, "t")
    for k in range(3):
        _land(spark, f"{base}/src", [(i, None if i % 5 == 0 else 10 * k + i, "bad" if i % 7 == 0 else "ok") for i in range(1, 21)])
    table = ChangeTable(spark, f"{base}/target", ["k"], "seq")
    intake = Intake(f"{base}/intake", {"bad value": "v = 'bad'", "never": F.col("v").isNull()}, seq="seq", budget=0.4, sink=FL.ChangeSink(table))
    FL.run_available(_stream(spark, f"{base}/src", files_per_batch=1), f"{base}/chk", batch_fn=intake)
    rows = intake.rows(spark).collect()
    assert len(rows) == 60 and sum(r[REJECTED] for r in rows) == 3 * 6
    for r in rows:
        assert r[REASONS] == (["seq: no sequence"] if r.k % 5 == 0 else []) + (["bad value"] if r.k % 7 == 0 else [])
    assert {(r.rows, r.n_rejected, r.status) for r in intake.counts(spark).collect()} == {(20, 6, "accepted")}
    assert {(r.k, r.seq) for r in table.read().collect()} == {(i, 20 + i) for i in range(1, 21) if i % 5 and i % 7}
    assert intake.quarantine(spark).count() == 18 and intake.accepted(spark).columns == ["k", "seq", "v"]


def test_the_budget_stops_the_run_and_a_larger_one_goes_on(spark):
    base = work_dir(spark, "t")
    _land(spark, f"{base}/src", [(i, i, "ok") for i in range(10)])
    rules = {"bad value": "v = 'bad'"}
    table = ChangeTable(spark, f"{base}/target", ["k"], "seq")
    intake = Intake(f"{base}/intake", rules, "seq", 0.2, FL.ChangeSink(table))
    run = lambda i: FL.run_available(_stream(spark, f"{base}/src"), f"{base}/chk", batch_fn=i)
    run(intake)
    _land(spark, f"{base}/src", [(i, i, "bad" if i % 2 else "ok") for i in range(10, 30)])
    with pytest.raises(Exception, match="10 of 30 rows rejected, budget 0.2"):
        run(intake)
    assert intake.rows(spark).count() == 10 and table.read().count() == 10      # nothing of the batch counts
    assert sorted(r.status for r in intake.counts(spark).collect()) == ["accepted", "stopped"]
    run(Intake(f"{base}/intake", rules, "seq", 0.5, FL.ChangeSink(table)))
    assert intake.rows(spark).count() == 30 and table.read().count() == 20
    assert [r.status for r in intake.counts(spark).collect()] == ["accepted"] * 2


def test_messages_of_a_coercion_reject_rows(spark):
    base = work_dir(spark, "t")
    _land(spark, f"{base}/src", [(1, 1, '{"n": 1}'), (2, 1, '{"n": "x"}'), (3, 1, "no json"), (4, 1, None)])
    from pyspark.sql import types as T
    typed = coerce_json(_stream(spark, f"{base}/src"), "v", T.StructType([T.StructField("n", T.LongType())]), "permissive", ["k"])
    intake = Intake(f"{base}/intake")
    FL.run_available(typed, f"{base}/chk", batch_fn=intake)
    assert {r.k: r[REJECTED] for r in intake.rows(spark).collect()} == {1: False, 2: True, 3: True, 4: False}
    assert all(r[REASONS] for r in intake.quarantine(spark).collect())


def test_own_names_and_bad_budgets_are_refused(spark):
    base = work_dir(spark, "t")
    with pytest.raises(ValueError):
        Intake(base, budget=1.5)
    spark.createDataFrame([(1,)], "k int").withColumn(REASONS, F.lit("x")).write.parquet(f"{base}/src")
    schema = spark.read.parquet(f"{base}/src").schema
    with pytest.raises(Exception, match="the intake's own"):
        FL.run_available(FL.file_stream(spark, f"{base}/src", schema), f"{base}/chk", batch_fn=Intake(f"{base}/i"))


@pytest.mark.parametrize("scd", ["SCD_TYPE_1", "APPEND_ONLY"])
def test_ingest_rejects_by_its_spec(spark, scd):
    base = work_dir(spark, "t")
    _land(spark, f"{base}/t.parquet", [(1, 1, "ok"), (1, 2, "bad"), (2, 1, "ok"), (3, None, "ok")])
    conn = ParquetTables(spark, base, {"t": {"primary_keys": ["k"], "cursor_field": "seq", "ingestion_type": "cdc"}})
    conf = {"scd_type": scd, "reject_when": {"bad value": "v = 'bad'"}, "error_budget": 0.5}
    spec = lambda **more: {"objects": [{"table": {"source_table": "t", "table_configuration": {**conf, **more}}}]}
    p = ingest(spark, spec(), conn, f"{base}/lake")["t"]
    kept = sorted((r.k, r.seq) for r in read_destination(spark, p).collect() if r.seq is not None)
    assert kept == [(1, 1), (2, 1)]
    assert read_quarantine(spark, p).count() == (1 if scd == "APPEND_ONLY" else 2)
    with pytest.raises(Exception, match="rows rejected"):
        ingest(spark, spec(error_budget=0.1), conn, f"{base}/strict")
    conn.meta["t"]["ingestion_type"] = "snapshot"
    with pytest.raises(ValueError, match="snapshot"):
        plan({"objects": [{"table": {"source_table": "t", "table_configuration": {"error_budget": 0.1}}}]}, conn, base)


def _arrivals(rnd, n=400):
    """Seconds after a start, most of them in order of arrival, some of them late; repeated and missing values."""
    rows = []
    for i in range(n):
        at = 1000 * (i // 50) + rnd.randrange(1000) - (rnd.randrange(1, 5000) if rnd.random() < 0.2 else 0)
        rows.append((i // 50, None if rnd.random() < 0.02 else at))
    return rows + rows[60:70]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "bigint"])
def test_the_interval_reads_the_wanted_share_of_late_rows_again(spark, kind):
    rows = _arrivals(random.Random(8))
    start = dt.datetime(2024, 1, 1)
    value = lambda s: s if s is None or kind == "bigint" else start + dt.timedelta(seconds=s)
    df = spark.createDataFrame([(b, value(s)) for b, s in rows], f"b int, t {kind}")
    log = LatenessLog(spark, work_dir(spark, "t"), "t")
    for b in [0, 1, 2, 2, 3, 4, 5, 6, 7, 7]:                # a batch again changes nothing
        log.add(df.where(f"b = {b}"), b)
    late, newest = [], None
    for b in range(8):
        mine = [s for c, s in rows if c == b and s is not None]
        late += [newest - s for s in mine if newest is not None and s <= newest]
        newest = max([*mine, *([] if newest is None else [newest])])
    unit = 1 if kind == "bigint" else 1_000_000
    assert sum(r.n for r in log.histogram().collect()) == len(late) > 50
    for recall in (0.5, 0.9, 1.0):
        reach = log.reach(recall)
        exact = sorted(late)[-(-int(recall * len(late) * 1000) // 1000) - 1]
        assert sum(x * unit < reach for x in late) >= recall * len(late)
        assert reach <= exact * unit * (1 + 1 / 64) + 1
    if kind != "bigint":
        top = value(2000)
        again = lookback(df, "t", str(top), log.interval(0.9)).where("t is not null")
        assert again.count() == sum(s is not None and (2000 - s) * unit < log.reach(0.9) for _, s in rows)


def test_lateness_without_late_rows_and_of_other_columns(spark):
    log = LatenessLog(spark, work_dir(spark, "t"), "t")
    assert log.reach(0.9) is None and log.interval(1.0) is None
    log.add(spark.createDataFrame([], "t bigint"), 0)
    log.add(spark.createDataFrame([(1,), (None,)], "t bigint"), 1)
    assert log.reach(0.9) is None
    with pytest.raises(ValueError):
        log.reach(0)
    with pytest.raises(ValueError):
        log.add(spark.createDataFrame([("x",)], "t string"), 2)


def test_arrival_by_the_time_of_files(spark):
    folder = work_dir(spark, "t")
    _land(spark, folder, [(1, 1, "a")])
    _land(spark, folder, [(2, 1, "b"), (3, 1, None)])
    files = spark.read.parquet(folder).select("*", "_metadata.file_modification_time")
    got = {r.k: r.arrival for r in arrival_numbers(files, F.col("file_modification_time")).collect()}
    assert got == {1: 1, 2: 2, 3: 2}


def test_merged_profiles_are_within_their_errors(spark):
    rnd = random.Random(9)
    rows = [(rnd.randrange(8000), rnd.choice([None, 1, 2]) if rnd.random() < 0.1 else 1, i, rnd.gauss(0, 100)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "a int, b int, seq int, x double").withColumn("p", F.pmod(F.xxhash64("seq"), F.lit(5)))
    log = ProfileLog(spark, work_dir(spark, "t"), ["a", "b"], "seq", ["x"])
    for b in (3, 0, 4, 1, 2, 1):
        log.add(df.where(F.col("p") == b), b)
    got = log.profile().first()
    keys = {(a, b) for a, b, _, _ in rows if b is not None}
    assert (got.row_count, got.null_keys) == (len(rows), sum(b is None for _, b, _, _ in rows))
    assert (got.min_cursor, got.max_cursor, got.x_n) == (0, len(rows) - 1, len(rows))
    assert abs(got.distinct_keys - len(keys)) <= 0.04 * len(keys)
    xs = sorted(x for *_, x in rows)
    for q, x in zip(QUANTILES, got.x_quantiles):
        assert abs(sum(v <= x for v in xs) / len(xs) - q) <= 0.03


def test_a_new_batch_reads_no_earlier_rows(spark):
    base = work_dir(spark, "t")
    log = ProfileLog(spark, f"{base}/log", ["k"], "seq")
    _land(spark, f"{base}/first", [(1, 1, "a"), (2, 5, "b")])
    log.add(spark.read.parquet(f"{base}/first"), 0)
    files = {f.split("/")[-1] for f in log.profile().inputFiles()}
    log.add(spark.createDataFrame([(2, 9, "c"), (None, 0, "d")], SCHEMA), 1)
    r = log.profile().first()
    assert (r.row_count, r.null_keys, r.distinct_keys, r.min_cursor, r.max_cursor) == (4, 1, 2, 0, 9)
    assert files and all("first" not in f for f in log.profile().inputFiles())


def test_profiles_of_empty_tables_and_bad_columns(spark):
    log = ProfileLog(spark, work_dir(spark, "t"), [], None, ["x"])
    log.add(spark.createDataFrame([], "x double"), 0)
    log.add(spark.createDataFrame([(None,), (float("nan"),)], "x double"), 1)
    r = log.profile().first()
    assert (r.row_count, r.distinct_keys, r.x_n, r.x_quantiles) == (2, None, 0, None)
    with pytest.raises(ValueError):
        log.add(spark.createDataFrame([("t",)], "x string"), 2)
    with pytest.raises(ValueError):
        ProfileLog(spark, work_dir(spark, "t"), ["k"]).add(spark.createDataFrame([(1,)], "x int"), 0)
