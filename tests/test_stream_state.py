"""Changes resolved in the state store: restart, late changes before and after the bound, expiry."""

import datetime

import pytest
from pyspark.sql import functions as F

from keelson.session import work_dir
from keelson.streaming import flows as FL
from keelson.streaming.state import changed_keys

DAY0 = datetime.datetime(2024, 1, 1)
SCHEMA = "k long, s timestamp, v string, m map<string,int>, _op string"


def row(k, day, v, op="upsert"):
    return (k, DAY0 + datetime.timedelta(days=day, microseconds=7), v, {"x": 1} if k else None, op)


class Run:
    def __init__(self, spark):
        self.spark, self.base, self.seen, self.q = spark, work_dir(spark, "t-state"), [], None

    def batch(self, *rows):
        """Land one file, run until caught up, and return what was emitted."""
        self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.base}/src")
        out = []
        stream = FL.file_stream(self.spark, f"{self.base}/src", self.spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
        self.q = FL.run_available(changed_keys(stream, ["k"], "s", "10 days"), f"{self.base}/chk", mode="update",
                                  batch_fn=lambda df, i: out.extend(tuple(r) for r in df.collect()))
        return sorted(((r[0] or 0, r[2], r[4]) for r in out), key=str)

    def states(self):
        return self.q.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_late_changes_expiry_and_restart(spark):
    run = Run(spark)
    assert run.batch(row(1, 0, "a"), row(1, 2, "b"), row(2, 1, "c"), row(None, 1, "n")) == [(0, "n", "upsert"), (1, "b", "upsert"), (2, "c", "upsert")]
    assert run.batch(row(1, 2, "b"), row(1, 1, "old"), row(2, 5, None, "delete")) == [(2, None, "delete")]   # replay, older, delete
    assert run.batch(row(2, 4, "late")) == []                                      # before the bound: the tombstone is there
    assert run.states() == 3
    assert run.batch(row(3, 30, "z")) == [(3, "z", "upsert")]                      # the watermark passes the tombstone
    assert run.states() == 3                                                       # 1, 3 and null: 2 has expired
    assert run.batch(row(2, 4, "late")) == []                                      # after the bound: too late to be read
    assert run.batch(row(2, 40, "again"), row(1, 2, "b")) == [(2, "again", "upsert")]


def test_keys_share_groups(spark, monkeypatch):
    """Many keys in few groups: each key has its own winner, and its tombstone ends by itself."""
    monkeypatch.setattr("keelson.streaming.state.BUCKETS", 3)
    run, keys = Run(spark), range(1, 41)
    assert len(run.batch(*[row(k, 1, "a") for k in keys], row(None, 1, "n"))) == 41
    assert run.states() <= 3
    got = run.batch(*[row(k, 0, "old") for k in keys], *[row(k, 2 + k % 2, None, "delete") for k in range(1, 5)], row(9, 4, "b"), row(9, 4, "b"))
    assert got == sorted([(k, None, "delete") for k in range(1, 5)] + [(9, "b", "upsert")], key=str)
    assert run.batch(*[row(k, 0.5, "late") for k in keys]) == []             # before the bound: winners and tombstones hold
    assert run.batch(row(50, 12, "z"), row(2, 2, "late")) == [(50, "z", "upsert")]
    assert run.batch(row(50, 12, "z"), row(3, 2, "late"), row(2, 3, "again")) == [(2, "again", "upsert")]
    assert run.batch(row(60, 90, "z")) == [(60, "z", "upsert")]
    assert run.batch(*[row(k, 85, "c") for k in keys], row(None, 85, "m")) == sorted([(k, "c", "upsert") for k in keys] + [(0, "m", "upsert")], key=str)
    assert run.states() <= 3


def test_a_group_of_expired_keys_leaves_the_state(spark, monkeypatch):
    monkeypatch.setattr("keelson.streaming.state.BUCKETS", 1)
    run = Run(spark)
    assert len(run.batch(row(1, 1, None, "delete"), row(2, 3, None, "delete"))) == 2
    assert run.states() == 1
    assert run.batch(row(1, 30, None, "delete")) == [(1, None, "delete")]
    assert run.batch(row(1, 80, None, "delete")) == [(1, None, "delete")]
    assert run.batch(row(1, 80, None, "delete")) == [] and run.states() == 1


def test_keys_are_told_apart_as_by_group_by(spark):
    """Null, empty and quoted texts differ, zeros and NaNs do not; a key of two columns is not their concatenation."""
    schema = "a string, b double, s timestamp"
    rows = [(a, b, DAY0 + datetime.timedelta(days=i)) for i, (a, b) in enumerate([
        (None, 0.0), (None, -0.0), ("", 0.0), ('"', 1.0), ('"', None), ("null", None), (None, None), ("x", float("nan")), ("x", float("nan")), ('x","k1":1.0', 1.0)])]
    base, out = work_dir(spark, "t-state-keys"), []
    df = spark.createDataFrame(rows, schema)
    df.coalesce(1).write.parquet(f"{base}/src")
    FL.run_available(changed_keys(FL.file_stream(spark, f"{base}/src", df.schema), ["a", "b"], "s", "100 days"), f"{base}/chk", mode="update",
                     batch_fn=lambda d, i: out.extend(d.collect()))
    want = df.groupBy("a", "b").agg(F.max("s").alias("s")).collect()
    assert len(want) == 8 and sorted(r.s for r in out) == sorted(r.s for r in want)


def test_rows_come_out_as_they_went_in(spark):
    run = Run(spark)
    run.spark.createDataFrame([row(2 ** 60 + 1, 0, 'q"\n')], SCHEMA).coalesce(1).write.parquet(f"{run.base}/src")
    out = []
    stream = FL.file_stream(spark, f"{run.base}/src", spark.createDataFrame([], SCHEMA).schema)
    FL.run_available(changed_keys(stream, ["k"], "s", "10 days"), f"{run.base}/chk", mode="update",
                     batch_fn=lambda df, i: out.extend(df.collect()))
    assert [tuple(r) for r in out] == [row(2 ** 60 + 1, 0, 'q"\n')]


def test_sequences_must_be_times_and_not_null(spark):
    df = spark.createDataFrame([(1, 1)], "k int, s int")
    with pytest.raises(ValueError, match="timestamp"):
        changed_keys(df, ["k"], "s", "1 day")
    with pytest.raises(ValueError, match="whole number"):
        changed_keys(df.withColumn("s", F.current_timestamp()).withColumn("t", F.lit("x")), ["k"], "s", "1 day", "t")
    run = Run(spark)
    with pytest.raises(Exception, match="sequence"):
        run.batch((1, None, "a", None, "upsert"))
