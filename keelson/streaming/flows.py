"""Structured Streaming flows.

Every flow reads files with ``spark.readStream`` (offsets and the exact file list of each
micro-batch live in the checkpoint) and runs with ``trigger(availableNow=True)``: it
processes what is there and stops, and the next run resumes at the checkpoint. Change
flows write each micro-batch with ``foreachBatch`` to a ``ChangeTable`` under the id of the
streaming query and of the batch, so a batch that is offered again replaces itself.

The given tables are streamed as they are, by a filter on their file names; nothing is
copied first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from keelson.functions.canonical import row_hash
from keelson.operators import changes as C
from keelson.plans import inputs as I
from keelson.session import checkpointed, work_dir
from keelson.streaming.target import ChangeTable, SnapshotTable


def snapshot_scan(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Batch read of a whole table."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def table_stream(spark: SparkSession, folder: str, table: str, **caps) -> DataFrame:
    """S3: the table ``<folder>/<table>.parquet`` (a file or a folder of files) as a stream."""
    path = f"{folder.rstrip('/')}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(fs_path).isDirectory():
        return file_stream(spark, path, schema, **caps)
    return file_stream(spark, folder, schema, glob=f"{table}.parquet", **caps)


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None,
                bytes_per_batch: int | None = None, glob: str | None = None) -> DataFrame:
    """Incremental read of a folder of files; resumes from the checkpoint of its query.

    A micro-batch is capped by file count or by bytes (one of the two); a row-exact cap is
    ``keelson.operators.cursor.batch_cap`` on a cursor.
    """
    if files_per_batch and bytes_per_batch:
        raise ValueError("cap a micro-batch by files or by bytes, not both")
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        r = r.option("maxBytesPerTrigger", bytes_per_batch)
    return r.parquet(path)


def run_available(stream: DataFrame, checkpoint: str, *, sink: str | None = None,
                  batch_fn=None, name: str | None = None, mode: str = "append"):
    """Run until caught up (availableNow), then stop. Raises the query's failure."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode(mode)
    if name:
        w = w.queryName(name)
    if batch_fn is not None:
        w = w.foreachBatch(batch_fn)
    else:
        w = w.format("parquet").option("path", sink)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def query_id(spark: SparkSession) -> str:
    """Id of the streaming query on whose thread this runs: new with every new checkpoint."""
    found = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("not inside a streaming query")
    return found


class ChangeSink:
    """K2: ``foreachBatch`` function adding each micro-batch to a change table.

    ``after_write`` runs after a batch is written and before it counts as done (tests use
    it to fail there).
    """

    def __init__(self, table: ChangeTable, after_write=None):
        self.table, self.after_write = table, after_write

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.table.write(batch, query_id(batch.sparkSession), batch_id)
        if self.after_write:
            self.after_write(batch_id)


class RowCap:
    """T8, row-exact: ``foreachBatch`` function that appends each micro-batch to ``path`` in
    pieces of at most ``n`` rows by cursor, as folders ``batch=<query>-<batch id>/piece=<k>``.

    Rows of one cursor value stay together, so a piece may exceed ``n`` by its last group of
    ties; rows without a cursor value are the last piece. One job counts the rows by cursor
    value, range by range; a value's piece follows from the number of rows before it, and one
    more job writes all pieces: each task has a range of them, so that a piece is one file, or
    several where ranges meet and where it is larger than a range. A batch that is offered again
    replaces its own folder only.
    """

    def __init__(self, cursor: str, n: int, path: str):
        if n < 1:
            raise ValueError("n must be at least 1")
        self.cursor, self.n, self.path = cursor, n, path.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        place = f"{self.path}/batch={query_id(batch.sparkSession)}-{batch_id}"
        pieces = self.pieces(batch).repartitionByRange("piece", row_hash(batch))
        pieces.write.mode("overwrite").partitionBy("piece").parquet(place)

    def pieces(self, batch: DataFrame) -> DataFrame:
        """``batch`` with the number of each row's piece."""
        if "piece" in batch.columns:
            raise ValueError("the column name piece is the sink's own")
        c = F.col(self.cursor)
        counts = batch.where(c.isNotNull()).groupBy(self.cursor).agg(F.count(F.lit(1)).alias("__n"))
        ranged = checkpointed(counts.repartitionByRange(self.cursor).withColumn("__r", F.spark_partition_id()))
        ranges = Window.orderBy("__r")  # one row a range
        before = (ranged.groupBy("__r").agg(F.sum("__n").alias("__rn"))
                  .select("__r", F.coalesce(F.sum("__rn").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b")))
        inside = Window.partitionBy("__r").orderBy(self.cursor).rowsBetween(Window.unboundedPreceding, -1)
        at = F.col("__b") + F.coalesce(F.sum("__n").over(inside), F.lit(0))  # rows before this value
        numbered = (ranged.join(before, "__r").select(self.cursor, F.floor(at / self.n).cast("bigint").alias("piece")))
        last = numbered.agg(F.max("piece")).first()[0]
        rest = F.lit(0 if last is None else last + 1).cast("bigint")
        return batch.join(numbered, self.cursor, "left").withColumn("piece", F.coalesce("piece", rest))


# ---------------------------------------------------------------- runs on the given tables
def _table(spark: SparkSession, base: str, mode: str) -> ChangeTable:
    return ChangeTable(spark, f"{base}/target", I.EVENT_KEYS, I.EVENT_SEQ, I.EVENT_TIE, mode)


def stream_scd(spark: SparkSession, sf_dir: str, mode: str = "scd1", files_per_batch: int = 5) -> DataFrame:
    """T4/T5: events → SCD 1 or SCD 2 table."""
    base = work_dir(spark, f"stream-{mode}")
    table = _table(spark, base, mode)
    run_available(table_stream(spark, sf_dir, "events", files_per_batch=files_per_batch), f"{base}/chk",
                  batch_fn=ChangeSink(table))
    return table.read()


def _event_flows(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Upserts and tombstones of the feed, each a stream of its own."""
    ups = I.upserts_of(table_stream(spark, sf_dir, "events", files_per_batch=files_per_batch))
    dels = I.deletes_of(table_stream(spark, sf_dir, "events", files_per_batch=files_per_batch))
    return ups, dels


def stream_deletes(spark: SparkSession, sf_dir: str, mode: str = "scd1_deletes", files_per_batch: int = 4) -> DataFrame:
    """An upsert stream and a delete stream, two queries with their own checkpoints, into
    one table; the deletes run first, so every upsert they outdate arrives late."""
    base = work_dir(spark, "stream-deletes")
    ups, dels = _event_flows(spark, sf_dir, files_per_batch)
    table = _table(spark, base, mode)
    run_available(C.mark(dels, C.DELETE), f"{base}/chk-deletes", batch_fn=ChangeSink(table))
    run_available(C.mark(ups, C.UPSERT), f"{base}/chk-upserts", batch_fn=ChangeSink(table))
    return table.read()


class InjectedFailure(RuntimeError):
    pass


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A micro-batch fails after writing its data; the restarted query replays it."""
    base = work_dir(spark, "stream-replay")
    table, calls = _table(spark, base, "scd1"), []

    def fail_once(batch_id: int) -> None:
        calls.append(batch_id)
        if len(calls) == 1:
            raise InjectedFailure("injected failure after data write")

    run = lambda: run_available(table_stream(spark, sf_dir, "events", files_per_batch=2), f"{base}/chk",
                                batch_fn=ChangeSink(table, after_write=fail_once))
    try:
        run()
    except Exception as e:
        if "injected failure after data write" not in str(e):
            raise
    else:
        raise RuntimeError("the injected failure did not reach the query")
    run()
    if calls[:2] != [0, 0]:
        raise RuntimeError(f"batch 0 was not replayed: {calls}")
    return table.read()


def append_run(spark: SparkSession, sf_dir: str, table: str = "events", files_per_batch: int = 5) -> DataFrame:
    """Append flow into a parquet file sink (exactly once by the sink's log)."""
    base = work_dir(spark, "append")
    run_available(table_stream(spark, sf_dir, table, files_per_batch=files_per_batch), f"{base}/chk", sink=f"{base}/out")
    return spark.read.parquet(f"{base}/out")


def landed_runs(feed: DataFrame, seq: str, batches: int, src: str) -> Iterator[DataFrame]:
    """``feed`` lands in ``src`` as ``batches`` arrivals, newest first, each of as many files as
    the cluster has cores. Gives the stream of an arrival a micro-batch twice: when all arrivals
    but the last have landed, and when the last one has."""
    spark, files = feed.sparkSession, feed.sparkSession.sparkContext.defaultParallelism
    landed = I.arrival_batch(feed, seq, batches)
    for k in range(batches):
        landed.where(F.col("__batch") == k).drop("__batch").repartition(files).write.mode("append").parquet(src)
        if k >= batches - 2:
            yield file_stream(spark, src, feed.schema, files_per_batch=files)


def capped_run(spark: SparkSession, sf_dir: str, n: int = 1000, batches: int = 3) -> DataFrame:
    """S3 with a row cap: the events land as ``batches`` arrivals of files, are streamed an arrival
    at a time and appended in pieces of about ``n`` rows by cursor; a second run on the checkpoint
    takes the files that came since. ``batch`` and ``piece`` number the pieces."""
    base = work_dir(spark, "capped")
    cap = RowCap(I.EVENT_SEQ, n, f"{base}/out")
    for stream in landed_runs(I.events(spark, sf_dir), I.EVENT_SEQ, batches, f"{base}/src"):
        run_available(stream, f"{base}/chk", batch_fn=cap)
    return spark.read.parquet(f"{base}/out")


def resume_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run with the same checkpoint reads only the files that arrived since."""
    base = work_dir(spark, "resume")
    ev = I.arrival_batch(I.events(spark, sf_dir), I.EVENT_SEQ, 2)
    schema = I.events(spark, sf_dir).schema
    src = f"{base}/src/events"
    for k in range(2):
        ev.where(F.col("__batch") == k).drop("__batch").write.mode("append").parquet(src)
        run_available(file_stream(spark, src, schema, 2), f"{base}/chk", sink=f"{base}/out")
    return spark.read.parquet(f"{base}/out")


def delete_feed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source opened in delete mode gives its deleted rows, with a checkpoint of its own."""
    base = work_dir(spark, "delete-feed")
    _, dels = _event_flows(spark, sf_dir, 2)
    run_available(dels, f"{base}/chk", sink=f"{base}/out")
    return spark.read.parquet(f"{base}/out")


def snapshot_sink_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = SnapshotTable(spark, f"{work_dir(spark, 'snapshot-sink')}/target", I.ORDER_KEYS)
    table.write(I.orders_v1(spark, sf_dir), 1)
    table.write(I.orders_v2(spark, sf_dir), 2)
    return table.read()


def upsert_sink_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: half of the feed loaded as a batch, then the whole feed streamed into the sink by a
    query whose batch numbers start at 0 again."""
    base = work_dir(spark, "upsert-sink")
    table = _table(spark, base, "scd1")
    ev = I.arrival_batch(I.events(spark, sf_dir), I.EVENT_SEQ, 2)
    table.write(ev.where(F.col("__batch") == 0).drop("__batch"), "initial-load", 0)
    run_available(table_stream(spark, sf_dir, "events", files_per_batch=2), f"{base}/chk", batch_fn=ChangeSink(table))
    return table.read()


def partitioned_scan(spark: SparkSession, path: str, cursor: str | None = None, start=None, end=None) -> DataFrame:
    """Spark's own split file scan; rows with ``start`` < cursor <= ``end`` (typed, pushed to
    the scan), rows without a cursor value always kept."""
    df = spark.read.parquet(path)
    return df if cursor is None else cursor_slice(df, cursor, start, end)


def cursor_slice(df: DataFrame, cursor: str, start=None, end=None, unknown: bool = True) -> DataFrame:
    """Rows with ``start`` < cursor <= ``end``; with ``unknown``, those without a value, too."""
    c, kind = F.col(cursor), df.schema[cursor].dataType
    typed = lambda v: F.lit(v).cast(kind)
    other = c.isNull() if unknown else F.lit(False)
    if start is not None:
        df = df.where(other | (c > typed(start)))
    if end is not None:
        df = df.where(other | (c <= typed(end)))
    return df if unknown or start is not None or end is not None else df.where(c.isNotNull())


def slice_bounds(df: DataFrame, cursor: str, n: int) -> list[str]:
    """At most ``n - 1`` cursor values, as text, that cut ``df`` into slices of like size."""
    kind = df.schema[cursor].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return []
    at = F.percentile_approx(cursor, [i / n for i in range(1, n)], 1_000)
    cuts = df.agg(F.transform(at, lambda c: c.cast("string"))).first()[0]
    return list(dict.fromkeys(cuts or []))


def sliced_scan(spark: SparkSession, path: str, cursor: str, n: int) -> DataFrame:
    """The whole table as consecutive slices of its cursor, each a scan with its bounds pushed down;
    rows without a cursor value are in the first one. A cursor that can't be cut is one slice."""
    df = spark.read.parquet(path)
    cuts = slice_bounds(df, cursor, n)
    slices = [cursor_slice(df, cursor, a, b, unknown=a is None) for a, b in zip([None, *cuts], [*cuts, None])]
    return reduce(DataFrame.unionAll, slices)


class SliceRun:
    """Incremental slices (start, end] of a table's cursor, planned run by run.

    A run plans the slice from the last end to the newest cursor value, and writes it down in
    ``<base>/plan`` before it reads: Spark splits the read over the executors, with both bounds
    pushed to the scan. The rows go to ``<base>/out/slice=<k>``, then the slice counts as done. A
    run that finds a planned slice that was not finished reads exactly that slice again, whatever
    the source got meanwhile; a run without new values reads nothing. Rows without a cursor value
    are never in a slice; ``cap`` bounds a slice's rows (and its last ties).
    """

    def __init__(self, spark: SparkSession, source: str, cursor: str, base: str, cap: int | None = None):
        self.spark, self.source, self.cursor, self.base, self.cap = spark, source, cursor, base.rstrip("/"), cap

    def _log(self, name: str) -> list:
        try:  # a row a slice
            return sorted(self.spark.read.parquet(f"{self.base}/{name}").collect(), key=lambda r: r["k"])
        except AnalysisException:
            return []

    def plan(self) -> tuple[int, str | None, str] | None:
        """Number, start and end of the slice to read; None when caught up."""
        planned, done = self._log("plan"), {r["k"] for r in self._log("done")}
        if planned and planned[-1]["k"] not in done:
            return tuple(planned[-1][c] for c in ("k", "start", "end"))
        start = planned[-1]["end"] if planned else None
        rest = cursor_slice(self.spark.read.parquet(self.source), self.cursor, start, unknown=False)
        if self.cap:
            from keelson.operators.cursor import batch_cap
            rest = batch_cap(rest, self.cursor, self.cap)
        end = rest.agg(F.max(self.cursor).cast("string")).first()[0]
        if end is None:
            return None
        k = len(planned)
        row = self.spark.createDataFrame([(k, start, end)], "k int, start string, end string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.base}/plan/slice={k}")
        return k, start, end

    def step(self, sink=None) -> bool:
        """Read one slice; False when there is none. ``sink(rows, k)`` replaces the Parquet output."""
        found = self.plan()
        if found is None:
            return False
        k, start, end = found
        rows = cursor_slice(self.spark.read.parquet(self.source), self.cursor, start, end, unknown=False)
        if sink:
            sink(rows, k)
        else:
            rows.write.mode("overwrite").parquet(f"{self.base}/out/slice={k}")
        self.spark.range(1).select(F.lit(k).alias("k")).coalesce(1).write.mode("overwrite").parquet(f"{self.base}/done/slice={k}")
        return True

    def run(self, sink=None) -> int:
        """Steps until caught up; the number of slices read."""
        n = 0
        while self.step(sink):
            n += 1
        return n


def partitioned_stream(spark: SparkSession, folder: str, table: str, cursor: str | None = None, start=None, end=None, **caps) -> DataFrame:
    """The same as a stream: each micro-batch is split by Spark over the executors."""
    df = table_stream(spark, folder, table, **caps)
    return df if cursor is None else cursor_slice(df, cursor, start, end)
