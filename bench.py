"""Benchmark the headline operators; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENT_LOG (default 1: write Spark's event log to a fresh /tmp/run-* folder and add
per-query jobs, stages, tasks and shuffle bytes to the output line).
Every query result is fully computed by a ``noop`` write (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["scd1_upsert", "scd2_history", "scd1_with_deletes", "scd2_with_deletes",
            "snapshot_diff", "snapshot_scd2", "coerce_record", "unnest_results",
            "stream_scd1", "late_arrivals", "batch_cap", "expand_nested"]


def _stage_stats(log_dir: str) -> dict:
    """Per job description: jobs, stages, tasks and shuffle bytes written, from the event log."""
    import glob
    stats, job_of_stage, desc_of_job = {}, {}, {}
    paths = sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True))
    for path in paths:  # rolling logs: eventlog_v2_<app>/events_<n>_<app>
        if not os.path.isfile(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    if not desc:
                        continue
                    if "batch = " in desc:  # jobs of streaming micro-batches
                        desc = "micro_batches"
                    desc_of_job[ev["Job ID"]] = desc
                    for sid in ev.get("Stage IDs", []):
                        job_of_stage[sid] = ev["Job ID"]
                    stats.setdefault(desc, {"jobs": 0, "stages": 0, "tasks": 0,
                                            "shuffle_write_bytes": 0})["jobs"] += 1
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    desc = desc_of_job.get(job_of_stage.get(info["Stage ID"]))
                    if desc is None or "Completion Time" not in info:
                        continue
                    st = stats[desc]
                    st["stages"] += 1
                    st["tasks"] += info.get("Number of Tasks", 0)
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten":
                            st["shuffle_write_bytes"] += int(acc.get("Value", 0))
    return stats


def _stream_metrics(spark, sf_dir: str) -> dict:
    """SCD 1 stream throughput over ``events`` landed as files (5 per micro-batch), and the
    time a restarted query with an existing checkpoint needs to apply newly landed files."""
    from pyspark.sql import functions as F
    from keelson.plans import inputs as I
    from keelson.session import work_dir
    from keelson.streaming import flows as FL
    from keelson.streaming.target import ChangeTable
    ev = I.events(spark, sf_dir)
    rows = ev.count()
    base = work_dir(spark, "bench-stream")
    src = f"{base}/src"
    ev.repartition(20).write.parquet(src)  # the bench's input: 20 landed files
    sink = FL.ChangeSink(ChangeTable(spark, f"{base}/t", I.EVENT_KEYS, I.EVENT_SEQ, I.EVENT_TIE))
    t0 = time.perf_counter()
    FL.run_available(FL.file_stream(spark, src, ev.schema, 5), f"{base}/chk", batch_fn=sink)
    sink.table.read().write.format("noop").mode("overwrite").save()
    run = time.perf_counter() - t0
    # restart: new files land (the next arrival batch), the query resumes at its checkpoint
    extra = I.arrival_batch(ev, I.EVENT_SEQ, 10).where(F.col("__batch") == 0).drop("__batch")
    extra.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY")).write.mode("append").parquet(src)
    t1 = time.perf_counter()
    FL.run_available(FL.file_stream(spark, src, ev.schema, 5), f"{base}/chk", batch_fn=sink)
    restart = time.perf_counter() - t1
    return {"stream_scd1_rows_per_sec": round(rows / run, 1),
            "stream_restart_to_first_batch_sec": round(restart, 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from keelson.session import build_session
    from keelson.plans.catalog import QUERIES
    extra = {"spark.driver.memory": "16g"}
    log_dir = None
    if os.environ.get("BENCH_EVENT_LOG", "1") == "1":
        import tempfile
        log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                      "spark.eventLog.compress": "false"})
    spark = build_session(f"local[{cpus}]", app="keelson-bench",
                          shuffle_partitions=int(cpus) * 2, extra=extra)
    # warm-up: JVM, codegen caches, parquet footers
    QUERIES["latest_per_key"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        spark.sparkContext.setJobDescription(name)
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.sparkContext.setJobDescription(None)
    stream = _stream_metrics(spark, sf_dir)
    spark.stop()
    stages = {}
    if log_dir:
        try:
            stages = _stage_stats(log_dir)
        except Exception:  # noqa: BLE001 - the summary is optional, the timings are not
            stages = {}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else None,
                      "cpus": int(cpus), **stream, "stages": stages}))


if __name__ == "__main__":
    main()
