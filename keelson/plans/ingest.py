"""Declarative multi-table ingest.

``ingest(spark, spec, connector, root)`` takes the spec shape of the reference::

    {"connection_name": "...",
     "objects": [{"table": {"source_table": "events",
                            "destination_catalog": "c", "destination_schema": "s",
                            "destination_table": "events_t",
                            "table_configuration": {"scd_type": "SCD_TYPE_2",
                                                    "primary_keys": ["user_id"],
                                                    "sequence_by": "ts", ...}}}]}

and a connector that supplies DataFrames per table: ``metadata(table)`` →
``{primary_keys, cursor_field, ingestion_type}``, ``read(table, options)`` (batch),
``read_stream(table, options, deletes=False)`` (streaming), ``has_deletes(table)`` (whether it
has a delete feed). For every table it picks the
flow — append, cdc, cdc_with_deletes or snapshot — and runs it as its own Spark job or
streaming query (availableNow) into ``root``. The whole spec is validated before any job
starts (decisions D10–D12). With ``error_budget`` or ``reject_when`` in a table's configuration its
rows pass an ``Intake``: bad rows go to a quarantine, too many of them fail the table.
"""

from __future__ import annotations

import hashlib
import json
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from keelson.operators import changes as C
from keelson.streaming import flows as FL
from keelson.streaming.intake import Intake
from keelson.streaming.target import ChangeTable, SnapshotTable

# Fixed values of the spec format.
SCD_TYPE, PRIMARY_KEYS, SEQUENCE_BY = "scd_type", "primary_keys", "sequence_by"
VALID_SCD_TYPES = ("SCD_TYPE_1", "SCD_TYPE_2", "APPEND_ONLY")
INGESTION_TYPES = ("cdc", "cdc_with_deletes", "snapshot", "append")
RESERVED_OPTIONS = ("tablename", "isdeleteflow")
#: Options of this library: the share of rows that may be rejected, and conditions of rejected rows by name.
ERROR_BUDGET, REJECT_WHEN = "error_budget", "reject_when"


@dataclass
class TablePlan:
    source_table: str
    destination: str
    path: str
    ingestion_type: str
    primary_keys: list[str]
    sequence_by: str | None
    scd_type: str  # "1" or "2"
    options: dict = field(default_factory=dict)


def destination_name(obj: dict) -> str:
    """The quoted three-part name if the entry gives both outer parts, else the bare table."""
    entry = obj["table"]
    parts = [entry.get(f"destination_{part}") for part in ("catalog", "schema")]
    parts.append(entry.get("destination_table") or entry["source_table"])
    return parts[-1] if None in parts else ".".join(f"`{part}`" for part in parts)


def _keys(value) -> list[str] | None:
    if value is None:
        return None
    if isinstance(value, str):
        return json.loads(value) if value.startswith("[") else [value]
    return list(value)


def plan(spec: dict, connector, root: str) -> list[TablePlan]:
    """Resolve metadata and spec overrides for every table; fail before any job."""
    if not isinstance(spec, dict) or not isinstance(spec.get("objects"), list) or not spec["objects"]:
        raise ValueError("spec needs a non-empty 'objects' list")
    plans, seen = [], set()
    for obj in spec["objects"]:
        t = obj.get("table") or {}
        src = t.get("source_table")
        if not src:
            raise ValueError("every object needs table.source_table")
        dest = destination_name(obj)
        if dest in seen:
            raise ValueError(f"duplicate destination {dest}")
        seen.add(dest)
        conf = dict(t.get("table_configuration") or {})
        bad = [k for k in conf if k.lower() in RESERVED_OPTIONS]
        if bad:
            raise ValueError(f"table {src}: reserved option(s) {bad}")
        meta = connector.metadata(src)
        itype = meta.get("ingestion_type") or "cdc"
        scd_raw = conf.get(SCD_TYPE)
        if scd_raw is not None:
            scd_raw = scd_raw.upper()
            if scd_raw not in VALID_SCD_TYPES:
                raise ValueError(f"table {src}: invalid scd_type {conf[SCD_TYPE]!r}")
        if scd_raw == "APPEND_ONLY":
            itype = "append"
        if itype not in INGESTION_TYPES:
            raise ValueError(f"table {src}: unknown ingestion_type {itype!r}")
        if itype == "cdc_with_deletes" and not getattr(connector, "has_deletes", lambda _: False)(src):
            raise ValueError(f"table {src}: cdc_with_deletes needs a source with a delete feed")
        keys = _keys(conf.get(PRIMARY_KEYS)) or _keys(meta.get("primary_keys")) or []
        seq = conf.get(SEQUENCE_BY) or meta.get("cursor_field")
        if itype in ("cdc", "cdc_with_deletes", "snapshot") and not keys:
            raise ValueError(f"table {src}: {itype} needs primary keys")
        if itype in ("cdc", "cdc_with_deletes") and not seq:
            raise ValueError(f"table {src}: {itype} needs a sequence column")
        options = {k: v for k, v in conf.items() if k not in (SCD_TYPE, PRIMARY_KEYS, SEQUENCE_BY)}
        if itype == "snapshot" and (ERROR_BUDGET in options or REJECT_WHEN in options):
            raise ValueError(f"table {src}: rows of a snapshot can't be rejected; they would count as deleted")
        folder = dest.replace("`", "").replace(".", "/")
        plans.append(TablePlan(src, dest, f"{root.rstrip('/')}/{folder}", itype, keys, seq,
                               "2" if scd_raw == "SCD_TYPE_2" else "1", options))
    return plans


def _change_table(spark: SparkSession, p: TablePlan) -> ChangeTable:
    mode = f"scd{p.scd_type}" + ("_deletes" if p.ingestion_type == "cdc_with_deletes" else "")
    return ChangeTable(spark, f"{p.path}/target", p.primary_keys, p.sequence_by, p.options.get("tie"), mode,
                       p.options.get("tombstone_retention"))


def _intake(p: TablePlan, sink=None) -> Intake | None:
    """What stands in front of a table whose spec says which rows may be rejected."""
    if ERROR_BUDGET not in p.options and REJECT_WHEN not in p.options:
        return None
    budget = p.options.get(ERROR_BUDGET)
    rules = p.options.get(REJECT_WHEN) or {}
    return Intake(f"{p.path}/intake", json.loads(rules) if isinstance(rules, str) else rules,
                  None if p.ingestion_type == "append" else p.sequence_by, None if budget is None else float(budget), sink)


def _run_table(spark: SparkSession, p: TablePlan, connector, version: int | None) -> None:
    if p.ingestion_type == "append" and _intake(p):
        FL.run_available(connector.read_stream(p.source_table, p.options), f"{p.path}/_checkpoint", batch_fn=_intake(p))
    elif p.ingestion_type == "append":
        stream = connector.read_stream(p.source_table, p.options)
        FL.run_available(stream, f"{p.path}/_checkpoint", sink=f"{p.path}/data")
    elif p.ingestion_type == "snapshot":
        SnapshotTable(spark, f"{p.path}/target", p.primary_keys).write(connector.read(p.source_table, p.options), version)
    else:
        sink = FL.ChangeSink(_change_table(spark, p))
        stream = connector.read_stream(p.source_table, p.options)
        if p.ingestion_type == "cdc_with_deletes":
            dels = connector.read_stream(p.source_table, p.options, deletes=True)
            FL.run_available(C.mark(dels, C.DELETE), f"{p.path}/_checkpoint-deletes", batch_fn=sink)
            stream = C.mark(stream, C.UPSERT)
        FL.run_available(stream, f"{p.path}/_checkpoint", batch_fn=_intake(p, sink) or sink)


class IngestFailed(RuntimeError):
    """Some tables of a run failed; the others are done, and the ledger says which."""


class RunLedger:
    """Outcomes by run and table, one row per attempt, below ``path``.

    An attempt is written after its table's last job, so a table counts as done only if all
    it had to do is done. Every table has a folder of its own: tables of a run end at any time.
    """

    SCHEMA = "destination string, attempt int, status string, error string, seconds double, run string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self) -> DataFrame:
        """``run, destination, attempt, status`` (done or failed), ``error, seconds``."""
        try:
            return self.spark.read.schema(self.SCHEMA).option("recursiveFileLookup", "true").parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], self.SCHEMA)

    def attempts(self, run: str) -> dict[str, tuple[int, bool]]:
        """Attempts of each table in a run, and whether one of them did it. One row a table."""
        done = F.max((F.col("status") == "done").cast("int")).alias("done")
        rows = self.rows().where(F.col("run") == run).groupBy("destination").agg(F.max("attempt").alias("n"), done)
        return {r.destination: (r.n, bool(r.done)) for r in rows.collect()}

    def add(self, run: str, destination: str, attempt: int, error: Exception | None, seconds: float) -> None:
        text = f"{type(error).__name__}: {error}"[:2000] if error else None
        row = (destination, attempt, "failed" if error else "done", text, seconds, run)
        place = hashlib.sha256(f"{run}\n{destination}\n{attempt}".encode()).hexdigest()[:24]
        self.spark.createDataFrame([row], self.SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{place}")


def _run_logged(spark: SparkSession, p: TablePlan, connector, version: int | None, ledger: RunLedger, run: str,
                attempt: int) -> Exception | None:
    began, error = time.monotonic(), None
    try:
        _run_table(spark, p, connector, version)
    except Exception as e:  # goes to the ledger, and to the caller with the others
        error = e
    ledger.add(run, p.destination, attempt, error, time.monotonic() - began)
    return error


def ingest(spark: SparkSession, spec: dict, connector, root: str, version: int | None = None,
           concurrent: int = 4, run: str | None = None) -> dict[str, TablePlan]:
    """Run every table of ``spec``, up to ``concurrent`` at a time; returns the plans by
    destination name. A further run applies what has changed since: streams resume at their
    checkpoints, snapshots become the next version (or ``version``).

    With a ``run`` name, each table's outcome goes to the ledger ``<root>/_runs``. A table that
    fails stops no other; ``IngestFailed`` names all that failed. The same run name
    again does only the tables that are not done."""
    plans = plan(spec, connector, root)
    by_name = {p.destination: p for p in plans}
    with ThreadPoolExecutor(max_workers=concurrent) as pool:
        if run is None:
            for done in [pool.submit(_run_table, spark, p, connector, version) for p in plans]:
                done.result()
            return by_name
        ledger = RunLedger(spark, f"{root.rstrip('/')}/_runs")
        past = ledger.attempts(run)
        todo = [(p, past.get(p.destination, (0, False))) for p in plans]
        jobs = {p.destination: pool.submit(_run_logged, spark, p, connector, version, ledger, run, n + 1)
                for p, (n, done) in todo if not done}
        failed = {name: job.result() for name, job in jobs.items() if job.result()}
    if failed:
        raise IngestFailed(f"run {run}: " + "; ".join(f"{name}: {e}" for name, e in failed.items()))
    return by_name


def read_destination(spark: SparkSession, p: TablePlan) -> DataFrame | None:
    """The current content of an ingested destination table."""
    if p.ingestion_type == "append":
        return _intake(p).accepted(spark) if _intake(p) else spark.read.parquet(f"{p.path}/data")
    if p.ingestion_type == "snapshot":
        table = SnapshotTable(spark, f"{p.path}/target", p.primary_keys)
        return table.read() if p.scd_type == "1" else table.history()
    return _change_table(spark, p).read()


def read_quarantine(spark: SparkSession, p: TablePlan) -> DataFrame | None:
    """Rows that were rejected on their way to a destination, with ``_reasons``; None if there are none
    or the table's spec rejects nothing."""
    intake = _intake(p)
    return intake and intake.quarantine(spark)


class ParquetTables:
    """A connector over a folder of ``<table>.parquet`` files with declared metadata.

    Streams read the table file; when ``deletes`` is set for a table, its delete feed is
    the rows matching that predicate as tombstones, and the upsert feed the others.
    """

    def __init__(self, spark: SparkSession, folder: str, metadata: dict[str, dict]):
        self.spark, self.folder, self.meta = spark, folder.rstrip("/"), metadata

    def metadata(self, table: str) -> dict:
        if table not in self.meta:
            raise ValueError(f"unknown source table {table!r}")
        return self.meta[table]

    def has_deletes(self, table: str) -> bool:
        return self.metadata(table).get("delete_when") is not None

    def _path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def read(self, table: str, options: dict) -> DataFrame:
        df = self.spark.read.parquet(self._path(table))
        return self._select(df, options)

    def _select(self, df: DataFrame, options: dict) -> DataFrame:
        cols = options.get("columns")
        return df.select(*cols.split(",")) if cols else df

    def read_stream(self, table: str, options: dict, deletes: bool = False) -> DataFrame:
        caps = {"files_per_batch": options.get("maxFilesPerTrigger"), "bytes_per_batch": options.get("maxBytesPerTrigger")}
        df = FL.table_stream(self.spark, self.folder, table, **caps)
        pred = self.meta.get(table, {}).get("delete_when")
        if pred is None:
            if deletes:
                raise ValueError(f"table {table} has no delete feed")
            return self._select(df, options)
        meta = self.metadata(table)
        if deletes:
            dels = df.where(F.expr(pred))
            keep = [meta.get("tie")] if meta.get("tie") else []
            return C.make_tombstones(dels, meta["primary_keys"], meta["cursor_field"], keep=keep)
        return self._select(df.where(~F.expr(pred)), options)
