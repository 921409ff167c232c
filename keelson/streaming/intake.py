"""Rejected rows and an error budget for streams.

Every micro-batch is written once: accepted and rejected rows go to folders of their own in the
same pass, and an observation on that pass counts both. If the share of rejected rows, over all
batches so far, is above the budget, the run stops before the batch counts; otherwise accepted
rows are handed on, read back from what was written, so that the source is read and typed once::

    <path>/rows/__batch=<query>-<batch id>/__rejected=<true|false>/part-*.parquet
    <path>/counts/__batch=<query>-<batch id>/    rows, rejected, accepted or stopped

A batch that is offered again replaces its folders: after a stop, the same query goes on once the
rules, the source or the budget are mended, with nothing lost and nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from keelson.functions.coerce import ERRORS
from keelson.streaming.flows import query_id

REASONS, REJECTED, BATCH = "_reasons", "__rejected", "__batch"


class BudgetExceeded(RuntimeError):
    """More rows were rejected than the run may reject."""


def reasons(df: DataFrame, rules: dict[str, Column | str] | None = None, seq: str | None = None) -> Column:
    """Why a row can't be applied, as ``array<string>``: messages of a permissive coercion, a
    missing sequence, and the names of the rules (conditions of bad rows) that it meets. A
    rule that is null for a row does not reject it."""
    found = []
    if seq is not None:
        found.append(F.when(F.col(seq).isNull(), F.lit(f"{seq}: no sequence")))
    for name, rule in (rules or {}).items():
        found.append(F.when(F.expr(rule) if isinstance(rule, str) else rule, F.lit(name)))
    named = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    return F.concat(F.coalesce(F.col(ERRORS), F.array().cast("array<string>")), named) if ERRORS in df.columns else named


class Intake:
    """``foreachBatch`` function in front of a sink.

    ``budget`` is the share of rows (0 to 1) that may be rejected; None sets no bound. It is held
    against all batches of ``path`` together, from ``least`` rows on (a small first batch
    says little). ``sink(rows, batch_id)`` gets the accepted rows of a batch.
    """

    SCHEMA = f"rows bigint, n_rejected bigint, status string, {BATCH} string"

    def __init__(self, path: str, rules: dict[str, Column | str] | None = None, seq: str | None = None,
                 budget: float | None = None, sink: Callable[[DataFrame, int], None] | None = None, least: int = 1):
        if budget is not None and not 0 <= budget <= 1:
            raise ValueError("budget must be a share from 0 to 1")
        self.path, self.rules, self.seq, self.budget, self.sink, self.least = path.rstrip("/"), rules, seq, budget, sink, least

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        taken = [c for c in batch.columns if c in (REASONS, REJECTED, BATCH)]
        if taken:
            raise ValueError(f"column names {taken} are the intake's own")
        spark, name = batch.sparkSession, f"{query_id(batch.sparkSession)}-{batch_id}"
        seen = Observation()
        bad = F.size(REASONS) > 0
        marked = (batch.withColumn(REASONS, reasons(batch, self.rules, self.seq)).drop(ERRORS)
                  .observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("n_rejected")))
        place = f"{self.path}/rows/{BATCH}={name}"
        marked.withColumn(REJECTED, bad).write.mode("overwrite").partitionBy(REJECTED).parquet(place)
        rows, rejected = seen.get["rows"], seen.get["n_rejected"]
        past = self.counts(spark).where((F.col(BATCH) != name) & (F.col("status") == "accepted"))
        before = past.agg(F.sum("rows"), F.sum("n_rejected")).first()
        all_rows, all_bad = rows + (before[0] or 0), rejected + (before[1] or 0)
        over = self.budget is not None and all_rows >= self.least and all_bad > self.budget * all_rows
        if over:
            self._count(spark, name, rows, rejected, "stopped")
            raise BudgetExceeded(f"{all_bad} of {all_rows} rows rejected, budget {self.budget}; see {place}")
        if self.sink and rows > rejected:
            schema = marked.schema
            good = spark.read.schema(schema).parquet(f"{place}/{REJECTED}=false").drop(REASONS)
            self.sink(good, batch_id)
        self._count(spark, name, rows, rejected, "accepted")

    def _count(self, spark: SparkSession, name: str, rows: int, rejected: int, status: str) -> None:
        row = spark.createDataFrame([(rows, rejected, status)], "rows bigint, n_rejected bigint, status string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/counts/{BATCH}={name}")

    def counts(self, spark: SparkSession) -> DataFrame:
        """One row per batch: ``rows, n_rejected, status`` (accepted or stopped), ``__batch``."""
        try:
            return spark.read.schema(self.SCHEMA).parquet(f"{self.path}/counts")
        except AnalysisException:
            return spark.createDataFrame([], self.SCHEMA)

    def rows(self, spark: SparkSession) -> DataFrame | None:
        """Rows of batches that were accepted, with ``_reasons`` and ``__rejected``; None if there are none."""
        done = self.counts(spark).where(F.col("status") == "accepted").select(BATCH)
        try:
            rows = spark.read.option("mergeSchema", "true").parquet(f"{self.path}/rows")
        except AnalysisException:
            return None
        return rows.join(done, BATCH, "left_semi").drop(BATCH).withColumn(REJECTED, F.col(REJECTED).cast("boolean"))

    def accepted(self, spark: SparkSession) -> DataFrame | None:
        rows = self.rows(spark)
        return None if rows is None else rows.where(~F.col(REJECTED)).drop(REJECTED, REASONS)

    def quarantine(self, spark: SparkSession) -> DataFrame | None:
        """Rejected rows of accepted batches, with the reasons."""
        rows = self.rows(spark)
        return None if rows is None else rows.where(REJECTED).drop(REJECTED)
