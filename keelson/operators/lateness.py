"""Measured lateness: how far back a reader has to look.

A row is late if its cursor lies at or below the newest cursor of the batches before its own; its
lateness is the distance to that. Each batch adds a histogram of lateness to a log, taken in one
pass over the batch; histograms add up, so earlier rows are not read again. The log gives
the interval that re-reads a wanted share of late rows, for ``lookback``.

Classes of the histogram are as wide as 1/64 of their lateness at most, and integers throughout:
few for any range of time, and the interval is never shorter than the exact one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

#: Leading binary digits of a lateness that a class keeps.
DIGITS = 7


def _micros(c: Column, kind: T.DataType) -> Column:
    """A time cursor in microseconds (a timestamp without zone is read as UTC), a number as it is."""
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return F.unix_micros(F.from_utc_timestamp(c.cast("timestamp"), F.current_timezone()))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("bigint")
    raise ValueError(f"lateness needs a time or an integer cursor, not {kind.simpleString()}")


def late_below(lateness: Column) -> Column:
    """The end of the class of a lateness (0 or more): greater than it, by 1/64 at most."""
    shift = F.greatest(F.length(F.bin(lateness)) - DIGITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", lateness, shift) + F.lit(1).cast("bigint"), shift)


class LatenessLog:
    """Histograms of lateness below ``path``, one folder a batch; batches are numbered in order of
    arrival. The same batch again replaces its histogram; ``add`` can be the function of
    ``foreachBatch``. Rows without a cursor value are neither late nor early."""

    SCHEMA = "below bigint, n bigint, top bigint, batch bigint"

    def __init__(self, spark: SparkSession, path: str, cursor: str):
        self.spark, self.path, self.cursor = spark, path.rstrip("/"), cursor

    def classes(self) -> DataFrame:
        """``batch, below, n, top``: rows of a batch by class (null: not late) and their newest cursor."""
        try:
            return self.spark.read.schema(self.SCHEMA).parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], self.SCHEMA)

    def add(self, df: DataFrame, batch: int) -> None:
        value = _micros(F.col(self.cursor), df.schema[self.cursor].dataType)
        before = self.classes().where(F.col("batch") < batch).agg(F.max("top")).first()[0]
        newest = F.lit(before).cast("bigint")
        rows = df.select(value.alias("v")).where("v is not null")
        below = F.when(F.col("v") <= newest, late_below(newest - F.col("v")))
        (rows.groupBy(below.alias("below")).agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top"))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={int(batch)}"))

    def histogram(self) -> DataFrame:
        """``below, n, share``: late rows by class over all batches, and the share of them that an
        interval of ``below`` reads again."""
        late = self.classes().where("below is not null").groupBy("below").agg(F.sum("n").alias("n"))
        order = Window.orderBy("below")  # one row a class, at most 64 for each binary order of magnitude
        return late.select("below", "n", (F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
                                          / F.sum("n").over(Window.partitionBy())).alias("share"))

    def reach(self, recall: float) -> int | None:
        """The shortest interval, in units of the cursor (microseconds of a time), that reads at least
        the share ``recall`` of late rows again; None if no row was late."""
        if not 0 < recall <= 1:
            raise ValueError("recall must be above 0 and at most 1")
        return self.histogram().where(F.col("share") >= recall).agg(F.min("below")).first()[0]

    def interval(self, recall: float) -> str | None:
        """``reach`` in the form that ``lookback`` takes for a time cursor."""
        found = self.reach(recall)
        return None if found is None else f"'{found // 1_000_000}.{found % 1_000_000:06d}' SECOND"


def arrival_numbers(df: DataFrame, arrival: Column) -> DataFrame:
    """``df`` plus ``arrival``: the rank of each row's time of arrival, such as
    ``_metadata.file_modification_time`` of a landed folder. One row per different time is ranked."""
    marked = df.withColumn("__arrived", arrival)
    times = marked.select(F.col("__arrived").alias("__time")).distinct()
    times = times.withColumn("arrival", F.dense_rank().over(Window.orderBy("__time")))
    return marked.join(times, F.col("__arrived").eqNullSafe(F.col("__time"))).select(*df.columns, "arrival")
