"""Order within a key, balanced whatever the key sizes.

A window ``partitionBy(key).orderBy(seq)`` sends every row of a key to one task, which is the
cheapest plan (one exchange) as long as no key is too long for a task. ``around_in_key`` counts
the rows per key first. Where a key has more than ``HOT_ROWS``, all rows are ordered by range
over (key, sequence, tie) instead, so a key of any size, with a sequence of any orderable
type, spreads over as many ranges as its rows fill, and each range is looked at on its own. Only the
last row of a range can have its successor elsewhere (it is the head of the next range,
if that has the same key), and only the rows before a range's first mark can have the mark
they look for elsewhere (the last one of the ranges before). Each range is summed up in one
row for that; those rows meet their ranges in a join by range number.

Rows are checkpointed before they are read twice, and so are the ranges: their bounds come
from a sample and must not be drawn anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.session import checkpointed

RANGE = "__range"
#: Rows of one key that a task sorts at most (it spills to disk before that).
HOT_ROWS = 2_000_000


def around_in_key(df: DataFrame, keys: list[str], order_cols: list[str], out: str = "__next",
                  mark: Column | None = None, mark_out: str = "__mark") -> DataFrame:
    """Add ``out`` = struct of ``order_cols`` of the next row of the same key (null for the last).
    With ``mark``, also add ``mark_out``: its last value that is not null, in this row or in
    those before it, of the same key.

    Equivalent to ``lead(struct(order_cols))`` and ``last(mark, ignore nulls)`` over (partition by
    keys order by order_cols); null keys are keys like any other.
    """
    if mark is not None:
        df = df.withColumn("__m", mark)
    df = checkpointed(df)
    most = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if most > HOT_ROWS:
        return _by_range(df, keys, order_cols, out, mark is not None, mark_out)
    inside = Window.partitionBy(*keys).orderBy(*order_cols)
    found = df.withColumn(out, F.lead(F.struct(*order_cols)).over(inside))
    if mark is not None:
        found = found.withColumn(mark_out, F.last("__m", ignorenulls=True).over(
            inside.rowsBetween(Window.unboundedPreceding, 0))).drop("__m")
    return found


def _by_range(df: DataFrame, keys: list[str], order_cols: list[str], out: str, marked_rows: bool, mark_out: str) -> DataFrame:
    ranged = checkpointed(df.repartitionByRange(*keys, *order_cols).withColumn(RANGE, F.spark_partition_id()))
    ordered, key = F.struct(*order_cols), F.struct(*keys)
    row = F.struct(key.alias("k"), ordered.alias("o"))
    sums = [F.min(row).alias("__head")]
    if marked_rows:
        marked = F.when(F.col("__m").isNotNull(), row)
        sums.append(F.max_by(F.struct(key.alias("k"), F.col("__m").alias("m")), marked).alias("__tail"))
    ranges = Window.orderBy(RANGE)  # one row a range
    around = [F.lead("__head").over(ranges).alias("__head")]
    if marked_rows:
        around.append(F.last("__tail", ignorenulls=True).over(ranges.rowsBetween(Window.unboundedPreceding, -1)).alias("__tail"))
    edges = ranged.groupBy(RANGE).agg(*sums).select(RANGE, *around)
    inside = Window.partitionBy(RANGE).orderBy(*keys, *order_cols)
    staged = ranged.withColumn("__lead", F.lead(row).over(inside))
    if marked_rows:
        seen = F.when(F.col("__m").isNotNull(), F.struct(key.alias("k"), F.col("__m").alias("m")))
        staged = staged.withColumn("__seen", F.last(seen, ignorenulls=True).over(
            inside.rowsBetween(Window.unboundedPreceding, 0)))
    staged = staged.join(edges, RANGE, "left").withColumn("__lead", F.coalesce("__lead", "__head"))
    found = staged.withColumn(out, F.when(F.col("__lead.k").eqNullSafe(key), F.col("__lead.o")))
    if marked_rows:
        found = found.withColumn("__seen", F.coalesce("__seen", "__tail"))
        found = found.withColumn(mark_out, F.when(F.col("__seen.k").eqNullSafe(key), F.col("__seen.m")))
    return found.drop("__lead", "__head", "__tail", "__seen", "__m", RANGE)


def next_in_key(df: DataFrame, keys: list[str], order_cols: list[str], out: str = "__next") -> DataFrame:
    """Only the successor of :func:`around_in_key`."""
    return around_in_key(df, keys, order_cols, out)
