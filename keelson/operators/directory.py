"""A stored directory of pages.

``page_slice`` sorts the order columns anew for every page. A directory sorts them once: it
keeps, for every page, the order values of its first row, the number of equal rows that
belong to earlier pages, and the page's length. That is one row per page. A page is then two
rows of the directory and a scan with both bounds pushed down, without a sort of the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.session import checkpointed

_OWN = ("page", "skip", "n_rows")


class PageDirectory:
    """Pages of ``size`` rows of a table in the order of ``col`` (missing first), then ``keys``.

    ``build`` replaces nothing: it writes the first part of the directory to ``path``;
    ``extend`` adds a part for rows that sort after all earlier ones, and reads only rows from the
    last page on. Rows that arrive before that need a new directory.
    """

    def __init__(self, spark: SparkSession, path: str, col: str | None, keys: list[str], size: int):
        if size < 1:
            raise ValueError("size must be at least 1")
        self.spark, self.path, self.size = spark, path.rstrip("/"), size
        self.names = [*([col] if col else []), *keys]
        taken = [n for n in self.names if n in (*_OWN, "part")]
        if taken or not self.names:
            raise ValueError(f"columns {taken} can't order a directory" if taken else "an order needs a column")

    def _order(self) -> list[Column]:
        return [F.col(n).asc_nulls_first() for n in self.names]

    def build(self, df: DataFrame) -> None:
        self._entries(df, 1, 0).write.parquet(f"{self.path}/part=0")

    def extend(self, df: DataFrame) -> None:
        """Bring the directory up to date with ``df``, the whole table."""
        last = self.entries().orderBy(F.col("page").desc()).first()
        if last is None:
            first, before, rest = 1, 0, df
        else:
            first, before, rest = last["page"], last["skip"], self._between(df, last, None)
        part = self.spark.read.parquet(self.path).agg(F.max("part")).first()[0]
        # a directory without entries is written anew
        self._entries(rest, first, before).write.mode("overwrite").parquet(f"{self.path}/part={0 if part is None else part + 1}")

    def entries(self) -> DataFrame:
        """``page, skip, n_rows`` and the order values of each page's first row."""
        rows = self.spark.read.parquet(self.path)
        cols = [c for c in rows.columns if c != "part"]
        return rows.groupBy("page").agg(F.max_by(F.struct(*cols), "part").alias("e")).select("e.*")

    def page(self, df: DataFrame, page: int) -> DataFrame:
        """Rows of one page (from 1) of ``df``, in order; none beyond the last page."""
        if page < 1:
            raise ValueError("page must be >= 1")
        found = {r["page"]: r for r in self.entries().where(F.col("page").isin(page, page + 1)).collect()}  # two rows
        if page not in found:
            return df.limit(0)
        here = found[page]
        rows = self._between(df, here, found.get(page + 1))
        return rows.orderBy(*self._order()).offset(here["skip"]).limit(here["n_rows"])

    def _between(self, df: DataFrame, lo, hi) -> DataFrame:
        """Rows from ``lo`` to ``hi`` (rows of the directory). The comparison of the first column
        alone is what the scan can use."""
        key, c = F.struct(*[F.col(n) for n in self.names]), F.col(self.names[0])
        value = lambda r, n: F.lit(r[n]).cast(df.schema[n].dataType)
        bound = lambda r: F.struct(*[value(r, n).alias(n) for n in self.names])
        rows, first = df.where(key >= bound(lo)), self.names[0]
        if lo[first] is not None:                          # from here on there are no rows without a value
            rows = rows.where(c >= value(lo, first))
        if hi is not None:
            above = c <= value(hi, first) if hi[first] is not None else c.isNull()
            rows = rows.where(key <= bound(hi)).where(above if lo[first] is not None else c.isNull() | above)
        return rows

    def _entries(self, df: DataFrame, first: int, before: int) -> DataFrame:
        """Entries of the pages from ``first`` on; the first ``before`` rows are of earlier pages."""
        ranged = checkpointed(df.select(*self.names).repartitionByRange(*self._order()).sortWithinPartitions(*self._order())
                              .withColumn("__at", F.monotonically_increasing_id()))
        r = F.shiftright("__at", 33)
        counts = ranged.groupBy(r.alias("__r")).agg(F.count(F.lit(1)).alias("__n"))
        ranges = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
        counts = counts.select("__r", F.coalesce(F.sum("__n").over(ranges), F.lit(0)).alias("__below"))
        total = ranged.count() - before
        n = F.col("__below") + F.col("__at").bitwiseAND((1 << 33) - 1) - before  # rows before this one, of these pages
        begins = (ranged.withColumn("__r", r).join(counts, "__r").withColumn("__n", n)
                  .where((F.col("__n") >= 0) & (F.col("__n") % self.size == 0)))
        # the first of the rows equal to a page's first: equal rows lie in one range
        marks = begins.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(self.names)]).distinct()
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{i}")) for i, c in enumerate(self.names)])
        heads = (ranged.join(marks, same).groupBy(*[f"__{i}" for i in range(len(self.names))])
                 .agg(F.min("__at").alias("__head")))
        page = F.expr(f"__n div {self.size}")
        return begins.join(heads, same).select(
            (page + first).cast("bigint").alias("page"), (F.col("__at") - F.col("__head")).cast("bigint").alias("skip"),
            F.least(F.lit(self.size), F.lit(total) - F.col("__n")).cast("bigint").alias("n_rows"), *self.names)
