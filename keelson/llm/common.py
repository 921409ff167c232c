"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.session import work_dir

# A word is a run of characters other than space and the controls 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut, and
    readable by every executor after another one is lost."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"))


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join whose two sides are both exchanged on the join keys, so that adaptive
    execution can split a hot key of ``left`` over many tasks.

    A side that comes out of an aggregation on ``keys`` would otherwise keep that
    partitioning, and a partition that is not a fresh exchange cannot be split. The extra
    key, a hash of the others, makes Spark exchange it anew.
    """
    mark = "__spread"
    a = left.withColumn(mark, F.xxhash64(*keys))
    b = right.withColumn(mark, F.xxhash64(*keys))
    return a.join(b, [*keys, mark], how).drop(mark)


def row_keys(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``f, r``: file and row of each row where it is stored. The same row has
    the same key in every scan, however the scan is split. A frame that does not come
    straight from files is stored first."""
    try:
        return docs.select("*", F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"))
    except AnalysisException:
        return row_keys(stored(docs, "rows"))
