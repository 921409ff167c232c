"""A join whose left side may have hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` of which adaptive execution can split a hot key of ``left``.

    A side that was aggregated on ``keys`` keeps that partitioning, which can't be split. The
    hash of the keys, as one more key, makes Spark exchange both sides anew.
    """
    mark = "__spread"
    return (left.withColumn(mark, F.xxhash64(*keys))
            .join(right.withColumn(mark, F.xxhash64(*keys)), [*keys, mark], how).drop(mark))
