"""Inline related rows under a foreign-key name.

A left join keeps every row of the left side; an unmatched key gives a null struct. The
physical join is left to Catalyst and AQE: broadcast when the measured size of the
referenced side is under ``spark.sql.autoBroadcastJoinThreshold``, otherwise sort-merge
with AQE skew splitting for hot foreign keys. The referenced side is reduced to one row
per key before the join is taken as given (it is a keyed table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expand_one(df: DataFrame, ref: DataFrame, fk: str, ref_key: str, as_name: str,
               fields: list[str] | None = None) -> DataFrame:
    """``df`` with the matching ``ref`` row as struct column ``as_name`` (null if none)."""
    fields = fields or list(ref.columns)
    r = ref.select(F.col(ref_key).alias("__rk"), F.struct(*fields).alias(as_name))
    return df.join(r, df[fk] == r["__rk"], "left").drop("__rk")


def expand_nested(df: DataFrame, levels: list[tuple]) -> DataFrame:
    """Chain of expansions, e.g. orders → customer → nation.

    ``levels`` is ``[(ref_df, fk, ref_key, as_name), ...]`` from the outermost to the
    innermost. The innermost pair is joined first, so each struct nests the next level.
    """
    if not levels:
        return df
    ref, fk, ref_key, as_name = levels[0]
    inner = expand_nested(ref, levels[1:])
    return expand_one(df, inner, fk, ref_key, as_name)
