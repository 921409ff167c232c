"""Per-table metadata joined to measured figures.

One row per table: declared keys, cursor and ingestion type next to row count, distinct
keys, rows with a null key part and the cursor range. Each table is one aggregation
(partial before the shuffle); the per-table rows are unioned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROFILE_COLUMNS = ["table_name", "primary_keys", "cursor_field", "ingestion_type", "row_count",
                   "distinct_keys", "null_keys", "min_cursor", "max_cursor"]

INGESTION_TYPES = ("snapshot", "cdc", "cdc_with_deletes", "append")


METADATA_SCHEMA = "tableName string not null, primary_keys array<string>, cursor_field string, ingestion_type string"


def metadata_relation(spark: SparkSession, connector, tables: list[str], options: dict[str, dict] | None = None) -> DataFrame:
    """The declared metadata of the requested tables, one row each. ``options`` holds options
    per table; ``primary_keys``, ``cursor_field`` and ``ingestion_type`` in them win."""
    rows = []
    for name in tables:
        meta = {**connector.metadata(name), **(options or {}).get(name, {})}
        rows.append((name, list(meta.get("primary_keys") or []), meta.get("cursor_field"), meta.get("ingestion_type", "cdc")))
    return spark.createDataFrame(rows, METADATA_SCHEMA)


def _one(name: str, df: DataFrame, meta: dict) -> DataFrame:
    keys = list(meta.get("primary_keys") or [])
    cursor = meta.get("cursor_field")
    itype = meta.get("ingestion_type", "cdc")
    if itype not in INGESTION_TYPES:
        raise ValueError(f"table {name}: unknown ingestion_type {itype!r}")
    for c in keys + ([cursor] if cursor else []):
        if c not in df.columns:
            raise ValueError(f"table {name}: column {c!r} not found")
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    aggs = [
        F.count(F.lit(1)).alias("row_count"),
        (F.count_distinct(*[F.col(k) for k in keys]) if keys else F.lit(None).cast("bigint"))
        .alias("distinct_keys"),
        F.sum(F.when(null_key, 1).otherwise(0)).cast("bigint").alias("null_keys"),
        (F.min(cursor).cast("string") if cursor else F.lit(None).cast("string")).alias("min_cursor"),
        (F.max(cursor).cast("string") if cursor else F.lit(None).cast("string")).alias("max_cursor"),
    ]
    return df.agg(*aggs).select(
        F.lit(name).alias("table_name"),
        F.array(*[F.lit(k) for k in keys]).cast("array<string>").alias("primary_keys"),
        F.lit(cursor).cast("string").alias("cursor_field"),
        F.lit(itype).alias("ingestion_type"),
        "row_count", "distinct_keys", "null_keys", "min_cursor", "max_cursor")


def table_profile(tables: dict[str, tuple[DataFrame, dict]]) -> DataFrame:
    """``{name: (df, {"primary_keys": [...], "cursor_field": c, "ingestion_type": t})}``."""
    parts = [_one(name, df, meta) for name, (df, meta) in tables.items()]
    return reduce(DataFrame.unionByName, parts)
