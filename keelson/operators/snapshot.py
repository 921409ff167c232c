"""Snapshot comparison and snapshot-driven targets.

One full outer join on the primary key classifies every key as insert, update, delete
or same; the value comparison is the null-safe ``<=>`` on a struct of the non-key
columns, maps and variants in their canonical form. A null key matches a null key. Keys are unique within a snapshot (``duplicate_keys`` checks it), so the join
has no fan-out and no hot key; AQE picks broadcast or sort-merge by the measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.canonical import canonical
from keelson.operators.changes import END_AT, START_AT, same_keys

CHANGE = "change"


def _values(df: DataFrame, keys: list[str], exclude=()) -> list[str]:
    return [c for c in df.columns if c not in keys and c not in exclude]


def match(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of two frames that share only ``keys``, null keys included; each key once."""
    a, b = [f"__a{i}" for i in range(len(keys))], [f"__b{i}" for i in range(len(keys))]
    j = (old.withColumnsRenamed(dict(zip(keys, a)))
         .join(new.withColumnsRenamed(dict(zip(keys, b))), same_keys(a, b), "full_outer"))
    rest = [c for c in j.columns if c not in (*a, *b)]
    return j.select(*[F.coalesce(x, y).alias(k) for x, y, k in zip(a, b, keys)], *rest)


def _same(frame: DataFrame, old: str = "__old", new: str = "__new") -> Column:
    return canonical(F.col(old), frame.schema[old].dataType).eqNullSafe(canonical(F.col(new), frame.schema[new].dataType))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str],
                  compare: list[str] | None = None) -> DataFrame:
    """Keys plus ``change`` in {insert, update, delete, same}, with old and new rows.

    Output columns: keys, ``change``, ``__old`` (struct or null), ``__new`` (struct or null).
    """
    vals = compare or _values(new, keys)
    o = old.select(*keys, F.struct(*vals).alias("__old"), F.lit(True).alias("__in_old"))
    n = new.select(*keys, F.struct(*vals).alias("__new"), F.lit(True).alias("__in_new"))
    j = match(o, n, keys)
    change = (F.when(F.col("__in_old").isNull(), F.lit("insert"))
              .when(F.col("__in_new").isNull(), F.lit("delete"))
              .when(_same(j), F.lit("same"))
              .otherwise(F.lit("update")))
    return j.select(*keys, change.alias(CHANGE), "__old", "__new")


def snapshot_scd1(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """E5: the target after a snapshot is the snapshot, in the target's column order; what a
    sink has to rewrite is ``snapshot_changes``."""
    return new.select(*[c for c in old.columns if c in new.columns],
                      *[c for c in new.columns if c not in old.columns])


def snapshot_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Only the keys that differ (no ``same`` rows): what a target must rewrite."""
    return snapshot_diff(old, new, keys).where(F.col(CHANGE) != "same")


def snapshot_scd2(history: DataFrame | None, new: DataFrame, keys: list[str], version) -> DataFrame:
    """SCD 2 history after the snapshot taken at ``version`` (decision D7).

    Changed key: the open version is closed at ``version`` and a new one opened. Absent key:
    closed. Unchanged key: nothing. Closed versions are carried over untouched.
    """
    vals = _values(new, keys)
    v = F.lit(version)
    if history is None:
        t = _type_of(version)
        return new.select(*keys, *vals, v.cast(t).alias(START_AT), F.lit(None).cast(t).alias(END_AT))
    t = history.schema[END_AT].dataType
    closed = history.where(F.col(END_AT).isNotNull()).select(*keys, *vals, START_AT, END_AT)
    open_ = history.where(F.col(END_AT).isNull()).select(
        *keys, F.struct(*vals).alias("__old"), F.col(START_AT).alias("__at"), F.lit(True).alias("__in_old"))
    snap = new.select(*keys, F.struct(*vals).alias("__new"), F.lit(True).alias("__in_new"))
    j = match(open_, snap, keys)
    v = v.cast(t)
    same = F.col("__in_old") & F.col("__in_new") & _same(j)
    none = F.lit(None).cast(t)
    row = lambda values, start, end: F.struct(values.alias("v"), start.alias("s"), end.alias("e"))
    old_row, new_row = row(F.col("__old"), F.col("__at"), v), row(F.col("__new"), v, none)
    rows = (F.when(same, F.array(row(F.col("__old"), F.col("__at"), none)))
            .when(F.col("__in_old").isNull(), F.array(new_row))
            .when(F.col("__in_new").isNull(), F.array(old_row))
            .otherwise(F.array(old_row, new_row)))
    moved = (j.select(*keys, F.explode(rows).alias("__r"))
             .select(*keys, *[F.col("__r.v").getField(c).alias(c) for c in vals],
                     F.col("__r.s").alias(START_AT), F.col("__r.e").alias(END_AT)))
    return closed.unionByName(moved)


def _type_of(value) -> str:
    import datetime
    if isinstance(value, datetime.datetime):
        return "timestamp"
    if isinstance(value, datetime.date):
        return "date"
    return "bigint"
