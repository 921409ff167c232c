"""Cursor filters, offsets, ordering, pages and batch caps.

Filters are plain comparisons on the bare column so that Catalyst pushes them to
the parquet scan (``PushedFilters``). Row-exact cuts use top-k plans
(``TakeOrderedAndProject``), never a window over the whole table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.session import checkpointed


def _is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)


def _lit_for(df: DataFrame, col: str, value) -> Column:
    """A literal typed like ``col`` (so the comparison is typed, decision D1)."""
    return F.lit(value).cast(df.schema[col].dataType)


def after_cursor(df: DataFrame, col: str, cursor=None) -> DataFrame:
    """rows strictly after ``cursor``; rows without a cursor value are always kept."""
    if cursor is None or cursor == "":
        return df
    c = F.col(col)
    keep = c.isNull() | (c > _lit_for(df, col, cursor))
    if _is_text(df, col):
        keep = keep | (c == "")
    return df.where(keep)


def cursor_range(df: DataFrame, col: str, since=None, until=None) -> DataFrame:
    """``since < c <= until``, each bound optional.

    A missing value counts as the empty text: dropped once ``since`` is set, kept by ``until``.
    """
    c = F.col(col)
    out = df
    if since is not None:
        out = out.where(c > _lit_for(df, col, since))
    if until is not None:
        out = out.where(c.isNull() | (c <= _lit_for(df, col, until)))
    return out


def match_filters(df: DataFrame, filters: dict, allowed: list[str] | None = None) -> DataFrame:
    """conjunction of exact matches on allowed columns; unknown columns fail at plan time."""
    allowed = list(df.columns) if allowed is None else allowed
    out = df
    for name, value in filters.items():
        if name not in allowed or name not in df.columns:
            raise ValueError(f"filter on column {name!r} is not allowed; allowed: {allowed}")
        out = out.where(F.col(name) == _lit_for(df, name, value))
    return out


def cutoff_at_start(df: DataFrame, col: str, since=None, run_start=None) -> DataFrame:
    """read only up to the moment the run began, so a run ends while data keeps coming."""
    if run_start is None:
        raise ValueError("run_start is required")
    return cursor_range(df, col, since=since, until=run_start)


def lookback(df: DataFrame, col: str, cursor, interval: str) -> DataFrame:
    """re-read ``interval`` before the cursor to catch late updates.

    Safe because change application is idempotent (re-applied rows change nothing). On a
    text cursor the bound is written in the cursor's own form (separator, fraction, zone
    suffix), so that it sorts where its time belongs.
    """
    if cursor is None:
        return df
    if _is_text(df, col):
        bound = _earlier_text(str(cursor), interval)
    else:
        bound = _lit_for(df, col, cursor) - F.expr(f"INTERVAL {interval}")
    return df.where(F.col(col).isNull() | (F.col(col) > bound.cast(df.schema[col].dataType)))


def _earlier_text(cursor: str, interval: str) -> Column:
    m = re.fullmatch(r"(\d{4}-\d{2}-\d{2})(?:([T ])(\d{2}:\d{2}(?::\d{2}(?:\.(\d{1,9}))?)?))?(.*)", cursor)
    if m is None:
        raise ValueError(f"no ISO date in text cursor {cursor!r}")
    day, sep, time, fraction, suffix = m.groups()
    form = "yyyy-MM-dd"
    if sep:
        form += f"'{sep}'HH:mm" + (":ss" if time.count(":") == 2 else "") + (f".{'S' * len(fraction)}" if fraction else "")
    wall = F.lit(f"{day} {time}" if sep else day).cast("timestamp_ntz")
    return F.concat(F.date_format(wall - F.expr(f"INTERVAL {interval}"), form), F.lit(suffix))


def end_offset(df: DataFrame, col: str, start=None) -> DataFrame:
    """A1: one row ``end_offset`` = max cursor of the batch, never below ``start``.

    An empty batch keeps ``start`` (or ``""`` for text cursors without one); nulls are ignored.
    Partial + final hash aggregate: nothing but one value per task crosses the shuffle.
    """
    dt = df.schema[col].dataType
    start_lit = F.lit(start).cast(dt) if start is not None else F.lit(None).cast(dt)
    agg = F.greatest(F.max(col), start_lit)
    if isinstance(dt, T.StringType) and start is None:
        agg = F.coalesce(agg, F.lit(""))
    return df.agg(agg.alias("end_offset"))


def order_by_cursor(df: DataFrame, col: str | None, keys: list[str]) -> DataFrame:
    """Sort by cursor (missing first), then key; by key alone when there is no cursor."""
    order = [F.col(col).asc_nulls_first()] if col else []
    order += [F.col(k).asc_nulls_first() for k in keys]
    return df.orderBy(*order)


def limit_rows(df: DataFrame, col: str | None, keys: list[str], n: int | None,
               page_max: int | None = None) -> DataFrame:
    """First ``n`` rows in cursor order (None = all), capped at ``page_max``."""
    if n is None and page_max is None:
        return order_by_cursor(df, col, keys)
    cap = min(x for x in (n, page_max) if x is not None)
    return order_by_cursor(df, col, keys).limit(cap)


def page_slice(df: DataFrame, col: str | None, keys: list[str], page: int, size: int) -> DataFrame:
    """Replayable page ``page`` (1-based) of ``size`` rows in cursor order.

    Only the order columns are sorted, by range over all tasks; the row counts of the ranges
    (one number each) tell in which range the page begins and ends, and its first and last
    order values become a filter on the table. However deep the page, no task holds more
    than its range. A reader that goes on from page to page is better served by the keyset
    form ``after_cursor(c, last_seen)``.
    """
    if page < 1:
        raise ValueError("page must be >= 1")
    names = [*([col] if col else []), *keys]
    order = [F.col(n).asc_nulls_first() for n in names]
    at = F.monotonically_increasing_id()
    ranged = checkpointed(df.select(*names).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", at))
    part = F.shiftright("__at", 33).alias("p")
    rows = {r.p: r["count"] for r in ranged.groupBy(part).count().collect()}  # one number per range
    first, last = (page - 1) * size, min(page * size, sum(rows.values())) - 1
    if last < first:
        return df.limit(0)
    ends, below = [], 0
    for p in sorted(rows):
        ends += [(p << 33) + n - below for n in (first, last) if below <= n < below + rows[p]]
        below += rows[p]
    bounds = {r["__at"]: r for r in ranged.where(F.col("__at").isin(ends)).collect()}  # two rows
    key = F.struct(*[F.col(n) for n in names])
    lo, hi = (F.struct(*[F.lit(bounds[e][n]).cast(df.schema[n].dataType).alias(n) for n in names]) for e in ends)
    picked = df.where((key >= lo) & (key <= hi))
    skip = ranged.where((F.col("__at") < ends[0]) & (F.struct(*names) >= lo)).count()  # equal rows of the page before
    return picked.orderBy(*order).offset(skip).limit(last - first + 1)


def next_page(df: DataFrame, page: int, size: int) -> DataFrame:
    """One row ``next_page`` = page + 1 if rows remain after this page, else null."""
    if page < 1:
        raise ValueError("page must be >= 1")
    n = F.count(F.lit(1))
    return df.agg(F.when(n > page * size, F.lit(page + 1)).alias("next_page"))


def batch_cut(df: DataFrame, col: str, n: int):
    """The cursor value at which a batch of about ``n`` rows ends (decision D4).

    Computed as the max of a top-n (no full sort, no single-partition window); one value
    comes back to the driver. Returns None when the top-n holds only missing cursors.
    """
    top = df.select(col).orderBy(F.col(col).asc_nulls_first()).limit(n)
    row = top.agg(F.max(col).alias("cut")).first()
    return row["cut"] if row else None


def batch_cap(df: DataFrame, col: str, n: int) -> DataFrame:
    """At most ``n`` rows in cursor order plus the rest of the last tie group.

    The cut is a literal, so the filter is pushed to the scan. Rows without a cursor
    sort first and always belong to the batch.
    """
    cut = batch_cut(df, col, n)
    c = F.col(col)
    if cut is None:
        return df.where(c.isNull())
    return df.where(c.isNull() | (c <= F.lit(cut).cast(df.schema[col].dataType)))
