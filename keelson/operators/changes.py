"""Change application on DataFrames.

The target of SCD type 1 is one row per key; the winner of a key is the row with the
greatest ``(sequence, op rank, tie)``. It is found with ``max_by`` so the aggregation is
partial before the shuffle: a key holding a third of all rows is reduced on every map
task first and moves one row per task. SCD type 2 keeps every version with
``__START_AT``/``__END_AT``; the end of a version is the sequence of the next version of
the same key, computed by the skew-safe ``next_in_key``.

Delete feeds are rows marked ``_op = 'delete'`` (tombstones). A delete wins over an
upsert with the same sequence (decision D5) and stays in the state, of SCD 1 and of SCD 2,
so an older change arriving later is placed before it (decision D8); ``live`` and
``live_history`` hide tombstones. Without a declared tie, equal sequences are ordered by a
hash of the whole row (D5). Null keys are keys like any other; columns may have any type.

A late batch is spliced into an SCD 2 state: a new version ends where its neighbours in the
state say, and of the state only the versions next to a row of the batch are touched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.canonical import row_hash
from keelson.operators.ordering import around_in_key, next_in_key
from keelson.session import checkpointed

OP = "_op"
UPSERT, DELETE = "upsert", "delete"
START_AT, END_AT = "__START_AT", "__END_AT"


def require_seq(df: DataFrame, seq: str) -> DataFrame:
    """Decision D6: a change without a sequence value fails the job (strict mode)."""
    return df.withColumn(seq, F.when(F.col(seq).isNull(), F.raise_error(
        F.lit(f"change row without a value in sequence column {seq}"))
    ).otherwise(F.col(seq)).cast(df.schema[seq].dataType))


def _order_key(df: DataFrame, seq: str, tie: str | None) -> Column:
    """(sequence, op rank, tie): delete sorts after upsert on equal sequence."""
    op_rank = (F.when(F.col(OP) == DELETE, F.lit(1)).otherwise(F.lit(0))
               if OP in df.columns else F.lit(0))
    tie_c = F.col(tie) if tie else row_hash(df)
    return F.struct(F.col(seq).alias("s"), op_rank.alias("o"), tie_c.alias("t"))


def union_changes(*frames: DataFrame | None) -> DataFrame:
    """Union by name, missing columns as nulls (e.g. a target without ``_op``)."""
    frames = [f for f in frames if f is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def latest_per_key(df: DataFrame, keys: list[str], seq: str, tie: str | None = None) -> DataFrame:
    """A2: one row per key, the one with the greatest (sequence, op, tie)."""
    df = require_seq(df, seq)
    cols = df.columns
    win = F.max_by(F.struct(*[F.col(c) for c in cols]), _order_key(df, seq, tie))
    return df.groupBy(*keys).agg(win.alias("__r")).select("__r.*").select(*cols)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """A3: keys that occur more than once, with their count (``n``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def live(state: DataFrame) -> DataFrame:
    """Rows of an SCD 1 state that are not tombstones, without the ``_op`` column."""
    if OP not in state.columns:
        return state
    return state.where(F.col(OP).isNull() | (F.col(OP) != DELETE)).drop(OP)


def expire_tombstones(state: DataFrame, seq: str, older_than) -> DataFrame:
    """Drop tombstones whose sequence is below ``older_than`` (retention of decision D8).

    Until then a delete keeps out older upserts that arrive late; after it, such an upsert
    would bring the key back, so the retention must exceed the latest expected lateness.
    """
    if OP not in state.columns:
        return state
    bound = F.lit(str(older_than)).cast(state.schema[seq].dataType)
    return state.where((F.coalesce(OP, F.lit(UPSERT)) != DELETE) | (F.col(seq) >= bound))


def same_keys(left: list[str], right: list[str]) -> Column:
    """Null-safe equality of two lists of key columns."""
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _names(keys: list[str]) -> list[str]:
    return [f"__k{i}" for i in range(len(keys))]


def _split_touched(target: DataFrame, feed: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Target rows whose key is absent from / present in ``feed`` (null-safe on the keys)."""
    fkeys = feed.select(*[F.col(k).alias(n) for k, n in zip(keys, _names(keys))]).distinct()
    hit = same_keys(keys, _names(keys))
    return target.join(fkeys, hit, "left_anti"), target.join(fkeys, hit, "left_semi")


def _merge_touched(target: DataFrame | None, feed: DataFrame, keys: list[str], seq: str,
                   tie: str | None, only_touched: bool) -> DataFrame:
    """Union and aggregate (one shuffle of target + feed), or, with ``only_touched``, let the
    target rows of keys absent from ``feed`` pass through an anti join on the feed's
    distinct keys (broadcast by AQE when small) and aggregate only the target rows of feed
    keys with the feed: the shuffle then grows with the batch, not with the target. The
    second form is for micro-batches small next to their target; a backfill uses the first."""
    if target is None:
        return latest_per_key(feed, keys, seq, tie)
    if not only_touched:
        return latest_per_key(union_changes(target, feed), keys, seq, tie)
    cols = list(feed.columns) + [c for c in target.columns if c not in feed.columns]
    untouched, touched = _split_touched(target, feed, keys)
    merged = latest_per_key(union_changes(touched, feed), keys, seq, tie)
    return untouched.unionByName(merged, allowMissingColumns=True).select(*cols)


def scd1_upsert(target: DataFrame | None, feed: DataFrame, keys: list[str], seq: str,
                tie: str | None = None, only_touched: bool = False) -> DataFrame:
    """Target after applying ``feed`` as SCD type 1, whatever the arrival order."""
    return _merge_touched(target, feed, keys, seq, tie, only_touched)


def mark(df: DataFrame, op: str) -> DataFrame:
    return df.withColumn(OP, F.lit(op))


def scd1_with_deletes(target: DataFrame | None, upserts: DataFrame, deletes: DataFrame,
                      keys: list[str], seq: str, tie: str | None = None,
                      only_touched: bool = False) -> DataFrame:
    """SCD 1 state (tombstones included) after upserts and deletes; read it with ``live``."""
    if target is not None and OP not in target.columns:
        target = mark(target, UPSERT)
    feed = union_changes(mark(upserts, UPSERT), mark(deletes, DELETE))
    return _merge_touched(target, feed, keys, seq, tie, only_touched)


def _order(versions: DataFrame, seq: str, tie: str | None) -> tuple[DataFrame, list[str]]:
    """``versions`` with the columns that order them within a key; equal rows are equal there,
    and only they (two 64-bit hashes)."""
    cols = [c for c in versions.columns if c not in (OP, START_AT, END_AT, "__old")]
    rank = F.when(F.col(OP) == DELETE, 1).otherwise(0) if OP in versions.columns else F.lit(0)
    staged = versions.withColumns({"__s": F.col(seq), "__o": rank, "__h": row_hash(versions, cols),
                                   "__g": row_hash(versions, cols, seed=1)})
    return staged, ["__s", "__o", *([tie] if tie else []), "__h", "__g"]


def history_of(versions: DataFrame, keys: list[str], seq: str, tie: str | None = None) -> DataFrame:
    """Intervals of all versions; a row that occurs twice (a replay) is one version."""
    cols = versions.columns
    staged, order = _order(versions, seq, tie)
    out = next_in_key(staged, keys, order, out="__nx")
    # equal rows are neighbours of one range: the last of them stays
    again = F.struct(*order).eqNullSafe(F.col("__nx"))
    return out.where(~again).select(*cols, F.col(seq).alias(START_AT), F.col("__nx.__s").alias(END_AT))


def neighbours(state: DataFrame, feed: DataFrame, keys: list[str], seq: str) -> tuple[DataFrame, DataFrame]:
    """Versions of an SCD 2 state that no row of ``feed`` falls into or touches, and those
    next to one: an as-of search by key, decided while the state is read.

    The sequences of the feed are gathered per key and slice (a quantile of the feed, so a hot
    key has many short lists); a version is a neighbour if its closed interval holds one of
    them. Adaptive execution broadcasts the lists where they are small: the state is not shuffled.
    """
    kind, slices = feed.schema[seq].dataType, 256
    place = None
    if isinstance(kind, T.NumericType):
        place = F.col(seq).cast("double")
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        place = F.unix_micros(F.col(seq).cast("timestamp")).cast("double")
    if place is None:
        slice_of = F.pmod(F.xxhash64(seq), F.lit(slices))
    else:
        cuts = feed.agg(F.percentile_approx(place, [i / slices for i in range(1, slices)], 10_000)).first()[0] or []
        bounds = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<double>")
        slice_of = F.size(F.filter(bounds, lambda c: c < place)).cast("bigint")
    probe = (feed.select(*[F.col(k).alias(n) for k, n in zip(keys, _names(keys))], F.col(seq).alias("__s"), slice_of.alias("__slice"))
             .groupBy(*_names(keys), "__slice")
             .agg(F.min("__s").alias("__lo"), F.max("__s").alias("__hi"), F.collect_set("__s").alias("__at")))
    start, end = F.col(START_AT), F.col(END_AT)
    reach = lambda at: (start <= at) & (end.isNull() | (at <= end))
    hit = (same_keys(keys, _names(keys)) & (start <= F.col("__hi")) & (end.isNull() | (F.col("__lo") <= end))
           & F.exists("__at", reach))
    return state.join(probe, hit, "left_anti"), state.join(probe, hit, "left_semi")


def splice(state: DataFrame | None, feed: DataFrame, keys: list[str], seq: str, tie: str | None = None) -> DataFrame:
    """SCD 2 state after ``feed``, however late its rows are.

    A new version ends at the next row of the feed or where its predecessor in the state
    ended, whichever comes first; without a predecessor the key's first version is next. The
    predecessor ends at the new version. All other versions pass through as they are.
    """
    feed = feed.select(*[c for c in feed.columns if c not in (START_AT, END_AT)])
    if state is None:
        return history_of(feed, keys, seq, tie)
    feed = checkpointed(feed)  # read four times: its lists, its rows, its keys and their bounds
    apart, near = neighbours(state, feed, keys, seq)
    # both sides with the same columns and types
    old = union_changes(feed.limit(0), near).withColumn("__old", F.lit(True))
    new = union_changes(feed, near.limit(0)).drop(START_AT).withColumn("__old", F.lit(False))
    cols = [c for c in new.columns if c not in (END_AT, "__old")]
    old, order = _order(old, seq, tie)
    new, _ = _order(new, seq, tie)
    ids = [*keys, *order]
    # a row of the feed that the state has already, or that comes twice, is one version
    fresh = (new.dropDuplicates(ids)
             .join(old.select(*[F.col(c).alias(f"__i{i}") for i, c in enumerate(ids)]),
                   same_keys(ids, [f"__i{i}" for i in range(len(ids))]), "left_anti"))
    first = (_split_touched(state, feed, keys)[1].groupBy(*keys).agg(F.min(START_AT).alias("__first"))
             .select(*[F.col(k).alias(n) for k, n in zip(keys, _names(keys))], "__first"))
    fresh = fresh.join(first, same_keys(keys, _names(keys)), "left").drop(*_names(keys))
    work = fresh.unionByName(old.drop(START_AT), allowMissingColumns=True)
    ends = F.when(F.col("__old"), F.struct(F.col(END_AT).alias("e")))
    around = around_in_key(work, keys, order, out="__nx", mark=ends, mark_out="__before")
    end = F.when(F.col("__before").isNotNull(), F.col("__before.e")).otherwise(F.col("__first"))
    spliced = around.select(*cols, F.col(seq).alias(START_AT), F.least(end, F.col("__nx.__s")).alias(END_AT))
    return union_changes(spliced, apart)


def scd2_history(target: DataFrame | None, feed: DataFrame, keys: list[str], seq: str,
                 tie: str | None = None) -> DataFrame:
    """Every version kept with ``__START_AT``/``__END_AT``; the current one ends in null.

    A late row splits the interval it falls into; see :func:`splice`. A replayed row (equal in
    every column) is kept once, two different rows of one sequence are two versions.
    """
    return splice(target, require_seq(feed, seq), keys, seq, tie)


def live_history(state: DataFrame) -> DataFrame:
    """Versions of an SCD 2 state without its tombstones and the ``_op`` column."""
    return live(state)


def scd2_with_deletes(target: DataFrame | None, upserts: DataFrame, deletes: DataFrame,
                      keys: list[str], seq: str, tie: str | None = None) -> DataFrame:
    """SCD 2 state (tombstones included) after upserts and deletes: a delete closes the
    open version at its sequence and opens none. Read it with ``live_history``; pass the
    state, not that view, as the next ``target``."""
    if target is not None and OP not in target.columns:
        target = mark(target, UPSERT)
    feed = require_seq(union_changes(mark(upserts, UPSERT), mark(deletes, DELETE)), seq)
    return splice(target, feed, keys, seq, tie)


def quarantine(feed: DataFrame, seq: str) -> tuple[DataFrame, DataFrame]:
    """Decision D6, permissive: rows that can be applied, and rows without a sequence."""
    return feed.where(F.col(seq).isNotNull()), feed.where(F.col(seq).isNull())


def merge_into(spark: SparkSession, table: str, feed: DataFrame, keys: list[str], seq: str,
               tie: str | None = None) -> None:
    """E1 on a table that supports row-level operations: its newest row per key is merged in
    place, older changes are ignored. Other tables raise Spark's own error."""
    latest = latest_per_key(feed, keys, seq, tie).alias("__feed")
    same = reduce(Column.__and__, [F.col(f"__feed.{k}").eqNullSafe(F.col(f"{table}.{k}")) for k in keys])
    (latest.mergeInto(table, same).whenMatched(F.col(f"__feed.{seq}") >= F.col(f"{table}.{seq}")).updateAll()
     .whenNotMatched().insertAll().merge())


def append_only(target: DataFrame | None, feed: DataFrame) -> DataFrame:
    """Rows added as they come; no key, no dedupe."""
    return union_changes(target, feed)


def make_tombstones(df: DataFrame, keys: list[str], seq: str, keep: list[str] | None = None,
                    stamp=None) -> DataFrame:
    """Deleted rows as key + delete stamp (+ ``keep`` columns); every other column null."""
    keep_set = set(keys) | {seq} | set(keep or [])
    cols = []
    for f in df.schema.fields:
        if f.name == seq and stamp is not None:
            cols.append(F.lit(stamp).cast(f.dataType).alias(f.name))
        elif f.name in keep_set:
            cols.append(F.col(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def tombstones_since(tombstones: DataFrame, keys: list[str], seq: str, since=None,
                     page: int | None = None, size: int = 100) -> DataFrame:
    """Tombstones after ``since`` by cursor; one page of them when ``page`` is given."""
    from keelson.operators.cursor import cursor_range, order_by_cursor, page_slice
    out = cursor_range(tombstones, seq, since=since)
    if page is None:
        return order_by_cursor(out, seq, keys)
    return page_slice(out, seq, keys, page, size)


def touch_upsert(target: DataFrame, rows: DataFrame, keys: list[str], stamp_col: str | None,
                 stamp, tie: str | None = None) -> DataFrame:
    """Insert or replace rows by key, advancing the change stamp.

    A replaced key gets ``stamp``; a new key keeps the stamp it carries (``stamp`` when it
    has none); without a stamp column rows go in unstamped. Of several rows of one key the
    one with the greatest ``tie`` goes in (without ``tie``: the greatest stamp, then hash).
    """
    order = [F.col(c) for c in (tie, stamp_col) if c] + [row_hash(rows)]
    one = (rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("__r"))
           .select("__r.*"))
    fresh, replaced = _split_touched(one, target, keys)
    if stamp_col is not None:
        s = F.lit(str(stamp)).cast(rows.schema[stamp_col].dataType)  # text literal: no dependence on the Python time zone
        replaced = replaced.withColumn(stamp_col, s)
        fresh = fresh.withColumn(stamp_col, F.coalesce(F.col(stamp_col), s))
    untouched, _ = _split_touched(target, one, keys)
    return untouched.unionByName(replaced.select(*target.columns)).unionByName(fresh.select(*target.columns))
