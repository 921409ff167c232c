"""URL filters with dated lists (DataFrame functions only).

A list entry names a host and says from when on it is listed or delisted. Entries of one
host become validity intervals, each up to the host's next entry. A capture is tested, at
the time it was fetched, against its host and every parent domain by an as-of join: the
last interval that began no later, if it is still open then.

Both steps cut time into buckets, so that a host with a third of all captures or entries
is many groups: inside a (host, bucket) captures and intervals are put in one order and
each capture takes the interval before it, and the state at the beginning of a bucket
comes from a window over the buckets, of which a host has few. Captures of a group are
salted besides. No capture is ever paired with all intervals of its host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import spread_join, stored

BUCKET = "day"
SALTS = 8


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user, port and closing dot; else ''."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    return F.lower(F.regexp_replace(bare, r"\.+$", ""))


def patterns(host: Column) -> Column:
    """The host and its parent domains of two or more labels."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                           lambda i: F.array_join(F.slice(labels, i, n), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(suffixes)


def validity(entries: DataFrame) -> DataFrame:
    """``pattern, bucket, valid_from, valid_to, entry_id, listed`` from dated entries
    (``pattern, ts, entry_id, listed``); ``valid_to`` is null for a host's last entry. Of
    entries with one time the one with the largest id holds. Entries without pattern or
    time are not entries."""
    e = (entries.where("pattern is not null and ts is not null")
         .select("pattern", F.date_trunc(BUCKET, "ts").alias("bucket"), F.col("ts").alias("valid_from"), "entry_id", "listed"))
    inside = Window.partitionBy("pattern", "bucket").orderBy("valid_from", "entry_id")
    e = e.withColumn("next", F.lead("valid_from").over(inside))
    heads = e.groupBy("pattern", "bucket").agg(F.min("valid_from").alias("head"))
    heads = heads.select("pattern", "bucket", F.lead("head").over(Window.partitionBy("pattern").orderBy("bucket")).alias("later"))
    return (spread_join(e, heads, ["pattern", "bucket"])
            .select("pattern", "bucket", "valid_from", F.coalesce("next", "later").alias("valid_to"), "entry_id", "listed"))


def states(probes: DataFrame, intervals: DataFrame) -> DataFrame:
    """``probes`` (``at, pattern, t``) with the interval ``iv`` in force at ``t``, or null."""
    p = probes.withColumn("bucket", F.date_trunc(BUCKET, "t"))
    iv = F.struct("valid_from", "entry_id", "valid_to", "listed")
    marks = intervals.select("pattern", "bucket", F.col("valid_from").alias("t"), iv.alias("iv"))
    salted = marks.withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
    both = (p.select("pattern", "bucket", "t", "at", F.pmod(F.xxhash64("at"), F.lit(SALTS)).cast("bigint").alias("salt"))
            .unionByName(salted, allowMissingColumns=True))
    upto = (Window.partitionBy("pattern", "bucket", "salt")
            .orderBy("t", F.col("iv.entry_id").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    inside = both.withColumn("iv", F.last("iv", ignorenulls=True).over(upto)).where("at is not null")
    # the state that a bucket begins with, for every bucket that has probes
    last = marks.groupBy("pattern", "bucket").agg(F.max("iv").alias("iv"))
    asked = p.select("pattern", "bucket").distinct().withColumn("asked", F.lit(True))
    order = Window.partitionBy("pattern").orderBy("bucket", F.col("asked").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    begin = (asked.unionByName(last, allowMissingColumns=True)
             .withColumn("begin", F.last("iv", ignorenulls=True).over(order)).where("asked").select("pattern", "bucket", "begin"))
    return (spread_join(inside, begin, ["pattern", "bucket"])
            .select("at", "pattern", "t", F.coalesce("iv", "begin").alias("iv")))


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per capture (``page_id, url, fetched``): those columns and ``host``,
    ``n_listed`` (patterns listed at that time), ``listed_since`` and ``blocked``.

    A capture without time or host is not blocked. Repeated rows are tested one by one;
    empty tables give an empty result, or captures that nothing blocks; extra columns are
    not read.
    """
    base = stored(captures.select("page_id", "url", "fetched", host_of(F.col("url")).alias("host"))
                  .withColumn("at", F.monotonically_increasing_id()), "captures")
    probes = (base.where("fetched is not null")
              .select("at", F.col("fetched").alias("t"), F.explode(patterns(F.col("host"))).alias("pattern")))
    hits = (states(probes, stored(validity(entries), "validity"))
            .where(F.col("iv.listed") & (F.col("iv.valid_to").isNull() | (F.col("t") < F.col("iv.valid_to"))))
            .groupBy("at").agg(F.count(F.lit(1)).alias("n_listed"), F.min("iv.valid_from").alias("listed_since")))
    return (base.join(hits, "at", "left")
            .select("page_id", "url", "fetched", "host", F.coalesce("n_listed", F.lit(0)).cast("long").alias("n_listed"),
                    "listed_since", F.col("n_listed").isNotNull().alias("blocked")))
