"""Snapshot comparison by checksums of key buckets.

Rows are dealt to buckets by a hash of their key. The checksum of a bucket does not depend on
the order of its rows: their number, and the sums of two 64-bit row hashes. Two snapshots
are compared bucket by bucket first, then, inside the buckets that differ, once more by
finer buckets of a few rows each; only rows of differing fine buckets are joined. Checksums
are aggregated before they are shuffled, so what moves is one row per bucket and task, and
the changed rows. Equal checksums of different rows would need both hashes to collide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.canonical import row_hash
from keelson.operators.snapshot import CHANGE, match, snapshot_diff

#: Buckets of the first comparison; rows per bucket of the second one.
BUCKETS = 4096
FINE_ROWS = 32
BUCKET, FINE = "__bucket", "__fine"
_SUMS = ["n", "s", "t"]


def bucket_of(df: DataFrame, keys: list[str], buckets: int, seed: int = 2) -> Column:
    return F.pmod(row_hash(df, keys, seed=seed), F.lit(buckets)).cast("int")


def bucket_sums(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Order-independent checksums of the rows of each bucket: ``n, s, t``."""
    hashes = [row_hash(df, cols, seed=i) for i in (3, 4)]
    rows = df.select(*by, *[h.cast("decimal(20,0)").alias(c) for h, c in zip(hashes, "st")])
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("s"), F.sum("t").alias("t"))


def differing(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """Buckets whose checksums differ, or that only one side has, with the rows in them."""
    pack = lambda df, to: df.select(*by, F.struct(*_SUMS).alias(to))
    both = match(pack(old, "__a"), pack(new, "__b"), by)
    return (both.where(~F.col("__a").eqNullSafe(F.col("__b")))
            .select(*by, F.greatest(F.coalesce("__a.n", F.lit(0)), F.coalesce("__b.n", F.lit(0))).alias("n")))


def changed_rows(old: DataFrame, new: DataFrame, keys: list[str], buckets: int = BUCKETS,
                 old_sums: DataFrame | None = None, new_sums: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of both snapshots that lie in differing fine buckets: every changed row, and few
    others. ``old_sums, new_sums``: bucket sums kept from before, over the columns of ``new``."""
    cols = list(new.columns)
    old = old.select(*cols)
    a, b = old.withColumn(BUCKET, bucket_of(old, keys, buckets)), new.withColumn(BUCKET, bucket_of(new, keys, buckets))
    coarse = differing(old_sums if old_sums is not None else bucket_sums(a, [BUCKET], cols),
                       new_sums if new_sums is not None else bucket_sums(b, [BUCKET], cols), [BUCKET])
    most = coarse.agg(F.max("n")).first()[0]
    if most is None:
        return old.limit(0), new.limit(0)
    fine = max(1, -(-most // FINE_ROWS))
    sides = []
    for side in (a, b):  # one row a bucket at most: AQE broadcasts it
        side = side.join(coarse.select(BUCKET), BUCKET, "left_semi")
        sides.append(side.withColumn(FINE, bucket_of(side, keys, fine, seed=5)))
    where = [BUCKET, FINE]
    found = differing(*(bucket_sums(s, where, cols) for s in sides), where).select(*where)
    return tuple(s.join(found, where, "left_semi").select(*cols) for s in sides)


def checksum_changes(old: DataFrame, new: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys that differ, as ``keelson.operators.snapshot.snapshot_changes`` gives them, by
    joining the rows of differing buckets only."""
    return snapshot_diff(*changed_rows(old, new, keys, buckets), keys).where(F.col(CHANGE) != "same")
