"""Mixing sources to target weights by entropy balancing.

Among all ways to weigh the documents so that every source supplies its target of words, the
one closest to equal weights in relative entropy tilts each document's rate exponentially
in its size: ``rate = min(CAP, exp(lambda * size / scale))``, one multiplier a source. The
multipliers solve the convex dual by Newton's method: each iteration is one distributed sum
of the constraint and its derivative by source, taken over the histogram of (source, size),
which is far smaller than the table (a source with W words has at most sqrt(2W) different
sizes). Rates become whole copies by cumulative rounding over the sizes, largest first. What
is left of a source's gap in words is spread over the sizes that fit into it, in proportion
to the copies they may still give or take, and closed until no copy brings it nearer.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import WORD, row_keys, stored, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
MAX_STEPS = 60
TOLERANCE = 1e-9
SALTS = 256


def sizes(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` plus ``src`` (order-preserving key, null last) and ``size`` in words."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~"))
    return docs.select(*keep, key.alias("src"),
                       F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"))


def source_targets(hist: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``src, source_size, target``: weights by rank of the source, targets at most ``cap``
    times the size, the excess shared again by weight until no target is above."""
    sums = hist.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"),
                                   F.sum(F.col("n") * F.col("size") * F.col("size")).alias("squares"))
    ranged = stored(sums.repartitionByRange("src").sortWithinPartitions("src")
                    .withColumn("at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("at", 33)
    below, offset = 0, {}
    for r in ranged.groupBy(part.alias("p")).count().orderBy("p").collect():  # one row a partition
        offset[r.p] = below
        below += r["count"]
    start = F.create_map(*[F.lit(x) for kv in offset.items() for x in kv]) if offset else F.create_map()
    rank = F.try_element_at(start, part) + F.col("at").bitwiseAND((1 << 33) - 1) if offset else F.lit(0)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    top = F.col("source_size") * F.lit(float(cap))
    state = ranged.select("src", "source_size", "squares", weight.alias("weight"), top.alias("top"),
                          F.lit(False).alias("full"))
    total = state.agg(F.sum("source_size")).first()[0] or 0
    while True:
        open_, used = state.agg(F.sum(F.when(~F.col("full"), F.col("weight"))),
                                F.sum(F.when(F.col("full"), F.col("top")))).first()
        level = (total - (used or 0.0)) / open_ if open_ else 0.0
        state = state.withColumn("target", F.when(F.col("full"), F.col("top")).otherwise(F.col("weight") * level))
        above = ~F.col("full") & (F.col("target") > F.col("top"))
        if not state.where(above).limit(1).count():
            return state.select("src", "source_size", "squares", "target")
        state = stored(state.withColumn("full", F.col("full") | above).drop("target"), "targets")


def multipliers(hist: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """``src, scale, lam`` solving the dual: safeguarded Newton iterations, all sources at once."""
    full = F.col("target") >= F.col("source_size") * cap
    state = targets.select(
        "src", "target", "source_size", full.alias("done"),
        F.greatest(F.col("squares") / F.greatest(F.col("source_size"), F.lit(1)), F.lit(1.0)).alias("scale"),
        F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    state = stored(state, "dual")
    for _ in range(MAX_STEPS):
        x = F.col("size") / F.col("scale")
        rate = F.exp(F.col("lam") * x)
        mass = F.col("n") * F.col("size")
        sums = (hist.join(state.where(~F.col("done")), "src").groupBy("src")
                .agg(F.sum(mass * F.least(rate, F.lit(float(cap)))).alias("f"),
                     F.sum(F.when(rate < cap, mass * x * rate).otherwise(0.0)).alias("df")))
        f, df, lam = F.col("f"), F.col("df"), F.col("lam")
        lo = F.when(f < F.col("target"), lam).otherwise(F.col("lo"))
        hi = F.when(f >= F.col("target"), lam).otherwise(F.col("hi"))
        step = lam + (F.col("target") - f) / df
        # outside the bracket, or without a slope: halve it, or move out where it is open
        inner = F.when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), (F.col("lo") + F.col("hi")) / 2) \
            .when(F.col("lo").isNotNull(), 2 * F.abs(lam) + 1).otherwise(-2 * F.abs(lam) - 1)
        good = ((df > 0) & (F.col("lo").isNull() | (F.col("step") > F.col("lo")))
                & (F.col("hi").isNull() | (F.col("step") < F.col("hi"))) & (F.abs(F.col("step") - lam) < 8))
        close = F.abs(f - F.col("target")) <= TOLERANCE * F.greatest(F.col("target"), F.lit(1.0))
        moved = (state.join(sums, "src", "left")
                 .withColumn("end", F.col("done") | close | (F.col("f").isNull()))
                 .withColumn("lo", lo).withColumn("hi", hi).withColumn("step", F.when(df > 0, step))
                 .withColumn("lam", F.when(F.col("end"), lam).otherwise(F.when(good, F.col("step")).otherwise(inner))))
        state = stored(moved.select("src", "target", "source_size", F.col("end").alias("done"), "scale", "lam", "lo", "hi"), "dual")
        if not state.where(~F.col("done")).limit(1).count():
            break
    return state.select("src", "scale", "lam", full.alias("full"))


def cell_copies(hist: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """``src, size, n, copies``: whole copies of every (source, size) cell.

    The cells of a source are rounded and closed in one pass, in one task: they are as many as
    the source has different sizes (see the top), however many documents it holds.
    """
    def run(pdf):
        pdf = pdf.sort_values("size", ascending=False, kind="stable")
        size, n = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        if pdf["full"].iloc[0]:
            rate = np.full(len(size), float(cap))
        else:
            rate = np.minimum(cap, np.exp(np.minimum(pdf["lam"].iloc[0] * size / pdf["scale"].iloc[0], 50.0)))
        upto = np.floor(np.cumsum(n * rate) + 0.5).astype(np.int64)
        copies = np.clip(np.diff(upto, prepend=0), 0, n * cap)
        return pdf[["src", "size", "n"]].assign(copies=closed(size, n, copies, pdf["target"].iloc[0], cap))

    solved = multipliers(hist, targets, cap).join(targets.select("src", "target"), "src")
    return hist.join(solved, "src").groupBy("src").applyInPandas(run, "src string, size bigint, n bigint, copies bigint")


def closed(size: np.ndarray, n: np.ndarray, copies: np.ndarray, target: float, cap: int = CAP) -> np.ndarray:
    """``copies`` of a source's cells, largest size first, with copies added or removed until no
    single copy brings the source nearer to its target.

    Round one deals the gap out evenly over the sizes that fit into it; rounding down, so
    less than the largest of them is left. Later rounds fill the rest with the largest sizes
    that fit, which halves it at least; where none fits, with one copy of the smallest size
    that overshoots by less than the gap.
    """
    even = True
    while True:
        gap = target - float(copies @ size)
        by, gap = (1, gap) if gap > 0 else (-1, -gap)
        free = n * cap - copies if by > 0 else copies
        usable = (size > 0) & (size < 2 * gap) & (free > 0)
        fits = np.where(usable & (size <= gap), free, 0)
        words = (fits * size).astype(np.float64)
        if even:
            rate = min(1.0, gap / max(words.sum(), 1.0))
            more = np.diff(np.floor(rate * np.cumsum(fits)).astype(np.int64), prepend=0)
        elif fits.any():
            left = gap - (np.cumsum(words) - words)
            more = np.where(fits > 0, np.maximum(0, np.floor(left / np.maximum(size, 1))), 0).astype(np.int64)
        else:
            more = np.zeros(len(size), np.int64)
            more[np.flatnonzero(usable)[-1:]] = 1
        more = np.minimum(more, np.where(fits > 0, fits, 1))
        if more.any():
            copies = copies + by * more
        elif not even:
            return copies
        even = False


def with_copies(rows: DataFrame, cap: int = CAP) -> DataFrame:
    """``rows`` (stored: ``id, src, size`` and more) plus ``source_size, target, copies``.

    The copies of a cell go evenly to its documents; the remainder goes to the first in the
    order of a hash of the id. The order is by salted groups, so a cell that holds most of
    the table is not one group.
    """
    hist = stored(rows.groupBy("src", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    targets = stored(source_targets(hist, cap=cap), "targets")
    cells = stored(cell_copies(hist, targets, cap), "cells")
    salt = F.pmod(F.xxhash64("id", "size"), F.lit(SALTS))
    rows = rows.withColumn("salt", salt)
    groups = rows.groupBy("src", "size", "salt").agg(F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy("src", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("before", F.coalesce(F.sum("k").over(before), F.lit(0)))
    groups = (groups.join(cells, ["src", "size"]).join(targets.select("src", "source_size", "target"), "src")
              .select("src", "size", "salt", "before", "n", "copies", "source_size", "target"))
    order = Window.partitionBy("src", "size", "salt").orderBy(F.xxhash64(F.lit(1), F.col("id")), "id")
    ranked = rows.withColumn("place", F.row_number().over(order))
    share = F.floor(F.col("copies") / F.col("n"))
    extra = (F.col("before") + F.col("place") <= F.col("copies") - share * F.col("n")).cast("long")
    return (ranked.join(groups, ["src", "size", "salt"])
            .withColumn("copies", share + extra).drop("salt", "place", "before", "n"))


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``.

    ``taken`` is copies times size, 0 to 3 copies. Null text has size 0; a null source is
    the last source; documents without words take nothing; repeated rows are documents like
    any other; an empty table gives an empty result; extra columns are not read.
    """
    rows = stored(sizes(docs, [F.col("doc_id").alias("id")]), "words")
    return with_copies(rows).select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                                    (F.col("copies") * F.col("size")).alias("taken"))


def repeat_to_targets(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, columns unchanged."""
    rows = row_keys(docs.select(F.struct(*docs.columns).alias("row"), "source", "text", F.col("doc_id").alias("id")))
    words = stored(sizes(rows, [F.col("f"), F.col("r"), F.col("id")]), "words")
    taken = with_copies(words).where("copies > 0").select("f", "r", "copies")
    return (rows.select("f", "r", "row").join(taken, ["f", "r"])
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*"))
