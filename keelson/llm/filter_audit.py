"""Interaction of document filters over every order of applying them.

With n filters there are n! orders. A document is described by its mask, the filters it fails;
only counts by (part, mask) matter. In an order, a mask is removed at the first filter it
holds. All orders that share their first k filters are an interval of lexicographic ranks
(the Lehmer code of the prefix gives its start, (n-k)! its length), so a removal at step k is
one interval per prefix: its count is added at the interval's start and taken away at its end
in a difference array, and one running sum over the ranks gives the removals of every order at
once. No order is simulated and no document is read more than once.
"""

from __future__ import annotations

import functools
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import BLANKS, text_or_empty

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
SYMBOLS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@functools.lru_cache(maxsize=4)
def intervals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefixes of the orders of ``n`` filters, as ``(before, last, step, start, end)`` rows:
    the mask of the filters before the last one, the last one, its step from 0, and the ranks
    the prefix covers; and all orders by rank, a row of filters each."""
    rows = []
    for step in range(n):
        width = factorial(n - 1 - step)
        for i, prefix in enumerate(permutations(range(n), step + 1)):  # lexicographic: one prefix, one interval
            rows.append((sum(1 << f for f in prefix[:-1]), prefix[-1], step, i * width, (i + 1) * width))
    return np.array(rows, np.int64), np.array(list(permutations(range(n))), np.int64)


def audit_masks(mask: np.ndarray, weights: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """Totals by (order, step) of documents with the given masks.

    ``weights``: a row of counts per mask, its first column the documents. Returns ``order``
    (filters by rank and step), ``removed`` and ``redundant`` (by rank, step and weight),
    ``kept``, ``unique_fails`` and ``shapley``.
    """
    rows, orders = intervals(n)
    before, last, step, start, end = rows.T
    fails = (mask[:, None] >> last) & 1 == 1
    earlier = mask[:, None] & before != 0
    ranks, k = len(orders), weights.shape[1]

    def totals(hit: np.ndarray) -> np.ndarray:
        count = hit.astype(np.int64).T @ weights  # by prefix
        diff = np.zeros((ranks + 1, n, k), np.int64)
        np.add.at(diff, (start, step), count)
        np.subtract.at(diff, (end, step), count)
        return diff.cumsum(0)[:ranks]

    removed, redundant = totals(fails & ~earlier), totals(fails & earlier)
    alone = np.array([weights[mask == 1 << f, 0].sum() for f in range(n)])
    shapley = np.bincount(orders.ravel(), removed[:, :, 0].ravel(), n).astype(np.int64)
    return {"order": orders, "removed": removed, "redundant": redundant[:, :, 0],
            "kept": weights[:, 0].sum() - removed[:, :, 0].cumsum(1), "unique_fails": alone[orders], "shapley": shapley[orders]}


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from ``part, mask, n, good, toxic`` (counts by mask;
    bit i of ``mask``: filter i fails). Zero counts included."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        w = pdf[["n", "good", "toxic"]].to_numpy(np.int64)
        t = audit_masks(pdf["mask"].to_numpy(np.int64), w, len(filters))
        names = ["".join(filters[f] for f in order) for order in t["order"].tolist()]
        steps = len(filters)
        return pd.DataFrame({
            "part": pdf["part"].iloc[0], "filter_order": np.repeat(names, steps),
            "step": np.tile(np.arange(1, steps + 1, dtype=np.int32), len(names)),
            "kept": t["kept"].ravel(), "removed": t["removed"][:, :, 0].ravel(), "redundant": t["redundant"].ravel(),
            "unique_fails": t["unique_fails"].ravel(), "good_lost": t["removed"][:, :, 1].ravel(),
            "toxic_lost": t["removed"][:, :, 2].ravel(), "shapley": t["shapley"].ravel()})

    return counts.groupBy("part").applyInPandas(
        run, "part string, filter_order string, step int, kept long, removed long, redundant long, "
             "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_mask(text: Column) -> Column:
    """Mask of the filters that look at one text only (A to D), of a plain text column."""
    words = F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    fails = [n < MIN_WORDS, 100 * distinct.cast("long") < MIN_DISTINCT_PERCENT * n.cast("long"),
             100 * capitals.cast("long") > MAX_CAPITAL_PERCENT * F.length(text).cast("long"), text.rlike(SYMBOLS)]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the filters they fail.

    The text is read once and reduced to its mask and SHA-256. A document is a copy (E) if a
    smaller ``doc_id`` has the same text; repeated rows of one id are no copies of each other,
    and a row with a null id is no copy and makes none. A document is good (toxic) if any row of
    ``labels`` for its id says 1, however often ids repeat there.

    Copies are counted, not joined: rows are reduced to one per (text, part, id), those to
    one per (text, part), before the rows of a text meet, so a text that a third of all documents
    share is a row per part by then.
    """
    e = 1 << FILTERS.index("E")
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("sha"), text_mask(F.col("text")).alias("mask"))
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                         F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(marks, "doc_id", "left")
    ids = (rows.groupBy("doc_id", "sha", "part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
           .withColumns({"good": F.col("n") * F.coalesce("good", F.lit(0)), "toxic": F.col("n") * F.coalesce("toxic", F.lit(0))}))
    known = F.col("doc_id").isNotNull()
    sums = [F.sum(F.when(cond, F.col(c)).otherwise(0)).alias(c + to)
            for c in ("n", "good", "toxic") for cond, to in ((known, ""), (~known, "0"))]
    first = F.min(F.when(known, F.struct("doc_id", "n", "good", "toxic"))).alias("first")
    texts = ids.groupBy("sha", "part", "mask").agg(first, *sums)
    least = texts.groupBy("sha").agg(F.min("first.doc_id").alias("least"))
    # the first of a text are those with its smallest id, in the part where it is the smallest too
    both = texts.join(least, "sha").withColumn("own", F.col("first.doc_id") == F.col("least"))
    stay = {c: F.col(c + "0") + F.when(F.col("own"), F.col("first." + c)).otherwise(0) for c in ("n", "good", "toxic")}
    kinds = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), *[v.alias(c) for c, v in stay.items()]),
        F.struct((F.col("mask") + e).alias("mask"), *[(F.col(c) + F.col(c + "0") - v).alias(c) for c, v in stay.items()])))
    return (both.select("part", kinds.alias("k")).select("part", "k.*").groupBy("part", "mask")
            .agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]).where("n > 0"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five document filters, by language (null: empty string).

    Null text counts as empty; an empty ``docs`` gives no rows, an empty ``labels`` only
    unlabelled documents; other columns are not read.
    """
    return audit(mask_counts(docs, labels))
