"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import spread_join, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(links: DataFrame) -> DataFrame:
    """Components of the undirected links ``a, b`` (bigint).

    Returns ``node, root`` for every node that has a link to another one; ``root`` is the
    smallest node of its component, itself included. Each round connects every node's
    larger neighbours, then its smaller ones, to the smallest node in reach, so the number
    of rounds grows with the logarithm of the longest chain; a node with very many links is
    only ever aggregated or split, never gathered.
    """
    hi, lo = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = stored(links.where("a <> b").select(hi, lo).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        wide = (spread_join(both.where("v > u"), near, ["u"])
                .select(F.col("v").alias("u"), F.col("m").alias("v")))
        near = wide.groupBy("u").agg(F.min("v").alias("m"))
        tall = (spread_join(wide, near, ["u"]).where("v <> m")
                .select(F.col("v").alias("u"), F.col("m").alias("v")))
        after = stored(tall.unionByName(near.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _state(after)
        edges = after
        if state == before:
            break
    root = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return root.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
