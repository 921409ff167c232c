"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints have 64 bits; two link at ``MAX_BITS`` (4) or fewer differing bits. The index:

* **Upper nodes.** The bits are cut into six blocks. Two fingerprints that link agree in at
  least two whole blocks, so each fingerprint is filed under its 15 masked patterns (two
  blocks kept, the rest masked out) and every link lies inside one upper node.
* **Leaves.** Inside a node fingerprints stand in Gray-rank order, where neighbours differ
  in few bits, cut into leaves of ``LEAF`` fingerprints. A leaf holds the masked bit pattern
  its members share.
* **Search.** Leaves are joined within themselves by vector operations. Leaves of one node
  are joined with each other only if the differences accumulated on their shared bits are
  within the limit, and not if the first pass has already connected all they hold.

The order is a range partitioning, so a node of any size spreads over many tasks; a task
holds one leaf (or a pair) at a time. Equal fingerprints are one entry. Only a spanning set
of links leaves a leaf, and components come from star contraction; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import row_keys, spread_join, stored
from keelson.llm.components import components

SHINGLE = 4
MAX_BITS = 4
LEAF = 256
BLOCKS = MAX_BITS + 2


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a whole text. No words: zero."""
    from xxhash import xxh64_intdigest
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    if len(w) < shingle:
        grams: Iterator[bytes] = iter([b" ".join(w)])
        n = 1
    else:
        n = len(w) - shingle + 1
        grams = map(b" ".join, zip(*(w[i:] for i in range(shingle))))
    h = np.fromiter(map(xxh64_intdigest, grams, repeat(42)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        part = h[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little").view(np.int64)
    return int(bits[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fp") -> DataFrame:
    @F.pandas_udf("bigint")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return docs.withColumn(out, simhash(F.col(text_col)))


def block_masks(blocks: int = BLOCKS) -> list[int]:
    """Masks of the upper nodes as signed 64-bit values: any ``blocks - MAX_BITS`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    masks = [sum(c) for c in combinations(block, blocks - MAX_BITS)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def gray_rank(x: Column) -> Column:
    """Rank of a bit pattern in the Gray sequence."""
    for k in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, k))
    return x


class _Leaf:
    """Disjoint sets over the entries of one batch of leaves."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Unite i[k] with j[k] for every k; pairs already united cost no loop."""
        root = self.root
        open_ = root[i] != root[j]
        for a, b in zip(i[open_].tolist(), j[open_].tolist()):
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            if a != b:
                root[max(a, b)] = min(a, b)
        if open_.any():
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up

    def links(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.nonzero(self.root != np.arange(len(fp)))[0]
        return fp[i], fp[self.root[i]]


LEAF_ROWS = "a bigint, b bigint, mask_no int, pattern bigint, node bigint, shared bigint, bits bigint, members array<bigint>"
_OUT = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("mask_no", pa.int32()), ("pattern", pa.int64()),
                  ("node", pa.int64()), ("shared", pa.int64()), ("bits", pa.int64()), ("members", pa.list_(pa.int64()))])


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)) <= MAX_BITS


def _search_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted partition of the index: links inside each leaf, and the leaves that may
    have siblings (in this partition or across its ends)."""
    from pyspark import TaskContext
    node_no = TaskContext.get().partitionId() << 33
    carry = None   # entries of the leaf that is still open
    first = None   # key of the partition's first node: it may have begun in another one
    closed = None  # key of the last leaf that was closed

    def emit(no, pattern, fp, ends, continued):
        """ends: positions where leaves end; continued: flags of leaves that get a row."""
        nonlocal node_no
        starts = np.concatenate([[0], ends[:-1]])
        leaf = np.repeat(np.arange(len(ends)), ends - starts)
        sets, longest = _Leaf(len(fp)), int((ends - starts).max())
        at = np.nonzero((ends - starts)[leaf] > 1)[0]
        for d in range(1, longest):
            at = at[at + d < ends[leaf[at]]]
            hit = at[_near(fp[at], fp[at + d])]
            sets.join(hit, hit + d)
        a, b = sets.links(fp)
        if len(a):
            none = lambda t: pa.nulls(len(a), t)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *[none(f.type) for f in list(_OUT)[2:]]], schema=_OUT)
        rows = []
        for k in np.nonzero(continued)[0]:
            m = fp[starts[k]:ends[k]]
            differ = np.bitwise_or.reduce(m ^ m[0])
            rows.append((None, None, int(no[starts[k]]), int(pattern[starts[k]]), node_no, int(~differ),
                         int(m[0] & ~differ), m.tolist()))
            node_no += 1
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(_OUT.names, r)) for r in rows], schema=_OUT)

    for batch in batches:
        cols = [batch.column(i).to_numpy() for i in range(3)]
        if carry is not None:
            cols = [np.concatenate([x, y]) for x, y in zip(carry, cols)]
        no, pattern, fp = cols
        if not len(fp):
            continue
        if first is None:
            first = (int(no[0]), int(pattern[0]))
        new = np.concatenate([[True], (no[1:] != no[:-1]) | (pattern[1:] != pattern[:-1])])
        begin = np.nonzero(new)[0][np.cumsum(new) - 1]      # where the node of each entry begins
        offset = np.arange(len(fp)) - begin
        starts = np.nonzero(offset % LEAF == 0)[0]
        ends = np.append(starts[1:], len(fp))
        key = lambda at: (int(no[at]), int(pattern[at]))
        flag = (offset[starts] > 0) | (ends - starts == LEAF)
        for k in (first, closed):
            if k is not None:
                flag |= (no[starts] == k[0]) & (pattern[starts] == k[1])
        done = len(ends) - (ends[-1] - starts[-1] < LEAF)   # the last leaf stays open unless it is full
        if done:
            yield from emit(no, pattern, fp[:ends[done - 1]], ends[:done], flag[:done])
            closed = key(starts[done - 1])
        carry = None if done == len(ends) else [x[starts[-1]:] for x in cols]
    if carry is not None:
        yield from emit(*carry, np.array([len(carry[0])]), np.array([True]))


def _search_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of sibling leaves: links between entries that are not yet connected."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        a, b = [], []
        for row in batch.to_pylist():
            x, y = np.array(row["members"], np.int64), np.array(row["members2"], np.int64)
            rx, ry = np.array(row["roots"], np.int64), np.array(row["roots2"], np.int64)
            i, j = np.nonzero(_near(x[:, None], y[None, :]) & (rx[:, None] != ry[None, :]))
            if len(i):
                names, at = np.unique(np.concatenate([rx[i], ry[j]]), return_inverse=True)
                sets = _Leaf(len(names))
                sets.join(at[:len(i)], at[len(i):])
                p, q = sets.links(names)
                a.append(p)
                b.append(q)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=out)


def link_components(prints: DataFrame) -> DataFrame:
    """Components of distinct fingerprints (``fp``): ``fp, root`` for all that link."""
    masks = block_masks()
    filed = F.explode(F.array(*[F.struct(F.lit(i).alias("mask_no"), F.col("fp").bitwiseAND(F.lit(m)).alias("pattern"))
                                for i, m in enumerate(masks)]))
    entries = prints.select("fp", filed.alias("x")).select("x.mask_no", "x.pattern", "fp")
    order = ["mask_no", "pattern", gray_rank(F.col("fp"))]
    found = stored(entries.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(_search_leaves, LEAF_ROWS), "leaves")
    near = stored(components(found.where("a is not null").select("a", "b")), "roots")
    leaves = found.where("node is not null")
    held = (leaves.select("node", F.posexplode("members").alias("at", "fp"))
            .join(near.select(F.col("node").alias("fp"), "root"), "fp", "left")
            .withColumn("root", F.coalesce("root", "fp"))
            .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("at", "fp", "root"))).alias("m")))
    held = stored(leaves.drop("members", "a", "b").join(held, "node")
                  .select("mask_no", "pattern", "node", "shared", "bits", F.col("m.fp").alias("members"),
                          F.col("m.root").alias("roots"),
                          F.when(F.size(F.array_distinct("m.root")) == 1, F.col("m.root")[0]).alias("one")), "held")
    other = held.select("mask_no", "pattern", *[F.col(c).alias(f"{c}2") for c in
                                                ("node", "shared", "bits", "members", "roots", "one")])
    apart = F.bit_count(F.col("bits").bitwiseXOR(F.col("bits2"))
                        .bitwiseAND(F.col("shared")).bitwiseAND(F.col("shared2")))
    pairs = (held.join(other, ["mask_no", "pattern"])
             .where((F.col("node") < F.col("node2")) & (apart <= MAX_BITS)
                    & ~F.coalesce(F.col("one") == F.col("one2"), F.lit(False)))
             .select("members", "roots", "members2", "roots2"))
    across = components(pairs.mapInArrow(_search_pairs, "a bigint, b bigint"))
    return (near.join(across.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "full")
            .select(F.coalesce("node", "root").alias("fp"), F.coalesce("top", "root").alias("root")))


def grouped(rows: DataFrame) -> DataFrame:
    """``rows`` (stored, with ``id`` and ``fp``) plus ``component_id``, the smallest id in
    reach (null ids are not ids; null where a component has no other)."""
    prints = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    roots = link_components(prints)
    named = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = stored(named, "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = spread_join(named, least, ["root"]).select("fp", "root", "component_id")
    return spread_join(rows, named, ["fp"])


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    Null and wordless texts have the zero fingerprint and link like any other. Repeated
    rows are members like any other. An empty table gives an empty result; other columns
    are not read.
    """
    rows = stored(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
                  .select("id", "fp"), "fingerprints")
    return grouped(rows).select(F.col("id").alias("doc_id"),
                                F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every component: the first by ``doc_id`` (null last).
    Columns and rows that stay are unchanged."""
    rows = row_keys(docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.col("text").alias("text")))
    prints = stored(with_fingerprint(rows.select("f", "r", "id", "text")).select("f", "r", "id", "fp"), "fingerprints")
    first = (grouped(prints).groupBy("root")
             .agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "f", "r")).alias("first")))
    return rows.join(first.select("first.f", "first.r"), ["f", "r"], "left_semi").select("row.*")
