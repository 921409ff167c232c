"""Hard-negative mining by a vertical scan of the vectors (branch and bound on decomposed data).

Vectors are held by dimension, a column of values each. For an anchor the columns are read in
descending order of the anchor's own magnitude. After every few columns the partial scores are
bounded by the least and the greatest contribution that the unread columns can still make
(from each column's minimum and maximum), and candidates that can't matter any more leave the
candidate bitmap. The survivors' scores are completed exactly, so results are exact.

Two searches run this way. *Positives*: the best rows of the anchor's label; a candidate leaves
when its upper bound is below the k-th best lower bound. *Negatives*: rows of other labels
whose score lies in one of the anchor's windows, a window per positive; a candidate leaves when
its bounds miss every window, or reach it below rows that are certainly inside.

Anchors are a stated query set, met with all rows in blocks: rows are dealt by hash to groups
of a bounded size, anchors are copied to every group, and each task holds one group and
streams the anchors past it. Groups and lanes (copies of a group for a share of the anchors)
are chosen so that their copies balance. No label, hot or not, is gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import stored

SCALE = 256
ANCHORS_EVERY = 50
RELABEL_EVERY, LABELS = 7, 10
POSITIVES, NEGATIVES = 5, 3
#: Window of a negative's score, in percent of the positive's.
LOW_PERCENT, HIGH_PERCENT = 50, 95
#: Bytes of vectors that a task holds; pairs of anchor and row that it scores, about.
GROUP_BYTES = 64 << 20
TASK_PAIRS = 2_000_000_000
#: Rows scanned together, columns read between two looks at the bounds, and the number of
#: candidates that are completed without looking again.
BLOCK, STEP, FEW = 16_384, 8, 32
LONG = (-(2 ** 63), 2 ** 63 - 1)


def usable(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``r, vec_id, label, v``: the rows that take part, numbered."""
    v, x = F.col(vector_col), F.col(id_col)
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double") * SCALE) == float("inf")))
    label = F.col(label_col).cast("long")
    return (embeddings.where(x.isNotNull() & label.isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("r"), x.cast("long").alias("vec_id"), label.alias("label"),
                    v.alias("v")))


def relabelled(rows: DataFrame) -> DataFrame:
    """Every seventh id moves to the next label: planted wrong labels."""
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return rows.withColumn("label", moved)


def windows(scores: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative, per positive score (Python integers)."""
    return (np.array([-(-LOW_PERCENT * s // 100) for s in scores], object),
            np.array([HIGH_PERCENT * s // 100 for s in scores], object))


class Group:
    """A bounded set of rows, sorted by label, with its vectors by dimension."""

    def __init__(self, r: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray]):
        order = np.lexsort((r, ids, labels))
        self.r, self.ids, self.labels = r[order], ids[order], labels[order]
        lengths = np.fromiter(map(len, vectors), np.int64, len(vectors))
        self.dims = int(lengths.max(initial=0))
        flat = np.concatenate(vectors) if len(vectors) else np.empty(0)
        narrow = np.float32 if not len(flat) or np.abs(flat).max() < 2 ** 24 else np.float64
        self.columns = np.zeros((self.dims, len(r)), narrow)  # a shorter vector ends in zeros
        place = np.empty(len(r), np.int64)
        place[order] = np.arange(len(r))
        at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.columns[at, np.repeat(place, lengths)] = flat
        self.bounds: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def extremes(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Minimum and maximum of every column over the rows ``i..j``."""
        if (i, j) not in self.bounds:
            part = self.columns[:, i:j]
            self.bounds[i, j] = part.min(1).astype(np.float64), part.max(1).astype(np.float64)
        return self.bounds[i, j]

    def label_range(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))


class Scan:
    """One anchor against the rows ``i..j`` of a group, column by column."""

    def __init__(self, group: Group, q: np.ndarray, i: int, j: int):
        q = q[:group.dims] if len(q) >= group.dims else np.r_[q, np.zeros(group.dims - len(q))]
        low, high = group.extremes(i, j)
        reach = float(np.abs(q) @ np.maximum(np.abs(low), np.abs(high)))
        # every partial sum is an integer below this bound, so floating point sums are exact
        self.kind = np.float32 if reach < 2 ** 23 else np.float64 if reach < 2 ** 52 else object
        exact = _integers if self.kind is object else (lambda x: x)
        q, low, high = exact(q), exact(low), exact(high)
        self.order = np.argsort(-np.abs(q), kind="stable")
        ends = np.stack([q * low, q * high])[:, self.order]
        zero = [0] if self.kind is object else [0.0]
        self.least = np.r_[np.cumsum(ends.min(0)[::-1])[::-1], zero]  # of all columns from k on
        self.most = np.r_[np.cumsum(ends.max(0)[::-1])[::-1], zero]
        self.q = q if self.kind is object else q.astype(self.kind)
        self.columns, self.i, self.j = group.columns, i, j
        self.read = 0
        self.at: np.ndarray | None = None  # the candidates; None: all rows
        self.score = np.zeros(j - i, self.kind)

    def more(self, n: int) -> None:
        """Read the next ``n`` columns of the candidates."""
        dims = self.order[self.read:self.read + n]
        part = self.columns[dims, self.i:self.j] if self.at is None else self.columns[dims[:, None], self.at]
        part = _integers(part) if self.kind is object else part.astype(self.kind, copy=False)
        self.score = self.score + self.q[dims] @ part
        self.read += len(dims)

    def keep(self, bitmap: np.ndarray) -> None:
        self.at = np.flatnonzero(bitmap) + self.i if self.at is None else self.at[bitmap]
        self.score = self.score[bitmap]

    def done(self) -> bool:
        return self.read >= len(self.order)


def _integers(x: np.ndarray) -> np.ndarray:
    """Python integers of integral floats, whatever their size."""
    return np.array([int(e) for e in x.ravel()], object).reshape(x.shape)


def _clip(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([min(max(int(s), LONG[0]), LONG[1]) for s in scores], np.int64)
    return scores.astype(np.int64)


def _best(ids: np.ndarray, r: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((r, ids, -scores))[:k] if scores.dtype != object else \
        np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i], r[i]))[:k], np.int64)


def positives(group: Group, q: np.ndarray, label: int, own: int, k: int = POSITIVES):
    """Rows and scores of the best ``k`` rows of the label, without the row ``own``."""
    first, last = group.label_range(label)
    at, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    for i in range(first, last, BLOCK):
        scan = Scan(group, q, i, min(i + BLOCK, last))
        scan.more(2 * STEP)
        scan.keep(group.r[scan.i:scan.j] != own)
        while not scan.done():
            scan.more(STEP if len(scan.score) > FEW else len(scan.order))
            if len(scan.score) > k:
                slack = scan.most[scan.read] - scan.least[scan.read]
                scan.keep(scan.score >= np.partition(scan.score, -k)[-k] - slack)
        at = np.r_[at, scan.at]
        scores = np.r_[scores, _clip(scan.score)]
        top = _best(group.ids[at], group.r[at], scores, k)
        at, scores = at[top], scores[top]
    return at, scores


def negatives(group: Group, q: np.ndarray, label: int, scores: list[int], k: int = NEGATIVES):
    """Per window (positive score) the best ``k`` rows of other labels inside it: window
    numbers, rows and scores."""
    low, high = windows(scores)
    open_ = [w for w in range(len(scores)) if low[w] <= high[w]]
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(scores)
    least = {w: low[w] for w in open_}  # what a candidate of a window must reach by now
    for i in range(0, len(group.r), BLOCK) if open_ else ():
        scan = Scan(group, q, i, min(i + BLOCK, len(group.r)))
        scan.more(2 * STEP)
        above, below = scan.most[scan.read], scan.least[scan.read]
        scan.keep((group.labels[scan.i:scan.j] != label) & (scan.score + above >= min(least.values()))
                  & (scan.score + below <= max(high[w] for w in open_)))
        while not scan.done() and len(scan.score):
            scan.more(STEP if len(scan.score) > FEW else len(scan.order))
            if scan.done():
                break
            above, below = scan.most[scan.read], scan.least[scan.read]
            scan.keep((scan.score + above >= min(least.values())) & (scan.score + below <= max(high[w] for w in open_)))
            if len(scan.score) > FEW:
                bitmap = np.zeros(len(scan.score), bool)
                for w in open_:
                    inside = scan.score[(scan.score + below >= low[w]) & (scan.score + above <= high[w])]
                    floor = max(least[w], np.partition(inside, -k)[-k] + below) if len(inside) >= k else least[w]
                    bitmap |= (scan.score + above >= floor) & (scan.score + below <= high[w])
                scan.keep(bitmap)
        if not len(scan.score):
            continue
        exact = _clip(scan.score)
        for w in open_:
            hit = (scan.score >= low[w]) & (scan.score <= high[w])
            at, s = np.r_[found[w][0], scan.at[hit]], np.r_[found[w][1], exact[hit]]
            top = _best(group.ids[at], group.r[at], s, k)
            found[w] = at[top], s[top]
            if len(top) == k:
                least[w] = max(least[w], int(found[w][1][-1]))
    number = np.repeat(np.arange(len(scores)), [len(a) for a, _ in found])
    return (number, np.concatenate([a for a, _ in found]) if found else np.empty(0, np.int64),
            np.concatenate([s for _, s in found]) if found else np.empty(0, np.int64))


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    ends = np.cumsum([0, *column.value_lengths().to_pylist()])
    return [flat[i:j] for i, j in zip(ends[:-1], ends[1:])]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one group, then anchors: ``anchor``, window number, row, id and score of what
    the group has for each. An anchor with null ``scores`` looks for positives."""
    rows, group = [], None
    for batch in batches:
        kind = batch.column("anchor").to_numpy(zero_copy_only=False).astype(bool)
        held = batch.filter(pa.array(~kind))
        if held.num_rows:
            r, ids, labels = (held.column(c).to_numpy() for c in ("r", "vec_id", "label"))
            rows.append((r, ids, labels, _vectors(held.column("v"))))
        anchors = batch.filter(pa.array(kind))
        if not anchors.num_rows or not rows:
            continue
        if group is None:
            group = Group(*(np.concatenate([x[c] for x in rows]) for c in range(3)), [v for x in rows for v in x[3]])
        out = []
        for r, label, q, scores in zip(anchors.column("r").to_pylist(), anchors.column("label").to_pylist(),
                                       _vectors(anchors.column("v")), anchors.column("scores").to_pylist()):
            if scores is None:
                at, s = positives(group, q, label, r)
                number = np.zeros(len(at), np.int64)
            else:
                number, at, s = negatives(group, q, label, scores)
            out.append((np.full(len(at), r), number, group.r[at], group.ids[at], s))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)],
                                         ["anchor", "number", "row", "id", "score"])


def grid(rows: int, anchors: int, dims: int, cores: int) -> tuple[int, int]:
    """Groups of rows and lanes of anchors: tasks enough for the cores and the pairs, groups
    within ``GROUP_BYTES``, and as few copies (rows times lanes plus anchors times groups)."""
    tasks = max(2 * cores, ceil(rows * anchors / TASK_PAIRS), 1)
    lanes = max(1, round(sqrt(tasks * anchors / max(rows, 1))))
    return max(ceil(tasks / lanes), ceil(rows * max(dims, 1) * 4 / GROUP_BYTES), 1), lanes


def _meet(rows: DataFrame, anchors: DataFrame, groups: int, lanes: int) -> DataFrame:
    """Every anchor searched in every group; see ``_search`` for the result."""
    def dealt(df: DataFrame, anchor: bool, cells: Column, scores: Column) -> DataFrame:
        return df.select(cells.alias("cell"), F.lit(anchor).alias("anchor"), "r", "vec_id", "label", "v", scores.alias("scores"))

    none = F.lit(None).cast("array<bigint>")
    g, lane = F.pmod(F.xxhash64("r"), F.lit(groups)).cast("int"), F.pmod(F.xxhash64("r", F.lit(1)), F.lit(lanes)).cast("int")
    copies = F.explode(F.transform(F.sequence(F.lit(0), F.lit(lanes - 1)), lambda x: g * lanes + x))
    spread = F.explode(F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda x: x * lanes + lane))
    both = dealt(rows, False, copies, none).unionByName(
        dealt(anchors, True, spread, F.col("scores") if "scores" in anchors.columns else none))
    return (both.repartitionById(groups * lanes, F.col("cell")).sortWithinPartitions("anchor")
            .select("anchor", "r", "vec_id", "label", "v", "scores")
            .mapInArrow(_search, "anchor bigint, number bigint, row bigint, id bigint, score bigint"))


def hard_negatives(rows: DataFrame) -> DataFrame:
    """Hard negatives of the anchors (every 50th id) among ``rows``, a table as of :func:`usable`.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each
    anchor and each of its first five other rows of the same label, up to three rows of other
    labels whose score is 50 to 95 percent of the positive's. Higher scores come first, then
    smaller ids. Repeated rows are rows of their own; vectors of different lengths are compared
    as if the shorter ended in zeros; scores beyond 64 bits are clipped; an empty table, or one
    without anchors, gives an empty result.
    """
    rows = stored(rows, "vectors")
    anchors = rows.where(F.col("vec_id") % ANCHORS_EVERY == 0)
    n, dims, m = rows.agg(F.count(F.lit(1)), F.max(F.size("v")),
                          F.count(F.when(F.col("vec_id") % ANCHORS_EVERY == 0, 1))).first()
    groups, lanes = grid(n, m, dims or 0, rows.sparkSession.sparkContext.defaultParallelism)
    order = [F.col("score").desc(), F.col("id"), F.col("row")]
    first = Window.partitionBy("anchor").orderBy(*order)
    pos = stored(_meet(rows, anchors, groups, lanes).withColumn("number", F.row_number().over(first) - 1)
                 .where(F.col("number") < POSITIVES), "positives")
    scores = pos.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("number", "score"))).alias("s"))
    asked = anchors.join(scores.select(F.col("anchor").alias("r"), F.col("s.score").alias("scores")), "r")
    within = Window.partitionBy("anchor", "number").orderBy(*order)
    neg = (_meet(rows, asked, groups, lanes).withColumn("rank", F.row_number().over(within))
           .where(F.col("rank") <= NEGATIVES))
    pos = pos.select("anchor", F.col("number").cast("bigint").alias("number"), F.col("id").alias("positive_id"),
                     F.col("score").alias("positive_score"))
    names = anchors.select(F.col("r").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (neg.join(pos, ["anchor", "number"]).join(names, "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def mine(embeddings: DataFrame) -> DataFrame:
    """:func:`hard_negatives` of a table with ``vec_id, embedding, label`` after
    :func:`relabelled`. Rows with a null id, label, vector or component, or with a component that
    is not finite (scaled, too), take no part; other columns are not read."""
    return hard_negatives(relabelled(usable(embeddings)))
