"""Removal of repeated 200-byte strings by merging Burrows-Wheeler orders of shards.

A string of ``LENGTH`` (200) bytes that occurs twice holds, in both places and at the same
offset, the same anchor: the core of ``CORE`` bytes with the smallest hash among all cores
of the string. So the corpus is anchored once, and two occurrences of a string meet in the
block of their anchor's core; blocks are independent of each other.

In a block stands one segment for each different context of the core: all that strings of
200 bytes around this anchor can cover, with its multiplicity. Segments come from many
shards. Their suffixes are merged the way Burrows-Wheeler transforms are: starting from
the empty suffix, where segments stand in shard order, each pass puts one more preceding
byte in front of every suffix and refines the interleave with a stable distribution by that
byte. The longest common prefix of neighbours is carried along (one more than the minimum
over what stood between them), so nothing is ever sorted anew and no two suffixes are
compared. Where a suffix and a neighbour share 200 bytes, the string is repeated.

Blocks of more than ``MAX_BLOCK`` different segments (a passage that very many documents
hold at different places) are settled by counting, for each of the few possible offsets, the
string around the anchor: the same answer, over any number of tasks.

Equal cores and equal contexts are recognised by 64-bit hashes. Documents shorter than 200
bytes hold no such string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import row_keys, spread_join, stored

LENGTH = 200
CORE = 64
#: Cores of a string of LENGTH bytes, and bytes that it may reach beyond its core.
WINDOW = LENGTH - CORE + 1
REACH = LENGTH - CORE
MAX_BLOCK = 16_384
#: Bytes that are anchored at a time.
SLICE = 1 << 20

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MOST = SLICE + 4 * LENGTH


def _powers(base: int) -> np.ndarray:
    factors = np.full(_MOST + 1, base, np.uint64)
    factors[0] = 1
    return factors.cumprod(dtype=np.uint64)


_POW = _powers(_BASE)
_INV = _powers(pow(_BASE, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _sliding(x: np.ndarray, w: int, op: np.ufunc, fill: int) -> np.ndarray:
    """op over every window of w values; as many as fit into x."""
    n = len(x) - w + 1
    pad = np.full(-len(x) % w, fill, x.dtype)
    rows = np.concatenate([x, pad]).reshape(-1, w)
    ahead = op.accumulate(rows, axis=1).ravel()
    back = op.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[:n], ahead[w - 1:w - 1 + n])


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of a text's anchors, hashes of their cores, hashes of their contexts."""
    found = [_anchors(text, at) for at in range(0, max(len(text) - CORE + 1, 0), SLICE)] if len(text) >= LENGTH else []
    found = found or [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    return tuple(np.concatenate(x) for x in zip(*found))  # type: ignore[return-value]


def _anchors(text: bytes, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors that begin in text[at:at + SLICE]."""
    lo, hi = max(0, at - LENGTH), min(len(text), at + SLICE + 2 * LENGTH)
    data = np.frombuffer(text, np.uint8, hi - lo, lo)
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _POW[:len(data)], dtype=np.uint64)])
    n = len(data) - CORE + 1
    core = _mix((run[CORE:] - run[:n]) * _INV[:n])
    least = _sliding(core, WINDOW, np.minimum, (1 << 64) - 1)       # of every string that lies in data
    edge = np.zeros(WINDOW - 1, np.uint64)
    most = _sliding(np.concatenate([edge, least, edge]), WINDOW, np.maximum, 0)
    p = np.nonzero(core == most)[0]
    p = p[(p + lo >= at) & (p + lo < at + SLICE)]
    a, b = np.maximum(p - REACH, 0), np.minimum(p + LENGTH, len(data))
    context = _mix((run[b] - run[a]) * _INV[a] + ((p - a) << 16 | (b - p)).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    return p + lo, core[p], context


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def anchor_table(docs: DataFrame) -> DataFrame:
    """Anchors of all documents (``f, r, text``): ``h`` core, ``c`` context, ``f, r, at``, and
    ``lo, hi``: least and greatest offset before it at which a string lies in the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, r = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = [_bytes(t.as_py()) for t in batch.column(2)]
            found = [anchors(t) for t in texts]
            n = [len(x[0]) for x in found]
            if sum(n):
                p, h, c = (np.concatenate(x) for x in zip(*found))
                lo = np.maximum(0, LENGTH - (np.repeat([len(t) for t in texts], n) - p))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(np.repeat(f, n)),
                                                  pa.array(np.repeat(r, n)), pa.array(p), pa.array(lo.astype(np.int16)),
                                                  pa.array(np.minimum(p, REACH).astype(np.int16))],
                                                 names=["h", "c", "f", "r", "at", "lo", "hi"])

    return docs.select("f", "r", "text").mapInArrow(
        run, "h bigint, c bigint, f bigint, r bigint, at bigint, lo smallint, hi smallint")


def _cut_segments(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes of the wanted segments (``h, c, m, f, r, at``): ``h, c, m, before, rest``, the
    bytes up to REACH before the anchor, and those from its core's end on."""
    per_doc = wanted.groupBy("f", "r").agg(F.collect_list(F.struct("h", "c", "m", "at")).alias("w"))
    held = docs.join(per_doc, ["f", "r"]).select("text", "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, want in zip(batch.column(0), batch.column(1).to_pylist()):
                t = _bytes(text.as_py())
                rows += [(x["h"], x["c"], x["m"], t[max(0, x["at"] - REACH):x["at"]], t[x["at"] + CORE:x["at"] + LENGTH]) for x in want]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in cols[:3]), *(pa.array(x, pa.binary()) for x in cols[3:])],
                                             names=["h", "c", "m", "before", "rest"])

    return held.mapInArrow(run, "h bigint, c bigint, m bigint, before binary, rest binary")


def _symbols(parts: list[bytes], length: int, backwards: bool) -> np.ndarray:
    """One row of ``length`` symbols per part, away from the core; where a document ends
    stands a symbol of its own that equals no other."""
    n = np.array([len(x) for x in parts])
    out = np.broadcast_to(256 + np.arange(len(parts))[:, None], (len(parts), length)).copy()
    if n.sum():
        flat = np.frombuffer(b"".join(x[::-1] for x in parts) if backwards else b"".join(parts), np.uint8)
        row = np.repeat(np.arange(len(parts)), n)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def merge_block(block: np.ndarray, before: list[bytes], rest: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Interleave the suffixes of segments of several blocks (``block``: ascending numbers).

    Returns for each segment the least and greatest offset before its anchor at which a
    string of LENGTH bytes begins that another segment of the block has too; -1 if none.
    """
    n = len(block)
    left, right = _symbols(before, REACH, True), _symbols(rest, REACH, False)
    order = np.arange(n)                                     # empty suffixes: shard order
    same = np.concatenate([[False], block[1:] == block[:-1]])
    lcp = np.where(same, 0, -1)                              # with the suffix before; -1: another block
    least, most = np.full(n, -1), np.full(n, -1)
    start = np.maximum.accumulate(np.where(same, 0, np.arange(n)))

    def prepend(symbol: np.ndarray) -> None:
        nonlocal order, lcp
        s = symbol[order]
        at = np.argsort(start * (256 + n) + s, kind="stable")  # positions in the order so far
        order = order[at]
        s = s[at]
        joined = np.concatenate([[False], (s[1:] == s[:-1]) & (start[1:] == start[:-1])])
        i = np.nonzero(joined)[0]
        low = lcp[at[i]]
        far = np.nonzero(at[i] != at[i - 1] + 1)[0]            # others stood between: minimum over them
        if len(far):
            span = np.stack([at[i[far] - 1] + 1, at[i[far]] + 1], axis=1).ravel()
            low[far] = np.minimum.reduceat(np.append(lcp, 1 << 30), span)[::2]
        new = np.where(same, 0, -1)
        new[i] = low + 1
        lcp = new

    for k in range(REACH - 1, -1, -1):
        prepend(right[:, k])
    lcp = np.where(same, lcp + CORE, -1)                     # the core is common to the block
    for offset in range(REACH + 1):
        if offset:
            prepend(left[:, offset - 1])
        hit = lcp >= LENGTH
        hit[:-1] |= hit[1:] & same[1:] & (lcp[1:] >= LENGTH)
        found = order[hit]
        least[found] = np.where(least[found] < 0, offset, least[found])
        most[found] = offset
    return least, most


_SPANS = "h bigint, c bigint, lo bigint, hi bigint"


def _own_span(m: int, before: bytes, rest: bytes) -> tuple[int, int]:
    """Offsets of the strings that lie in the document, if the segment occurs twice."""
    lo, hi = max(0, REACH - len(rest)), min(REACH, len(before))
    return (lo, hi) if m > 1 and lo <= hi else (-1, -1)


def _merge_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by block → offsets of repeated strings around each anchor."""
    def solve(t: pa.Table) -> pa.RecordBatch:
        h = t.column("h").to_numpy()
        before, rest, m = (t.column(c).to_pylist() for c in ("before", "rest", "m"))
        block = np.concatenate([[0], np.cumsum(h[1:] != h[:-1])])
        lo, hi = merge_block(block, before, rest)
        own = np.array([_own_span(*x) for x in zip(m, before, rest)])
        some = own[:, 0] >= 0
        lo = np.where(some, np.where(lo < 0, own[:, 0], np.minimum(lo, own[:, 0])), lo)
        hi = np.maximum(hi, own[:, 1])
        keep = lo >= 0
        return pa.RecordBatch.from_arrays([pa.array(h[keep]), t.column("c").combine_chunks().filter(pa.array(keep)),
                                           pa.array(lo[keep]), pa.array(hi[keep])], names=["h", "c", "lo", "hi"])

    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        h = t.column("h").to_numpy()
        cut = int(np.nonzero(h != h[-1])[0][-1]) + 1 if h[0] != h[-1] else 0
        if cut:
            yield solve(t.slice(0, cut))
        held = t.slice(cut)
    if held is not None and held.num_rows:
        yield solve(held)


def _count_offsets(segments: DataFrame) -> DataFrame:
    """The same for blocks of any size: one row per segment and offset, counted by string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, c, m, before, rest in zip(*(x.to_pylist() for x in batch.columns)):
                lo, hi = max(0, REACH - len(rest)), min(REACH, len(before))
                if lo <= hi:
                    keys = [hashlib.blake2b(before[len(before) - k:] + b"|" + rest[:REACH - k], digest_size=16).digest() for k in range(lo, hi + 1)]
                    n = len(keys)
                    yield pa.RecordBatch.from_arrays([pa.array([h] * n), pa.array([c] * n), pa.array([m] * n), pa.array(range(lo, hi + 1), pa.int64()),
                                                      pa.array(keys, pa.binary())], names=["h", "c", "m", "k", "s"])

    rows = segments.select("h", "c", "m", "before", "rest").mapInArrow(run, "h bigint, c bigint, m bigint, k bigint, s binary")
    twice = rows.groupBy("h", "k", "s").agg(F.sum("m").alias("n")).where("n > 1")
    return (spread_join(rows, twice, ["h", "k", "s"], "left_semi").groupBy("h", "c")
            .agg(F.min("k").alias("lo"), F.max("k").alias("hi")))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``f, r, spans``: for each document (``f, r, text``) with repeated strings, the byte
    intervals (start, end) that they cover; intervals may overlap."""
    marks = anchor_table(docs)
    blocks = (marks.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("a"), F.max("c").alias("b"))
              .where("n > 1").select("h", (F.col("a") != F.col("b")).alias("mixed")))
    shared = stored(spread_join(marks, blocks, ["h"]), "anchors")
    # one context only: the merge of equal segments, each string in it is repeated
    alone = shared.where(~F.col("mixed")).select("f", "r", "at", "lo", "hi")
    mixed = shared.where("mixed").drop("lo", "hi")
    segments = (mixed.groupBy("h", "c").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("f", "r", "at")).alias("x"))
                .select("h", "c", "m", "x.f", "x.r", "x.at"))
    cut = stored(_cut_segments(docs, segments), "segments")
    sizes = cut.groupBy("h").agg(F.count(F.lit(1)).alias("k"))
    large = sizes.where(F.col("k") > MAX_BLOCK).select("h")
    small = cut.join(large, "h", "left_anti")
    spans = (small.repartition("h").sortWithinPartitions("h").mapInArrow(_merge_shards, _SPANS)
             .unionByName(_count_offsets(cut.join(large, "h", "left_semi"))))
    merged = spread_join(mixed.select("h", "c", "f", "r", "at"), spans, ["h", "c"]).select("f", "r", "at", "lo", "hi")
    return (alone.unionByName(merged).where("lo <= hi").groupBy("f", "r")
            .agg(F.collect_set(F.struct((F.col("at") - F.col("hi")).alias("start"),
                                        (F.col("at") - F.col("lo") + LENGTH).alias("end"))).alias("spans")))


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of a set of intervals; runs that touch are one."""
    runs: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
        else:
            runs.append((a, b))
    return runs


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                  ("kept_sha256", pa.string()), ("kept", pa.binary())])


def remove_repeats(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, with
    ``with_bytes``, the remaining bytes (``kept``).

    Null text is empty. Repeated rows repeat each other's strings and lose them. An empty
    table gives an empty result; extra columns are not read.
    """
    rows = row_keys(docs.select(F.col("doc_id").cast("bigint"), "text"))
    held = rows.join(repeated_spans(rows), ["f", "r"], "left").select("doc_id", "text", "spans")
    schema = _OUT if with_bytes else pa.schema(list(_OUT)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                t, kept, at = _bytes(text.as_py()), [], 0
                runs = covered([(x["start"], x["end"]) for x in spans or []])
                for a, b in runs:
                    kept.append(t[at:a])
                    at = b
                rest = b"".join([*kept, t[at:]])
                out.append((doc, len(t), len(t) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return held.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
                           + (", kept binary" if with_bytes else ""))
