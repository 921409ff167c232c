"""Language-model scores from a log-frequency Bloom filter.

Unigrams and bigrams of the training documents are counted in hash partitions. A count is
kept as its level ``1 + floor(log2 count)``, and the pair (n-gram, j) enters the filter for
every j up to that level; a lookup probes levels upwards until one is missing. The filter's
size follows the number of different n-grams and their levels, for the same rate of false
hits at every input size. It is cut into one segment per hash partition, so a partition's
task makes its own segment. Up to ``BROADCAST_BITS`` the filter is broadcast; above, the
segments stay a table, and each block's n-grams are sent to their segments and looked up there.

The model interpolates the bigram's share of its history with the add-one unigram
probability. The weight depends on the level of the history's count and is chosen, for each
level, by the likelihood of all training documents with each bigram left out of its own
count. Exact unigram counts, for the base score, are joined block by block: each block of
documents gets the counts of its own words only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import row_keys, stored

#: The largest filter that is broadcast.
BROADCAST_BITS = 1 << 30
#: The smallest segment.
LEAST_BITS = 1 << 12
#: Bits per setting (an n-gram sets ``HASHES`` a level): 31.6% full, so 1% false hits a level.
BITS_PER_SETTING = 2.63
PARTS = 1 << 10
HASHES = 4
#: Rows of a file that share one table of exact counts.
BLOCK_ROWS = 4096
#: A text of more bytes than this is a block of its own, so a block holds at most 256 MB of other texts.
LONG_TEXT = 1 << 16
#: Keys that are looked up together: their intermediate arrays are small.
AT_ONCE = 1 << 17
#: Training rows per hash partition and task; more rows make more tasks per partition.
ROWS_PER_SUB = 1 << 22
#: Tokens that a task holds before it hands on counts.
HELD_TOKENS = 1 << 19
LEVELS = 48
WEIGHTS = (0.0, 0.001, 0.01, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.97)
END = b"\n"
_STEPS = LEVELS + 1
#: Combinations of the levels of a token, of its bigram and of its history.
CELLS = _STEPS ** 3
#: Expected count of each level.
_COUNT = np.array([0.0] + [(2.0 ** (q - 1) + 2.0 ** q - 1) / 2 for q in range(1, LEVELS + 1)])


def held_out(doc_id: Column) -> Column:
    """Documents that the model does not learn from."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2, F.lit(False))


def tokens(text: str | None) -> list[bytes]:
    words = as_bytes(text).lower().split()
    words.append(END)
    return words


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_RADIX = 0x9E3779B97F4A7C15                                # odd, so it has an inverse modulo 2^64
_END_HASH = np.uint64(0x5851F42D4C957F2D)
SEED = 7
#: Bytes whose powers of the radix are kept.
PIECE = 1 << 18


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix, and their inverses."""
    power = lambda r: np.cumprod(np.r_[np.uint64(1), np.full(PIECE, r, np.uint64)])
    return power(_RADIX), power(pow(_RADIX, -1, 1 << 64))


@cache
def _byte_values(seed: int) -> np.ndarray:
    values = _mix((np.arange(256, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0xD6E8FEB86659FD93))
    values[65:91] = values[97:123]                         # A-Z count as a-z
    return values


def word_hashes(data: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of the bytes: a polynomial of its bytes modulo 2^64, from
    running sums over pieces of the text. A word longer than a piece is summed piece by piece."""
    edges = np.flatnonzero(np.diff(_SPACE[data], prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    (power, inverse), values = _powers(), _byte_values(seed)
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        a = starts[i]
        j = int(np.searchsorted(ends, a + PIECE, "right"))
        if j > i:
            sums = np.zeros(ends[j - 1] - a + 1, np.uint64)
            np.cumsum(values[data[a:ends[j - 1]]] * power[:len(sums) - 1], out=sums[1:])
            at = starts[i:j] - a
            out[i:j] = (sums[ends[i:j] - a] - sums[at]) * inverse[at]
        else:
            j, total = i + 1, 0
            for o in range(a, ends[i], PIECE):
                part = values[data[o:min(o + PIECE, ends[i])]]
                total += int((part * power[:len(part)]).sum(dtype=np.uint64)) * pow(_RADIX, int(o - a), 1 << 64)
            out[i] = total % (1 << 64)
        i = j
    return starts, _mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def hashes(words: list[bytes], seed: int = SEED) -> np.ndarray:
    """Hashes of tokens as ``tokens`` gives them."""
    out = np.full(len(words), _END_HASH)
    real = np.fromiter((w != END for w in words), bool, len(words))
    out[real] = word_hashes(np.frombuffer(b" ".join(w for w in words if w != END), np.uint8), seed)[1]
    return out


def text_hashes(texts: list[bytes], seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, one text after another, and the number of tokens of each."""
    starts, h = word_hashes(np.frombuffer(END.join(texts) + END, np.uint8), seed)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    before = np.searchsorted(starts, ends)
    return np.insert(h, before, _END_HASH), np.diff(before, prepend=0) + 1


def as_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def hashed(texts: Iterator[str | None], seed: int = SEED) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``text_hashes`` of whole texts, about ``HELD_TOKENS`` tokens at a time."""
    held, n = [], 0
    for t in texts:
        held.append(as_bytes(t))
        n += len(held[-1])
        if n >= 8 * HELD_TOKENS:
            yield text_hashes(held, seed)
            held, n = [], 0
    if held:
        yield text_hashes(held, seed)


def bigram_hashes(h: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it. A text begins after an end; texts that
    stand one after another need no more, as each ends with one."""
    before = np.concatenate([hashes([END]), h[:-1]])
    return _mix(before * np.uint64(0x9E3779B97F4A7C15) + h)


def _unigram_key(h: np.ndarray) -> np.ndarray:
    return _mix(h + np.uint64(0xD1B54A32D192ED03))


_COUNTS = pa.schema([("part", pa.int32()), ("sub", pa.int32()), ("words", pa.binary()), ("word_n", pa.binary()),
                     ("once", pa.binary()), ("grams", pa.binary()), ("gram_n", pa.binary())])
_COUNTS_SQL = "part int, sub int, words binary, word_n binary, once binary, grams binary, gram_n binary"


def _part(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(54)).astype(np.int64)


def _rest(key: np.ndarray) -> np.ndarray:
    return ((key >> np.uint64(22)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _key(part: int, rest: np.ndarray) -> np.ndarray:
    """The bits of a key that lookups compare."""
    return (np.uint64(part) << np.uint64(54)) | (rest.astype(np.uint64) << np.uint64(22))


def _sub(rest: np.ndarray, subs: int) -> np.ndarray:
    """Share of the hash partition that a key is in."""
    return (rest & np.uint32(0xFFFF)).astype(np.int64) % subs


def segment_bits(settings: int, segments: int) -> int:
    """Bits of each of ``segments`` segments, whole bytes."""
    return max(LEAST_BITS, 8 * math.ceil(settings * BITS_PER_SETTING / segments / 8))


def _counter(subs: int):
    """mapInArrow function: packed counts of a task's tokens per hash partition."""
    def counted(h: np.ndarray) -> pa.RecordBatch:
        w, wn = np.unique(_unigram_key(h), return_counts=True)
        g = bigram_hashes(h)
        g, gn = np.unique(_part(g) << 32 | _rest(g), return_counts=True)
        wn, gn = wn.astype(np.uint32), gn.astype(np.uint32)
        rest = (g & 0xFFFFFFFF).astype(np.uint32)
        w_slot, g_slot = _part(w) * subs + _sub(_rest(w), subs), (g >> 32) * subs + _sub(rest, subs)
        w_at, g_at = np.argsort(w_slot, kind="stable"), np.argsort(g_slot, kind="stable")
        slots = np.arange(PARTS * subs + 1)
        w_cut, g_cut = np.searchsorted(w_slot[w_at], slots), np.searchsorted(g_slot[g_at], slots)
        rows = []
        for s in range(PARTS * subs):
            a, b = w_at[w_cut[s]:w_cut[s + 1]], g_at[g_cut[s]:g_cut[s + 1]]
            if len(a) or len(b):
                many = gn[b] > 1
                rows.append((s // subs, s % subs, w[a].tobytes(), wn[a].tobytes(), rest[b[~many]].tobytes(),
                             rest[b[many]].tobytes(), gn[b[many]].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _COUNTS)], schema=_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, _ in hashed(t.as_py() for batch in batches for t in batch.column(0)):
            yield counted(h)
    return run


class _Probes:
    """Bits of n-grams in their segments, by double hashing: probe number ``k`` of a level
    is the first hash plus a multiple of the second."""

    def __init__(self, key: np.ndarray, bits: int):
        self.bits = np.uint64(bits)
        self.first = _mix((key >> np.uint64(22)) * np.uint64(0x9E3779B97F4A7C15))
        self.step = (self.first >> np.uint64(32)) | np.uint64(1)

    def at(self, level: int, which: int, chosen: np.ndarray | slice = slice(None)) -> np.ndarray:
        k = np.uint64(level * HASHES + which)
        return ((self.first[chosen] + k * self.step[chosen] & np.uint64(0xFFFFFFFF)) * self.bits) >> np.uint64(32)


def _levels(n: np.ndarray) -> np.ndarray:
    return np.minimum(LEVELS, 1 + np.floor(np.log2(np.maximum(n, 1))).astype(np.int64))


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, at = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(at, weights=np.concatenate(counts).astype(np.float64), minlength=len(k)).astype(np.int64)


_MERGED_SQL = "part int, sub int, words binary, word_q binary, grams binary, gram_q binary, n bigint, v bigint, settings bigint"


def _merged(table: pa.Table) -> pa.Table:
    """Counts of one hash partition (or a share of it) → its n-grams with their levels, and
    sums for the model."""
    part, sub = table.column("part")[0].as_py(), table.column("sub")[0].as_py()
    get = lambda c, t: [np.frombuffer(x.as_py(), t) for x in table.column(c)]
    w, wn = _merge(get("words", np.uint64), get("word_n", np.uint32))
    once = get("once", np.uint32)
    g, gn = _merge(once + get("grams", np.uint32), [np.ones(len(x), np.uint32) for x in once] + get("gram_n", np.uint32))
    wq, gq = _levels(wn), _levels(gn)
    row = {"part": part, "sub": sub, "words": w.tobytes(), "word_q": wq.astype(np.uint8).tobytes(), "grams": g.astype(np.uint32).tobytes(),
           "gram_q": gq.astype(np.uint8).tobytes(), "n": int(wn.sum()), "v": len(w), "settings": HASHES * int(wq.sum() + gq.sum())}
    kind = dict.fromkeys(("part", "sub"), pa.int32()) | dict.fromkeys(("n", "v", "settings"), pa.int64())
    return pa.table({k: pa.array([x], kind.get(k, pa.binary())) for k, x in row.items()})


_SEGMENTS_SQL = "part int, sub int, bits binary"


def _segments(size: int):
    """mapInArrow function: the bits of each row of merged counts, ``size`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, sub, words, word_q, grams, gram_q = (batch.column(i)[row].as_py() for i in range(6))
                g = _key(part, np.frombuffer(grams, np.uint32))
                bits = np.zeros(size, np.uint8)
                for keys, q in ((np.frombuffer(words, np.uint64), word_q), (g, gram_q)):
                    q, probes, live = np.frombuffer(q, np.uint8), _Probes(keys, size), np.arange(len(keys))
                    level = 1
                    while len(live):
                        for i in range(HASHES):
                            bits[probes.at(level, i, live).astype(np.int64)] = 1
                        level += 1
                        live = live[q[live] >= level]
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([sub], pa.int32()),
                                                  pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["part", "sub", "bits"])
    return run


def _either(table: pa.Table) -> pa.Table:
    part = table.column("part")[0].as_py()
    bits = np.bitwise_or.reduce([np.frombuffer(x.as_py(), np.uint8) for x in table.column("bits")])
    return pa.table({"part": pa.array([part], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})


class Filter:
    """Lookups in the filter, or in one segment of it."""

    def __init__(self, bits: bytes, segments: int = PARTS):
        self.bits, self.segments = np.frombuffer(bits, np.uint8), segments

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key, 0 if it is not there."""
        level = np.zeros(len(keys), np.int8)
        for i in range(0, len(keys), AT_ONCE):
            self._climb(keys[i:i + AT_ONCE], level[i:i + AT_ONCE])
        return level

    def _climb(self, keys: np.ndarray, level: np.ndarray) -> None:
        """Write the level of each key: its probes step by step, until one is missing."""
        size = 8 * len(self.bits) // self.segments
        probes = _Probes(keys, size)
        base = (keys >> np.uint64(54)) * np.uint64(size if self.segments > 1 else 0)
        step = probes.step.astype(np.uint32)
        at = (probes.first + np.uint64(HASHES) * probes.step).astype(np.uint32)     # level 1, probe 0
        live, hit = np.arange(len(keys)), np.ones(len(keys), bool)
        for j in range(1, LEVELS + 1):
            for i in range(HASHES):
                p = base + (at.astype(np.uint64) * probes.bits >> np.uint64(32))
                hit &= (self.bits.take((p >> np.uint64(3)).view(np.int64)) >> (p & np.uint64(7)).astype(np.uint8) & np.uint8(1)).view(bool)
                at = at + step
                if i == HASHES - 1 or 4 * np.count_nonzero(hit) < 3 * len(hit):
                    live, at, step, base = live[hit], at[hit], step[hit], base[hit]
                    hit = np.ones(len(live), bool)
            if not len(live):
                break
            level[live] = j

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Expected count of each key, 0 if it is not there."""
        return _COUNT[self.levels(keys)]

    def levels_of_repeated(self, keys: np.ndarray) -> np.ndarray:
        """Levels of keys that occur again and again: each is looked up once."""
        back, found = pd.factorize(keys)
        return self.levels(found)[back]


class Found(Filter):
    """Lookups that were made before, for one block: ``part, rests, levels`` of those that are there."""

    def __init__(self, table: pa.Table):
        rows = [x for x in zip(*(table.column(c).to_pylist() for c in ("part", "rests", "levels"))) if x[1] is not None]
        keys = [_key(part, np.frombuffer(rests, np.uint32)) for part, rests, _ in rows]
        self.keys, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_index=True)
        self.level = np.frombuffer(b"".join(x[2] for x in rows), np.int8)[at]

    def levels(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int8)
        keys = keys >> np.uint64(22) << np.uint64(22)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.level[at], np.int8(0))


class Model:
    """Filter (its bits, or what was found there), sums and weights."""

    def __init__(self, bits: bytes | Filter, n: int, v: int, weights: np.ndarray):
        self.filter = bits if isinstance(bits, Filter) else Filter(bits)
        self.n, self.v, self.weights = n, v, weights

    def cells(self, h: np.ndarray, uni: np.ndarray | None = None) -> np.ndarray:
        """Number of each token's combination of levels. ``h``: token hashes of whole texts
        one after another; ``uni``: an end's level and theirs, where they are known."""
        if uni is None:
            uni = self.filter.levels_of_repeated(_unigram_key(np.concatenate([hashes([END]), h])))
        uni = uni.astype(np.int64)
        return (uni[1:] * _STEPS + self.filter.levels_of_repeated(bigram_hashes(h))) * _STEPS + uni[:-1]

    def parts(self, cells: np.ndarray, left_out: bool = False):
        """Per combination of levels: add-one unigram probability, bigram share and history level."""
        uni, both, before = (_COUNT[q] for q in (cells // _STEPS ** 2, cells // _STEPS % _STEPS, cells % _STEPS))
        out = 1.0 if left_out else 0.0
        share = np.clip((both - out) / np.maximum(before - out, 1.0), 0.0, 1.0)
        p1 = (uni + 1.0) / (self.n + self.v + 1.0)
        return p1, share, np.where(before > out, _levels(before), 0)

    @cached_property
    def _logs(self) -> np.ndarray:
        p1, share, level = self.parts(np.arange(CELLS))
        w = self.weights[level]
        return np.log10(w * share + (1 - w) * np.minimum(p1, 1.0))

    def logs(self, h: np.ndarray, uni: np.ndarray | None = None) -> np.ndarray:
        return self._logs[self.cells(h, uni)]


def merged_counts(texts: DataFrame) -> tuple[DataFrame, int, int, int, int]:
    """Levels of all n-grams by hash partition, the number of shares of a partition, the
    number of settings, of tokens and of different tokens."""
    subs = max(1, -(-texts.count() // ROWS_PER_SUB))
    counts = texts.mapInArrow(_counter(subs), _COUNTS_SQL)
    merged = stored(counts.groupBy("part", "sub").applyInArrow(_merged, _MERGED_SQL), "levels")
    sums = merged.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("settings", "n", "v")]).first()
    return merged, subs, *sums


def _likelihood(model: Model, texts: Iterator[str | None]) -> np.ndarray:
    """Likelihood of the texts by history level and weight."""
    times = np.zeros(CELLS, np.int64)
    for h, _ in hashed(texts):
        times += np.bincount(model.cells(h), minlength=CELLS)
    cells = np.nonzero(times)[0]
    times = times[cells]
    p1, share, level = model.parts(cells, left_out=True)
    # relative to the unigram's likelihood: only where the bigram was seen is it more than 1 - w
    gain = share / p1
    return np.stack([np.bincount(level, times * np.log10(w * gain + (1 - w)), LEVELS + 1) for w in WEIGHTS], axis=1)


_LIKELIHOOD_SQL = "level int, k int, s double"


def _cells(total: np.ndarray) -> list[pa.Array]:
    at = np.nonzero(total)
    return [pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(total[at], pa.float64())]


def _best_weights(cells: DataFrame) -> np.ndarray:
    """The weight of each level with the highest likelihood."""
    likelihood = np.zeros((LEVELS + 1, len(WEIGHTS)))
    for row in cells.groupBy("level", "k").agg(F.sum("s").alias("s")).collect():
        likelihood[row.level, row.k] = row.s
    weights = np.array(WEIGHTS)[likelihood.argmax(axis=1)]
    weights[0] = 0.0
    return weights


def train(docs: DataFrame, text_col: str = "text") -> tuple[object, int, int]:
    """The model of ``docs`` as a broadcast, with the number of tokens and of different ones."""
    texts = docs.select(text_col)
    merged, subs, settings, n, v = merged_counts(texts)
    return broadcast_model(texts, merged, subs, settings, n, v), n, v


def broadcast_model(texts: DataFrame, merged: DataFrame, subs: int, settings: int, n: int, v: int):
    """The whole filter with sums and weights as a broadcast."""
    context = texts.sparkSession.sparkContext
    size = segment_bits(settings, PARTS)
    segments = merged.mapInArrow(_segments(size), _SEGMENTS_SQL)
    if subs > 1:
        segments = segments.select("part", "bits").groupBy("part").applyInArrow(_either, "part int, bits binary")
    held = bytearray(PARTS * size // 8)
    for row in stored(segments.select("part", "bits"), "filter").toLocalIterator():
        held[row.part * size // 8:(row.part + 1) * size // 8] = row.bits
    bits = bytes(held)
    del held
    flat = context.broadcast((bits, n, v))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*flat.value, np.zeros(LEVELS + 1))
        total = _likelihood(model, (t.as_py() for b in batches for t in b.column(0)))
        yield pa.RecordBatch.from_arrays(_cells(total), names=["level", "k", "s"])

    weights = _best_weights(texts.mapInArrow(weigh, _LIKELIHOOD_SQL))
    flat.destroy()
    return context.broadcast((bits, n, v, weights))


def looked_up(rows: DataFrame, merged: DataFrame, subs: int, settings: int) -> DataFrame:
    """``f, b, part, rests, levels``: the n-grams of each block that the filter holds, looked up
    segment by segment, one segment for each share of a hash partition."""
    segments = merged.mapInArrow(_segments(segment_bits(settings, PARTS * subs)), _SEGMENTS_SQL)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, n = None, [], 0

        def flush():
            h, _ = text_hashes(held)
            keys = np.unique(np.concatenate([_unigram_key(np.concatenate([hashes([END]), h])), bigram_hashes(h)]))
            rest = _rest(keys)
            slot = _part(keys) * subs + _sub(rest, subs)
            at = np.argsort(slot, kind="stable")
            found, begin = np.unique(slot[at], return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), x), t) for x, t in zip(block, (pa.int64(), pa.int64()))] + [
                pa.array(found // subs, pa.int32()), pa.array(found % subs, pa.int32()),
                pa.array([rest[x].tobytes() for x in np.split(at, begin[1:])], pa.binary())], names=["f", "b", "part", "sub", "rests"])
        for batch in batches:
            f, b = (batch.column(i).to_pylist() for i in range(2))
            for i, text in enumerate(batch.column(2)):
                if held and (block != (f[i], b[i]) or n >= 8 * HELD_TOKENS):
                    yield from flush()
                    held, n = [], 0
                block = f[i], b[i]
                held.append(as_bytes(text.as_py()))
                n += len(held[-1])
        if held:
            yield from flush()

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if right.num_rows:
            segment = Filter(right.column("bits")[0].as_py(), 1)
            for f, b, part, rests in zip(*(left.column(c).to_pylist() for c in ("f", "b", "part", "rests"))):
                rests = np.frombuffer(rests, np.uint32)
                level = segment.levels(_key(part, rests))
                out.append((f, b, part, rests[level > 0].tobytes(), level[level > 0].tobytes()))
        cols = list(zip(*out)) if out else [[]] * 5
        kinds = {"f": pa.int64(), "b": pa.int64(), "part": pa.int32(), "rests": pa.binary(), "levels": pa.binary()}
        return pa.table({c: pa.array(x, t) for x, (c, t) in zip(cols, kinds.items())})

    asked = rows.select("f", "b", "text").mapInArrow(ask, "f bigint, b bigint, part int, sub int, rests binary")
    found = (asked.groupBy("part", "sub").cogroup(segments.groupBy("part", "sub"))
             .applyInArrow(answer, "f bigint, b bigint, part int, rests binary, levels binary"))
    return stored(found, "found")


def weights_of_blocks(learnt: DataFrame, found: DataFrame, n: int, v: int) -> np.ndarray:
    """Weights by what was looked up for the blocks of the training rows."""
    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        model = Model(Found(right), n, v, np.zeros(LEVELS + 1))
        return pa.table(_cells(_likelihood(model, (t.as_py() for t in left.column("text")))), names=["level", "k", "s"])

    return _best_weights(learnt.select("f", "b", "text").groupBy("f", "b").cogroup(found.groupBy("f", "b"))
                         .applyInArrow(weigh, _LIKELIHOOD_SQL))


def block_words(docs: DataFrame) -> DataFrame:
    """Different words of each block (``f, b``) with their count in its training rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter
        block, trained, other = None, Counter(), set()

        def flush():
            names = [*trained, *(other - trained.keys())]
            n = [*trained.values()] + [0] * (len(names) - len(trained))
            yield pa.RecordBatch.from_arrays([pa.array([block[0]] * len(names), pa.int64()), pa.array([block[1]] * len(names), pa.int64()),
                                              pa.array(names, pa.binary()), pa.array(n, pa.int64())], names=["f", "b", "word", "n"])
        for batch in batches:
            f, b, held = (batch.column(i).to_pylist() for i in range(3))
            for i, text in enumerate(batch.column(3)):
                if block != (f[i], b[i]):
                    if block is not None:
                        yield from flush()
                    block, trained, other = (f[i], b[i]), Counter(), set()
                (other if held[i] else trained).update(tokens(text.as_py()))
        if block is not None:
            yield from flush()

    return docs.select("f", "b", "held_out", "text").mapInArrow(run, "f bigint, b bigint, word binary, n bigint")


_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def score(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score``.

    Null text is empty and has one token, the end; a very long one is a block of its own. A null id counts as empty text where the
    training documents are chosen. Repeated rows are learnt and scored one by one. An empty
    table gives an empty result; extra columns are not read.
    """
    block = F.when(F.octet_length("text") > LONG_TEXT, -1 - F.col("r")).otherwise(F.expr(f"r div {BLOCK_ROWS}"))
    rows = (row_keys(docs.select(F.col("doc_id").cast("bigint"), "text"))
            .select("doc_id", "text", "f", block.alias("b"), held_out(F.col("doc_id")).alias("held_out")))
    learnt = rows.where(~F.col("held_out"))
    merged, subs, settings, n, v = merged_counts(learnt.select("text"))
    known = (block_words(rows).withColumn("c", F.sum("n").over(Window.partitionBy("word")))
             .select("f", "b", "word", "c"))
    if PARTS * segment_bits(settings, PARTS) <= BROADCAST_BITS:
        flat, weights = broadcast_model(learnt.select("text"), merged, subs, settings, n, v), None
    else:
        found = looked_up(rows, merged, subs, settings)
        flat, weights = None, weights_of_blocks(learnt, found, n, v)
        known = known.unionByName(found, allowMissingColumns=True)
    floor = math.log10(n + 1 * (v + 1))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model = Model(*flat.value) if flat else Model(Found(right), n, v, weights)
        right = right.filter(pc.is_valid(right.column("word")))
        # the block's different words are hashed and looked up once; its texts are numbers of them
        right = right.group_by(["word"]).aggregate([("c", "max")])  # a long text cuts a block's rows in two
        names, seed = right.column("word").to_pylist(), SEED
        while len(np.unique(of := hashes(names, seed))) < len(names):
            seed += 1                                       # two of them share a hash
        number, h = pd.Index(of), hashes(names)
        logs, uni = np.log10(right.column("c_max").to_numpy() + 1.0), model.filter.levels(_unigram_key(h))
        end, out = names.index(END), []
        for x, sizes in hashed((t.as_py() for t in left.column("text")), seed):
            at = number.get_indexer(x)
            begin = np.cumsum([0, *sizes[:-1]])
            total = np.add.reduceat(model.logs(h[at], uni[np.r_[end, at]]), begin)
            base = logs[at]
            for a, n_tokens, s in zip(begin.tolist(), sizes.tolist(), total.tolist()):
                some = base[a:a + n_tokens]
                out.append((n_tokens, int(np.count_nonzero(some)), float(some.sum() - floor * n_tokens), s))
        cols = list(zip(*out)) if out else [[], [], [], []]
        return pa.table([left.column("doc_id").combine_chunks(), left.column("held_out").combine_chunks(), pa.array(cols[0], pa.int64()),
                         pa.array(cols[1], pa.int64()), pa.array([n] * len(out), pa.int64()), pa.array(cols[2], pa.float64()),
                         pa.array(cols[3], pa.float64())], schema=_SCORES)

    return rows.groupBy("f", "b").cogroup(known.groupBy("f", "b")).applyInArrow(
        run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
