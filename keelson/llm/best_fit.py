"""Best-fit packing of token sequences with bounded open space.

Documents become ids and a closing id 0; a document longer than a sequence is cut into
full pieces, the first one possibly shorter. Pieces are dealt evenly over tasks, and each
task packs its own online, in the order of the table: a piece goes into the open bin with the
least room that holds it. A fixed number of bins is open; their free space is the key of a
bitset, where the lowest set bit at or above a length is the best fit, and the lowest of all
is the fullest bin, which closes when another bin is opened beyond that number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stored
from keelson.llm.tokens import default_path, encoder

SEQUENCE = 2048
END_ID = 0
OPEN_BINS = 64
#: Pieces that one task packs: enough for full sequences, few enough for any executor.
PIECES_PER_TASK = 32_768


class OpenBins:
    """Open bins of one task: place(length) gives (bin, offset)."""

    def __init__(self, size: int = SEQUENCE, most: int = OPEN_BINS):
        self.size, self.most = size, most
        self.free_set = 0                                # bit f: some open bin has f free
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        fits = self.free_set >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.free_set & -self.free_set).bit_length() - 1)
            free, number = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.free_set |= 1 << left
            self.open += 1
        return number, self.size - free

    def _take(self, free: int) -> int:
        number = self.by_free[free].pop()
        if not self.by_free[free]:
            self.free_set &= ~(1 << free)
        self.open -= 1
        return number


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids_crc32", pa.int64())])


def cut(n: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    first = n % size
    starts = [0] if first else []
    starts += range(first, n, size)
    return [(s, (first if s == 0 and first else size)) for s in starts]


def token_pieces(docs: DataFrame, path: str | None = None, size: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of every document (``doc_id, text``): place, length and checksum, and with
    ``with_ids`` the ids themselves (binary, unsigned 32-bit little-endian)."""
    path = path or default_path()
    schema = _PIECES.append(pa.field("ids", pa.binary())) if with_ids else _PIECES

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path), END_ID.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.ids(text.as_py() or "") + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    part = ids[4 * start:4 * (start + length)]
                    rows.append((doc_id, k, start, length, zlib.crc32(part), *([part] if with_ids else [])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        pieces, PIECES + (", ids binary" if with_ids else ""))


def pack(pieces: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS,
         per_task: int = PIECES_PER_TASK) -> DataFrame:
    """``pieces`` (stored, with ``length``) plus ``sequence_id, offset``."""
    tasks = max(1, -(-pieces.count() // per_task))
    spread = (pieces.withColumn("__at", F.monotonically_increasing_id())
              .repartition(tasks, "__at").sortWithinPartitions("__at").drop("__at"))
    at = spread.columns.index("length")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        bins, base = OpenBins(size, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + b for b, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())], names=[*batch.schema.names, "sequence_id", "offset"])

    from pyspark.sql.types import LongType, StructType
    schema = StructType(spread.schema.fields[:]).add("sequence_id", LongType()).add("offset", LongType())
    return spread.mapInArrow(fit, schema)


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null text is empty: its one piece is the closing id. Repeated rows are packed as often
    as they occur. An empty table gives an empty result; other columns are not read.
    """
    return pack(stored(token_pieces(docs, path), "pieces"))
