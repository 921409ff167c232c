"""A table kept as its changes.

Each batch of changes is one folder of Parquet, named by where it came from::

    <path>/__source=<query or load id>/__batch=<batch id>/part-*.parquet
    <path>/_schemas/<hash>/                 the schemas the batches were written with

A batch is reduced by key (SCD 1) and written as it is; what a batch costs follows the
batch, never the table. Writing a batch again overwrites its folder, so a replay after a
failure changes nothing, and batches of another query (a new checkpoint) are other folders.
The table is resolved when it is read, by the same change operators that batch jobs use;
their result does not depend on order or batching, so no commit order is needed.
``compacted`` writes the resolved state as one batch of a new table, with the list of batches it
covers; the new table reads all others from the old one. Where the table format has row-level
operations, ``keelson.operators.changes.merge_into`` merges in place instead.

A batch may add columns, or widen a number; both are seen by every reader from then on (older
rows have nulls). A column whose type does not fit is an error before anything is written, and
so is a feed with a column named like the table's own folders.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from keelson.operators import changes as C
from keelson.operators.checksums import bucket_of, bucket_sums, differing
from keelson.session import checkpointed

MODES = ("scd1", "scd2", "scd1_deletes", "scd2_deletes")
SOURCE, BATCH, ORIGIN, VERSION, PART = "__source", "__batch", "__origin", "__version", "__part"
_PLACE = [ORIGIN, SOURCE, BATCH]
#: Each type can be read as any later one of its list.
_WIDER = [[T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()], [T.FloatType(), T.DoubleType()],
          [T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()]]


def wider(a: T.DataType, b: T.DataType, name: str = "") -> T.DataType:
    """The type that holds values of both; an error if there is none. Associative."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for kinds in _WIDER:
        if a in kinds and b in kinds:
            return kinds[max(kinds.index(a), kinds.index(b))]
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b, f"{name}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType, name), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(wider(a.keyType, b.keyType, name), wider(a.valueType, b.valueType, name), True)
    raise ValueError(f"column {name}: type {b.simpleString()} does not fit {a.simpleString()}")


def merged(a: T.StructType, b: T.StructType, prefix: str = "") -> T.StructType:
    """Columns of ``a``, widened to hold those of ``b``, then the columns ``b`` adds."""
    of = {f.name: f.dataType for f in b.fields}
    both = [T.StructField(f.name, wider(f.dataType, of.pop(f.name, f.dataType), prefix + f.name)) for f in a.fields]
    return T.StructType(both + [T.StructField(n, t) for n, t in of.items()])


class Folders:
    """Parquet folders under one path that share a schema which grows with what is written."""

    def __init__(self, spark: SparkSession, path: str, places: tuple[str, ...]):
        self.spark, self.path, self.places = spark, path.rstrip("/"), places

    def schema(self) -> T.StructType | None:
        """All columns written so far; None before the first write."""
        try:  # a row per schema the table ever had
            texts = self.spark.read.text(f"{self.path}/_schemas/*").distinct().collect()
        except AnalysisException:
            return None
        out = None
        for schema in sorted((T.StructType.fromJson(json.loads(r.value)) for r in texts), key=lambda s: (len(s), s.json())):
            out = schema if out is None else merged(out, schema)
        return out

    def declare(self, schema: T.StructType) -> None:
        taken = [c for c in schema.names if c in (SOURCE, BATCH, ORIGIN, VERSION, PART)]
        if taken:
            raise ValueError(f"column names {taken} are the table's own")
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        before = self.schema()
        if before is not None and set(merged(before, plain).fields) == set(before.fields):
            return
        text = plain.json()
        place = f"{self.path}/_schemas/{hashlib.sha256(text.encode()).hexdigest()[:16]}"
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(place)

    def read(self) -> DataFrame | None:
        """Every row with the folders it lies in; None before the first write."""
        schema = self.schema()
        if schema is None:
            return None
        for place in self.places:
            schema = T.StructType(schema.fields).add(place, T.StringType())
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException:
            return None

    def write(self, rows: DataFrame, *values) -> None:
        self.declare(rows.schema)
        rows.write.mode("overwrite").parquet("/".join([self.path, *(f"{p}={v}" for p, v in zip(self.places, values))]))


class ChangeTable:
    """``retention`` (an interval such as ``'30 days'``, or a number for a numeric sequence): tombstones
    older than the newest sequence by more than that are left out when the table is read or
    compacted; see ``keelson.operators.changes.expire_tombstones``."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], seq: str, tie: str | None = None,
                 mode: str = "scd1", retention: str | int | None = None):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        self.spark, self.path, self.keys, self.seq, self.tie, self.mode = spark, path.rstrip("/"), list(keys), seq, tie, mode
        self.retention = retention
        self.folders = Folders(spark, self.path, (SOURCE, BATCH))

    def write(self, changes: DataFrame, source: str, batch: int) -> None:
        """Add one batch; the same (source, batch) again replaces it. A row without a sequence
        fails the batch (decision D6); ``quarantine`` splits such rows off first."""
        if self.mode.startswith("scd1"):
            changes = C.latest_per_key(changes, self.keys, self.seq, self.tie)
        else:
            changes = C.require_seq(changes, self.seq)
        self.folders.write(changes, source, batch)

    def _placed(self) -> DataFrame | None:
        """All rows written so far with the table, source and batch they lie in, those that a
        compaction did not cover included."""
        own = self.folders.read()
        own = None if own is None else own.withColumn(ORIGIN, F.lit(self.path))
        try:
            covers = self.spark.read.parquet(f"{self.path}/_covers")
        except AnalysisException:
            return own
        base = ChangeTable(self.spark, covers.first()["path"], self.keys, self.seq, self.tie, self.mode)._placed()
        if base is None:
            return own
        # one row a covered batch
        return C.union_changes(own, base.join(covers.select(*_PLACE), _PLACE, "left_anti"))

    def changes(self) -> DataFrame | None:
        """All rows written so far; None before the first batch."""
        rows = self._placed()
        return None if rows is None else rows.drop(*_PLACE)

    def _resolved(self, rows: DataFrame | None) -> DataFrame | None:
        if rows is None:
            return None
        if self.mode.startswith("scd1"):
            state = C.latest_per_key(rows, self.keys, self.seq, self.tie)
        else:
            state = C.history_of(rows, self.keys, self.seq, self.tie)
        if self.retention is None:
            return state
        last = rows.agg(F.max(self.seq).alias("last"))
        width = f"interval {self.retention}" if isinstance(self.retention, str) else str(self.retention)
        bound = last.select((F.col("last") - F.expr(width)).cast("string")).first()[0]
        return state if bound is None else C.expire_tombstones(state, self.seq, bound)

    def state(self) -> DataFrame | None:
        """The resolved table with its tombstones: pass it on, or ``read`` it."""
        return self._resolved(self.changes())

    def read(self) -> DataFrame | None:
        """The table as its readers see it."""
        state = self.state()
        return None if state is None else C.live(state)

    def compacted(self, path: str) -> ChangeTable:
        """The same table below ``path``, its rows resolved into a single batch: they are changes
        that resolve to themselves. The batches that were there when it began are listed as
        covered; a batch that the old table gets later is read from there."""
        new = ChangeTable(self.spark, path, self.keys, self.seq, self.tie, self.mode, self.retention)
        rows = self._placed()
        if rows is None:
            return new
        place = f"{new.path}/_covers"
        (rows.select(*_PLACE).distinct().withColumn("path", F.lit(self.path))
         .coalesce(1).write.mode("overwrite").parquet(place))
        covered = rows.join(self.spark.read.parquet(place).select(*_PLACE), _PLACE, "left_semi")
        state = self._resolved(covered.drop(*_PLACE))
        new.folders.write(state.drop(C.START_AT, C.END_AT), "compacted", 0)
        return new


class SnapshotTable:
    """Snapshots of a source by version, each one folder of what changed::

        <path>/__version=<n>/__part=<bucket>/part-*.parquet
        <path>/_sums/__version=<n>/             checksums of the snapshot's buckets

    The first version holds the snapshot, every later one the keys that differ from the
    state before it (rows of the new snapshot, or tombstones); what is written follows the
    difference. Only the buckets whose checksums differ from the last version's are read back
    and joined. SCD 1 and SCD 2 are both read from the same rows. ``parts`` is fixed by the first
    version.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], parts: int = 64):
        self.spark, self.path, self.keys, self.parts = spark, path.rstrip("/"), list(keys), parts
        self.folders = Folders(spark, self.path, (VERSION, PART))

    def changes(self) -> DataFrame | None:
        rows = self.folders.read()
        return None if rows is None else rows.withColumns({VERSION: F.col(VERSION).cast("bigint"), PART: F.col(PART).cast("int")})

    def sums(self, version: int) -> DataFrame | None:
        """Checksums of the last version up to ``version``, one row a bucket."""
        try:
            sums = self.spark.read.parquet(f"{self.path}/_sums").where(F.col(VERSION) <= version)
        except AnalysisException:
            return None
        last = sums.agg(F.max(VERSION)).first()[0]
        return None if last is None else sums.where(F.col(VERSION) == last).drop(VERSION)

    def last_version(self) -> int | None:
        """The last version, whether or not anything changed in it."""
        try:
            return self.spark.read.parquet(f"{self.path}/_sums").agg(F.max(VERSION).cast("bigint")).first()[0]
        except AnalysisException:
            return None

    def write(self, snapshot: DataFrame, version: int | None = None) -> int:
        """Apply a snapshot as ``version`` (default: the next one); the last version again
        replaces it, an older one is an error. A column that the snapshot lacks becomes null."""
        last = self.last_version()
        if version is None:
            version = 0 if last is None else last + 1
        if last is not None and version < last:
            raise ValueError(f"snapshot version {version} is older than {last}")
        kept = self.sums(version - 1)
        columns = [f.name for f in (self.folders.schema() or []) if f.name != C.OP]
        before = None if kept is None else self.changes().where(F.col(VERSION) < version)
        if before is not None:
            self.parts = kept.first()["parts"]
            gone = self.folders.schema()
            snapshot = C.union_changes(snapshot, self.spark.createDataFrame([], T.StructType([gone[c] for c in columns])))
        placed = snapshot.withColumn(PART, bucket_of(snapshot, self.keys, self.parts))
        every = self.spark.range(self.parts).select(F.col("id").cast("int").alias(PART), F.lit(self.parts).alias("parts"))
        sums = every.join(bucket_sums(placed, [PART], snapshot.columns), PART, "left")
        sums = checkpointed(sums.fillna(0))  # an empty bucket has a row, too: a version always has its sums
        if before is None:
            rows = C.mark(placed, C.UPSERT)
        else:
            from keelson.operators.snapshot import CHANGE, snapshot_changes
            parts = [r[PART] for r in differing(kept, sums, [PART]).collect()]  # at most self.parts numbers
            here = F.col(PART).isin(parts) if parts else F.lit(False)
            before = C.live(C.latest_per_key(before.where(here), self.keys, VERSION)).drop(VERSION, PART)
            before = C.union_changes(snapshot.limit(0), before).select(*snapshot.columns)
            diff = snapshot_changes(before, placed.where(here).drop(PART), self.keys)
            values = [c for c in snapshot.columns if c not in self.keys]
            rows = diff.select(*self.keys, *[F.col("__new").getField(c).alias(c) for c in values],
                               F.when(F.col(CHANGE) == "delete", C.DELETE).otherwise(C.UPSERT).alias(C.OP))
            rows = rows.select(*snapshot.columns, C.OP, bucket_of(rows, self.keys, self.parts).alias(PART))
        self.folders.declare(rows.drop(PART).schema)
        rows.write.mode("overwrite").partitionBy(PART).parquet(f"{self.path}/{VERSION}={version}")
        sums.write.mode("overwrite").parquet(f"{self.path}/_sums/{VERSION}={version}")
        return version

    def as_of(self, version: int) -> DataFrame | None:
        """The snapshot that ``version`` stood for; None if there was none yet."""
        rows = self.changes()
        if rows is None:
            return None
        rows = rows.where(F.col(VERSION) <= version)
        if rows.limit(1).count() == 0:
            return None
        return C.live(C.latest_per_key(rows, self.keys, VERSION)).drop(VERSION, PART)

    def read(self) -> DataFrame | None:
        last = self.last_version()
        return None if last is None else self.as_of(last)

    def history(self) -> DataFrame | None:
        """SCD 2: every version of a key with the snapshot versions it was valid for."""
        rows = self.changes()
        return None if rows is None else C.live(C.history_of(rows, self.keys, VERSION)).drop(VERSION, PART)
