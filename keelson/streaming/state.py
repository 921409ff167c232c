"""Change streams resolved in a state store (T4, T6, decision D8).

``changed_keys`` keeps, per key, only the place of its winning change in the order (sequence,
deletes last, tie) in Spark's state store, and emits a key's new row in the micro-batch in which
it wins: what flows on is what changed, and a replayed or late, older change is dropped at
once. A tombstone stays in the state until the watermark, the newest sequence less the
retention, has passed it; from then on, changes as old as it are too late to be read at all,
so nothing can bring the deleted key back. The state holds the key as text and three numbers per
live key and per tombstone within the retention. Rows are reduced chunk by chunk, whatever
their number.

Spark calls the reducing function once per group and micro-batch, which costs milliseconds, far
more than the rows do. Keys therefore share a group by their hash: a micro-batch makes at most
``BUCKETS`` calls, however many keys there are. A group's state is rewritten when one of its keys
changes, which costs less than the call up to some hundred keys a group, millions in all.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from keelson.functions.canonical import row_hash
from keelson.operators import changes as C

_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
         "ignoreNullFields": "false"}
#: Groups that the keys share; fixed in a checkpoint.
BUCKETS = 1 << 14
_COLUMNS = ["__k", "__s", "__o", "__i", "__row"]
_STATE = "ks array<string>, ss array<bigint>, os array<bigint>, ts array<bigint>"


def _latest(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    best, rows = ({k: order for k, *order in zip(*state.get)} if state.exists else {}), {}
    if not state.hasTimedOut:
        for chunk in chunks:
            for k, *order, row in zip(*(chunk[c].tolist() for c in _COLUMNS)):
                if k not in best or order > best[k]:
                    best[k], rows[k] = order, row
    mark = state.getCurrentWatermarkMs()
    gone = [k for k, (s, o, _) in best.items() if o and s // 1000 + 1 < mark]  # tombstones the watermark has passed
    for k in gone:
        del best[k]
    if best and (rows or gone):
        state.update((list(best), *(list(part) for part in zip(*best.values()))))
    elif not best and state.exists:
        state.remove()
    ends = [s // 1000 for s, o, _ in best.values() if o]
    if ends:
        state.setTimeoutTimestamp(max(min(ends), mark) + 1)
    if rows:
        yield pd.DataFrame({"__row": list(rows.values())})


def _key_text(df: DataFrame, keys: list[str]) -> Column:
    """A text that is the same exactly for rows that ``groupBy`` puts together."""
    one = lambda c: F.col(c) + 0.0 if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(c)
    return F.to_json(F.struct(*[one(k).alias(f"k{i}") for i, k in enumerate(keys)]), _JSON)


def changed_keys(stream: DataFrame, keys: list[str], seq: str, retention: str, tie: str | None = None) -> DataFrame:
    """The rows of ``stream`` that become their key's current one, micro-batch by micro-batch;
    tombstones have ``_op = 'delete'``. Run it in output mode ``update``.

    ``seq`` is a date or timestamp; ``retention`` (such as ``'30 days'``) bounds how late a change
    may be: older ones are dropped, and counted by Spark as rows dropped by the watermark.
    ``tie`` is a whole number (default: a hash of the row). A change without a sequence fails
    its batch (decision D6).
    """
    kind = stream.schema[seq].dataType
    if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{seq} must be a date or a timestamp to expire by event time")
    if tie and not isinstance(stream.schema[tie].dataType, T.IntegralType):
        raise ValueError(f"tie column {tie} must be a whole number")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema.fields])
    checked = C.require_seq(stream, seq)
    at = F.col(seq).cast("timestamp")
    rank = F.when(F.col(C.OP) == C.DELETE, 1).otherwise(0) if C.OP in stream.columns else F.lit(0)
    last = F.coalesce(F.col(tie).cast("bigint"), F.lit(-(2 ** 63)).cast("bigint")) if tie else row_hash(stream)
    text = _key_text(checked, keys)
    staged = checked.select(F.pmod(F.xxhash64(text), F.lit(BUCKETS)).alias("__b"), text.alias("__k"), at.alias("__t"),
                            F.unix_micros(at).alias("__s"), rank.cast("bigint").alias("__o"), last.alias("__i"),
                            F.to_json(F.struct(*stream.columns), _JSON).alias("__row"))
    rows = (staged.withWatermark("__t", retention).groupBy("__b")
            .applyInPandasWithState(_latest, "__row string", _STATE, "update", GroupStateTimeout.EventTimeTimeout))
    return rows.select(F.from_json("__row", schema, _JSON).alias("r")).select("r.*")


def stream_state_run(spark: SparkSession, sf_dir: str, batches: int = 3) -> DataFrame:
    """Upserts and deletes of the events, landed newest first and streamed an arrival at a time in
    two runs, through the state store into a change table; the retention covers all of them."""
    from keelson.plans import inputs as I
    from keelson.session import work_dir
    from keelson.streaming import flows as FL
    from keelson.streaming.target import ChangeTable
    base = work_dir(spark, "stream-state")
    events = I.events(spark, sf_dir)
    feed = C.union_changes(C.mark(I.upserts_of(events), C.UPSERT), C.mark(I.deletes_of(events), C.DELETE))
    table = ChangeTable(spark, f"{base}/target", I.EVENT_KEYS, I.EVENT_SEQ, I.EVENT_TIE, "scd1_deletes")
    states = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(states), 2 * spark.sparkContext.defaultParallelism)))
    try:
        for stream in FL.landed_runs(feed, I.EVENT_SEQ, batches, f"{base}/src"):
            FL.run_available(changed_keys(stream, I.EVENT_KEYS, I.EVENT_SEQ, "3650 days", I.EVENT_TIE), f"{base}/chk",
                             batch_fn=FL.ChangeSink(table), mode="update")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", states)
    return table.read()
