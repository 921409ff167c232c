"""The query catalog: one Spark plan per operator key of the inventory, with its DuckDB oracle.

Every entry reads the given tables (or data Spark derives from them) whole. Keys without
an oracle are operators DuckDB cannot mirror; they are checked against brute force in
``tests/``.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.plans import inputs as I
from keelson.session import checkpointed, work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


# Fixed values of the conventions used by the catalog.
SINCE_TS = "2024-01-05 00:00:00"
UNTIL_TS = "2024-01-20 00:00:00"
ORDER_CURSOR = "1998-01-01 00:00:00"
ORDER_START = "1995-01-01 00:00:00"
STAMP = datetime.datetime(2024, 6, 30, 12, 0, 0)

V1 = "v1 as (select * from orders where o_orderpriority <> '1-URGENT')"
V2 = ("v2 as (select o_orderkey, o_custkey, o_orderstatus, case when o_orderstatus = 'O' "
      "then o_totalprice + 1 else o_totalprice end as o_totalprice, o_orderdate, o_orderpriority "
      "from orders where o_orderpriority <> '5-LOW')")
LATEST = ("select * from events qualify row_number() over "
          "(partition by user_id order by ts desc, event_id desc) = 1")
HISTORY = ('select *, ts as "__START_AT", lead(ts) over (partition by user_id '
           'order by ts, event_id) as "__END_AT" from events')
EK, ES, ET = I.EVENT_KEYS, I.EVENT_SEQ, I.EVENT_TIE


# ---------------------------------------------------------------- aggregations, SCD 1
from keelson.operators import changes as C  # noqa: E402
from keelson.operators import cursor as R  # noqa: E402
from keelson.operators import snapshot as S  # noqa: E402
from keelson.operators import expand as X  # noqa: E402
from keelson.operators.profile import table_profile  # noqa: E402


@register("latest_per_key", LATEST)
def q_latest_per_key(spark, d):
    return C.latest_per_key(I.events(spark, d), EK, ES, ET)


@register("scd1_upsert", LATEST)
def q_scd1_upsert(spark, d):
    ev = I.arrival_batch(I.events(spark, d), ES, 2)
    first = ev.where(F.col("__batch") == 0).drop("__batch")
    second = ev.where(F.col("__batch") == 1).drop("__batch")
    target = C.scd1_upsert(None, first, EK, ES, ET)
    return C.scd1_upsert(target, second, EK, ES, ET)


@register("late_arrivals", LATEST)
def q_late_arrivals(spark, d):
    """Four sequence ranges applied newest first (each later batch arrives late), with the
    target checkpointed between batches: same target as one pass."""
    n = 4
    ev = I.arrival_batch(I.events(spark, d), ES, n)
    target = None
    for b in range(n):
        feed = ev.where(F.col("__batch") == b).drop("__batch")
        target = checkpointed(C.scd1_upsert(target, feed, EK, ES, ET))
    return target


@register("scd1_with_deletes",
          f"select * from ({LATEST}) where event_type <> 'error'")
def q_scd1_with_deletes(spark, d):
    state = C.scd1_with_deletes(None, I.event_upserts(spark, d), I.event_deletes(spark, d), EK, ES, ET)
    return C.live(state)


@register("scd2_history", HISTORY)
def q_scd2_history(spark, d):
    ev = I.arrival_batch(I.events(spark, d), ES, 2)
    first = ev.where(F.col("__batch") == 0).drop("__batch")
    second = ev.where(F.col("__batch") == 1).drop("__batch")
    hist = checkpointed(C.scd2_history(None, first, EK, ES, ET))
    return C.scd2_history(hist, second, EK, ES, ET)


@register("scd2_with_deletes", f"select * from ({HISTORY}) where event_type <> 'error'")
def q_scd2_with_deletes(spark, d):
    """Four sequence ranges of the feed applied newest first; deletes stay in the state."""
    n = 4
    ev = I.arrival_batch(I.events(spark, d), ES, n)
    state = None
    for b in range(n):
        feed = ev.where(F.col("__batch") == b).drop("__batch")
        state = checkpointed(C.scd2_with_deletes(state, I.upserts_of(feed), I.deletes_of(feed), EK, ES, ET))
    return C.live_history(state)


@register("append_only", "select * from events")
def q_append_only(spark, d):
    ev = I.arrival_batch(I.events(spark, d), ES, 2)
    target = C.append_only(None, ev.where(F.col("__batch") == 0).drop("__batch"))
    return C.append_only(target, ev.where(F.col("__batch") == 1).drop("__batch"))


TOMBSTONES = ("select event_id, ts, user_id, cast(null as varchar) as event_type, "
              "cast(null as double) as value, cast(null as varchar) as props "
              "from events where event_type = 'error'")


@register("make_tombstones", TOMBSTONES)
def q_make_tombstones(spark, d):
    return I.event_deletes(spark, d)


@register("tombstones_since", f"select * from ({TOMBSTONES}) where ts > timestamp '{SINCE_TS}'")
def q_tombstones_since(spark, d):
    return C.tombstones_since(I.event_deletes(spark, d), EK, ES, since=SINCE_TS)


@register("delete_feed", TOMBSTONES)
def q_delete_feed(spark, d):
    from keelson.streaming.flows import delete_feed_run
    return delete_feed_run(spark, d)


@register("duplicate_keys",
          "select user_id, count(*) as n from events group by user_id having count(*) > 1")
def q_duplicate_keys(spark, d):
    return C.duplicate_keys(I.events(spark, d), EK)


@register("touch_upsert", f"""
with {V1}, {V2}, r as (select * from v2 where o_orderstatus = 'O' or o_orderpriority = '1-URGENT')
select * from v1 where o_orderkey not in (select o_orderkey from r)
union all
select r.o_orderkey, r.o_custkey, r.o_orderstatus, r.o_totalprice,
       case when v1.o_orderkey is not null then timestamp '{STAMP}'
            else coalesce(r.o_orderdate, timestamp '{STAMP}') end as o_orderdate,
       r.o_orderpriority
from r left join v1 on r.o_orderkey = v1.o_orderkey""")
def q_touch_upsert(spark, d):
    rows = I.orders_v2(spark, d).where(
        (F.col("o_orderstatus") == "O") | (F.col("o_orderpriority") == "1-URGENT"))
    older = rows.withColumn("o_totalprice", F.col("o_totalprice") - 1)  # every key twice, one row of it wins
    return C.touch_upsert(I.orders_v1(spark, d), older.unionByName(rows), I.ORDER_KEYS, "o_orderdate", STAMP, tie="o_totalprice")


# ---------------------------------------------------------------- cursors, pages, caps
@register("after_cursor",
          f"select * from orders where o_orderdate is null or o_orderdate > timestamp '{ORDER_CURSOR}'")
def q_after_cursor(spark, d):
    return R.after_cursor(I.table(spark, d, "orders"), "o_orderdate", ORDER_CURSOR)


@register("cursor_range",
          f"select * from events where ts > timestamp '{SINCE_TS}' and ts <= timestamp '{UNTIL_TS}'")
def q_cursor_range(spark, d):
    return R.cursor_range(I.events(spark, d), ES, since=SINCE_TS, until=UNTIL_TS)


@register("match_filters",
          "select * from orders where o_orderstatus = 'O' and o_orderpriority = '2-HIGH'")
def q_match_filters(spark, d):
    return R.match_filters(I.table(spark, d, "orders"),
                           {"o_orderstatus": "O", "o_orderpriority": "2-HIGH"},
                           allowed=["o_custkey", "o_orderstatus", "o_orderpriority"])


@register("cutoff_at_start",
          f"select * from events where ts > timestamp '{SINCE_TS}' and ts <= timestamp '{UNTIL_TS}'")
def q_cutoff_at_start(spark, d):
    return R.cutoff_at_start(I.events(spark, d), ES, since=SINCE_TS, run_start=UNTIL_TS)


@register("lookback",
          f"select * from events where ts is null or ts > timestamp '{UNTIL_TS}' - interval 2 day")
def q_lookback(spark, d):
    return R.lookback(I.events(spark, d), ES, UNTIL_TS, "2 days")


@register("end_offset",
          f"select greatest(max(o_orderdate), timestamp '{ORDER_START}') as end_offset from orders")
def q_end_offset(spark, d):
    return R.end_offset(I.table(spark, d, "orders"), "o_orderdate", ORDER_START)


@register("order_by_cursor", "select * from orders order by o_orderdate nulls first, o_orderkey")
def q_order_by_cursor(spark, d):
    return R.order_by_cursor(I.table(spark, d, "orders"), "o_orderdate", I.ORDER_KEYS)


@register("limit_rows",
          "select * from orders order by o_orderdate nulls first, o_orderkey limit 250")
def q_limit_rows(spark, d):
    return R.limit_rows(I.table(spark, d, "orders"), "o_orderdate", I.ORDER_KEYS, 250, page_max=1000)


@register("page_slice",
          "select * from orders order by o_orderdate nulls first, o_orderkey limit 100 offset 200")
def q_page_slice(spark, d):
    return R.page_slice(I.table(spark, d, "orders"), "o_orderdate", I.ORDER_KEYS, 3, 100)


PAGED = ("(select *, row_number() over (order by o_orderdate nulls first, o_orderkey) as n, "
         "count(*) over () as total from orders)")


def _order_directory(spark, d):
    """Built over the orders up to a date, extended by the later ones."""
    from keelson.operators.directory import PageDirectory
    orders = I.table(spark, d, "orders")
    pages = PageDirectory(spark, work_dir(spark, "pages"), "o_orderdate", I.ORDER_KEYS, 100)
    pages.build(orders.where(F.col("o_orderdate").isNull() | (F.col("o_orderdate") <= F.lit(ORDER_START).cast("timestamp_ntz"))))
    pages.extend(orders)
    return pages


# Waves of arrival: the kinds of events come one after another, in the order of their names.
LATE = """
w as (select *, dense_rank() over (order by event_type) as wave from events where event_type is not null and ts is not null),
tops as (select wave, max(ts) as top from w group by wave),
hw as (select wave, max(top) over (order by wave rows between unbounded preceding and 1 preceding) as before from tops),
late as (select wave, epoch_us(before) - epoch_us(ts) as d from w join hw using (wave) where ts <= before),
classes as (select ((d >> s) + 1) << s as below, count(*) as n
            from (select d, greatest(length(bin(d)) - 7, 0) as s from late) group by below),
shares as (select below, n, sum(n) over (order by below) / sum(n) over () as share from classes)"""


def _waves(spark, d):
    """Log of lateness of the waves, and the waves."""
    from keelson.operators.lateness import LatenessLog, arrival_numbers
    ev = I.events(spark, d).where("event_type is not null and ts is not null")
    waves = checkpointed(arrival_numbers(ev, F.col("event_type")))
    log = LatenessLog(spark, work_dir(spark, "lateness"), ES)
    n = waves.agg(F.max("arrival")).first()[0] or 0
    for k in range(1, n + 1):
        log.add(waves.where(F.col("arrival") == k), k)
    return log, waves, n


@register("lateness_classes", f"with {LATE} select cast(below as bigint) as below, n from classes")
def q_lateness_classes(spark, d):
    return _waves(spark, d)[0].histogram().select("below", "n")


@register("measured_lookback", f"""
with {LATE}, reach as (select min(below) as reach from shares where share >= 0.9)
select cast(wave as int) as wave, cast(reach as bigint) as reach, count(*) as late_rows,
  count(*) filter (where d < reach) as reread_rows from late, reach group by wave, reach""")
def q_measured_lookback(spark, d):
    """The interval that reads 90% of late rows again, and the late rows that ``lookback`` finds with it."""
    from functools import reduce
    log, waves, n = _waves(spark, d)
    interval, found = log.interval(0.9), []
    for k in range(2, n + 1):
        newest = waves.where(F.col("arrival") < k).agg(F.max(ES).cast("string")).first()[0]
        late = waves.where((F.col("arrival") == k) & (F.col(ES) <= F.lit(newest).cast(waves.schema[ES].dataType)))
        again = R.lookback(late, ES, newest, interval).agg(F.count(F.lit(1)).alias("reread_rows")) if interval else None
        counts = late.agg(F.count(F.lit(1)).alias("late_rows"))
        found.append(counts.withColumns({"wave": F.lit(k), "reach": F.lit(log.reach(0.9)).cast("bigint"),
                                         "reread_rows": again.scalar() if again else F.lit(0).cast("bigint")}))
    none = spark.createDataFrame([], "late_rows bigint, wave int, reach bigint, reread_rows bigint")
    return reduce(DataFrame.unionByName, found, none).where("late_rows > 0")


@register("page_directory", f"""
select cast((n - 1) // 100 + 1 as bigint) as page, o_orderdate, o_orderkey, least(100, total - n + 1) as n_rows
from {PAGED} where (n - 1) % 100 = 0""")
def q_page_directory(spark, d):
    return _order_directory(spark, d).entries().drop("skip")


@register("directory_page", f"select * exclude (n, total) from {PAGED} where (n - 1) // 100 = total // 200")
def q_directory_page(spark, d):
    """The page in the middle of the table."""
    orders = I.table(spark, d, "orders")
    return _order_directory(spark, d).page(orders, orders.count() // 200 + 1)


@register("next_page", "select case when count(*) > 300 then 4 end as next_page from orders")
def q_next_page(spark, d):
    return R.next_page(I.table(spark, d, "orders"), 3, 100)


@register("batch_cap", """
select * from orders where o_orderdate is null or o_orderdate <= (
  select max(o_orderdate) from
  (select o_orderdate from orders order by o_orderdate nulls first limit 1003))""")
def q_batch_cap(spark, d):
    return R.batch_cap(I.table(spark, d, "orders"), "o_orderdate", 1003)


# ---------------------------------------------------------------- snapshots
DIFF = f"""
with {V1}, {V2}
select coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey,
  case when o.o_orderkey is null then 'insert' when n.o_orderkey is null then 'delete'
       when o.o_custkey is not distinct from n.o_custkey
        and o.o_orderstatus is not distinct from n.o_orderstatus
        and o.o_totalprice is not distinct from n.o_totalprice
        and o.o_orderdate is not distinct from n.o_orderdate
        and o.o_orderpriority is not distinct from n.o_orderpriority then 'same'
       else 'update' end as change
from v1 o full outer join v2 n on o.o_orderkey = n.o_orderkey"""


@register("snapshot_diff", DIFF)
def q_snapshot_diff(spark, d):
    return S.snapshot_diff(I.orders_v1(spark, d), I.orders_v2(spark, d), I.ORDER_KEYS) \
        .select("o_orderkey", "change")


@register("snapshot_checksum_diff", f"select * from ({DIFF}) where change <> 'same'")
def q_snapshot_checksum_diff(spark, d):
    """The keys that differ, found by bucket checksums before any row is joined."""
    from keelson.operators.checksums import checksum_changes
    return checksum_changes(I.orders_v1(spark, d), I.orders_v2(spark, d), I.ORDER_KEYS).select("o_orderkey", "change")


@register("snapshot_scd1", f"with {V2} select * from v2")
def q_snapshot_scd1(spark, d):
    return S.snapshot_scd1(I.orders_v1(spark, d), I.orders_v2(spark, d), I.ORDER_KEYS)


SNAP2 = f"""
with {V1}, {V2}, d as ({DIFF.replace(f'with {V1}, {V2}', '')})
select v1.*, cast(1 as bigint) as "__START_AT",
       case when d.change = 'same' then null else cast(2 as bigint) end as "__END_AT"
from v1 join d on v1.o_orderkey = d.o_orderkey
union all
select v2.*, cast(2 as bigint) as "__START_AT", cast(null as bigint) as "__END_AT"
from v2 join d on v2.o_orderkey = d.o_orderkey where d.change in ('insert', 'update')"""


@register("snapshot_scd2", SNAP2)
def q_snapshot_scd2(spark, d):
    hist = S.snapshot_scd2(None, I.orders_v1(spark, d), I.ORDER_KEYS, 1)
    return S.snapshot_scd2(hist, I.orders_v2(spark, d), I.ORDER_KEYS, 2)


# ---------------------------------------------------------------- joins
@register("expand_one", """
select o.o_orderkey, o.o_custkey, c.c_name, c.c_acctbal
from orders o left join customer c on o.o_custkey = c.c_custkey""")
def q_expand_one(spark, d):
    out = X.expand_one(I.table(spark, d, "orders"), I.table(spark, d, "customer"),
                       "o_custkey", "c_custkey", "customer")
    return out.select("o_orderkey", "o_custkey", "customer.c_name", "customer.c_acctbal")


@register("expand_nested", """
select o.o_orderkey, c.c_name, n.n_name, r.r_name
from orders o left join customer c on o.o_custkey = c.c_custkey
left join nation n on c.c_nationkey = n.n_nationkey
left join region r on n.n_regionkey = r.r_regionkey""")
def q_expand_nested(spark, d):
    t = lambda n: I.table(spark, d, n)
    out = X.expand_nested(t("orders"), [
        (t("customer"), "o_custkey", "c_custkey", "customer"),
        (t("nation"), "c_nationkey", "n_nationkey", "nation"),
        (t("region"), "n_regionkey", "r_regionkey", "region"),
    ])
    return out.select("o_orderkey", "customer.c_name", "customer.nation.n_name",
                      "customer.nation.region.r_name")


# ---------------------------------------------------------------- profile
@register("table_profile", """
select 'events' as table_name, 'user_id' as primary_keys, 'ts' as cursor_field,
  'cdc_with_deletes' as ingestion_type, count(*) as row_count, count(distinct user_id) as distinct_keys,
  cast(sum(case when user_id is null then 1 else 0 end) as bigint) as null_keys,
  cast(min(ts) as varchar) as min_cursor, cast(max(ts) as varchar) as max_cursor from events
union all
select 'orders', 'o_orderkey', 'o_orderdate', 'snapshot', count(*), count(distinct o_orderkey),
  cast(sum(case when o_orderkey is null then 1 else 0 end) as bigint),
  cast(min(o_orderdate) as varchar), cast(max(o_orderdate) as varchar) from orders
union all
select 'customer', 'c_custkey', null, 'snapshot', count(*), count(distinct c_custkey),
  cast(sum(case when c_custkey is null then 1 else 0 end) as bigint), null, null from customer""")
def q_table_profile(spark, d):
    t = lambda n: I.table(spark, d, n)
    profile = table_profile({
        "events": (t("events"), {"primary_keys": ["user_id"], "cursor_field": "ts",
                                 "ingestion_type": "cdc_with_deletes"}),
        "orders": (t("orders"), {"primary_keys": ["o_orderkey"], "cursor_field": "o_orderdate",
                                 "ingestion_type": "snapshot"}),
        "customer": (t("customer"), {"primary_keys": ["c_custkey"], "ingestion_type": "snapshot"}),
    })
    return profile.withColumn("primary_keys", F.array_join("primary_keys", ","))


@register("profile_log", """
select count(*) as row_count, cast(sum(case when user_id is null then 1 else 0 end) as bigint) as null_keys,
  min(ts) as min_cursor, max(ts) as max_cursor, count(value) as value_n, true as distinct_within, true as quantiles_within
from events""")
def q_profile_log(spark, d):
    """Four batches, each summed up once; the merged profile, and whether its estimates are within
    the stated errors of exact figures."""
    from functools import reduce
    from keelson.operators.sketches import QUANTILES, ProfileLog
    ev = I.events(spark, d)
    log = ProfileLog(spark, work_dir(spark, "profile-log"), EK, ES, ["value"])
    parts = I.arrival_batch(ev, ES, 4)
    for b in range(4):
        log.add(parts.where(F.col("__batch") == b).drop("__batch"), b)
    profile = checkpointed(log.profile())
    found = profile.first()
    v = F.col("value")
    marks = list(zip(QUANTILES, found["value_quantiles"] or []))
    ranks = [(F.avg((v < x).cast("double")) <= q + 0.03) & (F.avg((v <= x).cast("double")) >= q - 0.03) for q, x in marks]
    exact = F.count_distinct(*EK)
    within = ev.agg((F.abs(exact - F.lit(found["distinct_keys"])) <= 0.04 * exact).alias("distinct_within"),
                    reduce(lambda a, b: a & b, ranks, F.lit(True)).alias("quantiles_within"))
    return profile.drop("distinct_keys", "value_quantiles").withColumns(
        {c: within.select(c).scalar() for c in within.columns})


# ---------------------------------------------------------------- stamps
@register("typed_stamp", f"""
select o_orderkey, timestamp '{STAMP}' as o_orderdate, date '{STAMP.date()}' as stamp_date,
  '{STAMP.isoformat()}+00:00' as stamp_text from orders""")
def q_typed_stamp(spark, d):
    from pyspark.sql import types as T
    from keelson.functions.stamps import typed_stamp
    o = I.table(spark, d, "orders")
    return o.select("o_orderkey",
                    typed_stamp(o.schema["o_orderdate"].dataType, STAMP).alias("o_orderdate"),
                    typed_stamp(T.DateType(), STAMP).alias("stamp_date"),
                    typed_stamp(T.StringType(), STAMP).alias("stamp_text"))


# ---------------------------------------------------------------- coercion
from pyspark.sql import types as T  # noqa: E402

from keelson.functions.coerce import coerce_json  # noqa: E402


def _one_field(df: DataFrame, text, dtype: T.DataType, keep: list[str], mode: str = "strict"):
    """Wrap a JSON value text as ``{"x": value}`` and coerce field ``x`` to ``dtype``."""
    rec = F.concat(F.lit('{"x":'), text, F.lit("}"))
    staged = df.select(*keep, rec.alias("__j"))
    return coerce_json(staged, "__j", T.StructType([T.StructField("x", dtype)]), mode=mode, keep=keep)


def _jstr(c):
    return F.to_json(F.struct(c.alias("s"))).substr(F.lit(6), F.length(F.to_json(F.struct(c.alias("s")))) - 6)


@register("coerce_record", "select * from lineitem")
def q_coerce_record(spark, d):
    """lineitem as JSON text, typed back. The one given file is a single task; its rows are
    spread first, as a landing zone of many files would be."""
    li = I.table(spark, d, "lineitem")
    text = li.repartition(spark.sparkContext.defaultParallelism).select(F.to_json(F.struct(*li.columns)).alias("j"))
    return coerce_json(text, "j", li.schema)


@register("coerce_integer", """
select l_orderkey, l_linenumber,
  case l_linenumber % 4 when 0 then cast(trunc(l_quantity) as bigint)
                        when 1 then cast(l_quantity as bigint)
                        when 2 then -cast(trunc(l_quantity) as bigint)
                        else cast(1 as bigint) end as x
from lineitem""")
def q_coerce_integer(spark, d):
    li = I.table(spark, d, "lineitem")
    q = F.col("l_quantity")
    text = (F.when(F.col("l_linenumber") % 4 == 0, _jstr(q.cast("string")))           # "23.0"
            .when(F.col("l_linenumber") % 4 == 1, _jstr(F.concat(F.lit(" "), q.cast("bigint").cast("string"), F.lit(" "))))
            .when(F.col("l_linenumber") % 4 == 2, (-(q + 0.5)).cast("string"))         # -23.5 → -23
            .otherwise(F.lit("true")))
    return _one_field(li, text, T.LongType(), ["l_orderkey", "l_linenumber"])


@register("coerce_double", "select l_orderkey, l_linenumber, l_extendedprice as x from lineitem")
def q_coerce_double(spark, d):
    li = I.table(spark, d, "lineitem")
    p = F.col("l_extendedprice")
    text = (F.when(F.col("l_linenumber") % 3 == 0, _jstr(p.cast("string")))
            .when(F.col("l_linenumber") % 3 == 1,
                  _jstr(F.concat(F.lit(" "), F.round(p * 100).cast("bigint").cast("string"), F.lit("e-2 "))))
            .otherwise(p.cast("string")))
    return _one_field(li, text, T.DoubleType(), ["l_orderkey", "l_linenumber"])


@register("coerce_decimal",
          "select l_orderkey, l_linenumber, cast(l_extendedprice as decimal(12,2)) as x from lineitem")
def q_coerce_decimal(spark, d):
    li = I.table(spark, d, "lineitem")
    p = F.col("l_extendedprice")
    text = F.when(F.col("l_linenumber") % 2 == 0, _jstr(p.cast("string"))).otherwise(p.cast("string"))
    return _one_field(li, text, T.DecimalType(12, 2), ["l_orderkey", "l_linenumber"])


@register("coerce_boolean", """
select l_orderkey, l_linenumber,
  case l_linenumber % 3 when 0 then l_returnflag <> 'N'
                        when 1 then l_linestatus = 'O'
                        else l_tax <> 0 end as x
from lineitem""")
def q_coerce_boolean(spark, d):
    li = I.table(spark, d, "lineitem")
    text = (F.when(F.col("l_linenumber") % 3 == 0, _jstr(F.col("l_returnflag")))
            .when(F.col("l_linenumber") % 3 == 1,
                  _jstr(F.when(F.col("l_linestatus") == "O", F.lit("Yes")).otherwise(F.lit("no"))))
            .otherwise(F.col("l_tax").cast("string")))
    return _one_field(li, text, T.BooleanType(), ["l_orderkey", "l_linenumber"])


@register("coerce_date",
          "select l_orderkey, l_linenumber, cast(l_shipdate as date) as x from lineitem")
def q_coerce_date(spark, d):
    li = I.table(spark, d, "lineitem")
    s = F.col("l_shipdate")
    fmt = ["yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyy/MM/dd", "yyyy-MM-dd'T'HH:mm:ss'-05:00'"]
    text = F.lit(None).cast("string")
    for i, f in enumerate(fmt):
        text = F.when(F.col("l_linenumber") % len(fmt) == i, F.date_format(s, f)).otherwise(text)
    return _one_field(li, _jstr(text), T.DateType(), ["l_orderkey", "l_linenumber"])


@register("coerce_timestamp", "select l_orderkey, l_linenumber, l_shipdate as x from lineitem")
def q_coerce_timestamp(spark, d):
    li = I.table(spark, d, "lineitem")
    s = F.col("l_shipdate")
    n = F.col("l_linenumber") % 4
    text = (F.when(n == 0, _jstr(F.date_format(s, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
            .when(n == 1, _jstr(F.date_format(s, "yyyy/MM/dd HH:mm:ss")))
            .when(n == 2, F.unix_seconds(s.cast("timestamp")).cast("string"))
            .otherwise(_jstr(F.date_format(s, "yyyy-MM-dd HH:mm:ss"))))
    return _one_field(li, text, T.TimestampNTZType(), ["l_orderkey", "l_linenumber"])


@register("coerce_binary", """
select c_custkey,
  case c_custkey % 4
    when 0 then hex(c_name)
    when 1 then case when length(hex(c_name)) % 4 = 0 then hex(from_base64(hex(c_name))) else hex(c_name) end
    when 2 then hex(c_name)
    else printf('%02X%02X', c_nationkey, c_nationkey + 1) end as x
from customer""")
def q_coerce_binary(spark, d):
    c = I.table(spark, d, "customer")
    n = F.col("c_custkey") % 4
    name = F.col("c_name")
    text = (F.when(n == 0, _jstr(F.base64(F.encode(name, "UTF-8"))))
            .when(n == 1, _jstr(F.hex(name)))
            .when(n == 2, _jstr(name))
            .otherwise(F.concat(F.lit("["), F.col("c_nationkey").cast("string"), F.lit(","),
                                (F.col("c_nationkey") + 1).cast("string"), F.lit("]"))))
    out = _one_field(c, text, T.BinaryType(), ["c_custkey"])
    return out.select("c_custkey", F.hex("x").alias("x"))


@register("coerce_array", """
select l_orderkey, l_linenumber, cast(generate_subscripts(arr, 1) - 1 as integer) as pos,
       unnest(arr) as x
from (select l_orderkey, l_linenumber,
        case when l_linenumber % 2 = 0 then [l_quantity, l_tax] else [l_discount] end as arr
      from lineitem)""")
def q_coerce_array(spark, d):
    li = I.table(spark, d, "lineitem")
    text = F.when(F.col("l_linenumber") % 2 == 0,
                  F.to_json(F.array(F.col("l_quantity"), F.col("l_tax")))) \
        .otherwise(F.col("l_discount").cast("string"))
    out = _one_field(li, text, T.ArrayType(T.DoubleType(), True), ["l_orderkey", "l_linenumber"])
    # _outer + filter on the generator output: a plain explode would let Catalyst infer a
    # size(x) > 0 filter and push it (with the whole coercion tree) down to the scan
    return (out.select("l_orderkey", "l_linenumber", F.posexplode_outer("x").alias("pos", "x"))
            .where(F.col("pos").isNotNull()))


@register("coerce_map", """
select event_id, k as key, cast(json_extract(props, '$.' || k) as integer) as value
from events, unnest(json_keys(props)) t(k)""")
def q_coerce_map(spark, d):
    ev = I.events(spark, d)
    out = _one_field(ev, F.col("props"), T.MapType(T.StringType(), T.IntegerType()), ["event_id"])
    return (out.select("event_id", F.explode_outer("x").alias("key", "value"))
            .where(F.col("key").isNotNull()))


@register("coerce_struct", """
select event_id, cast(json_extract(props, '$.k') as integer) as k,
  cast(null as varchar) as missing, event_type as kind from events""")
def q_coerce_struct(spark, d):
    ev = I.events(spark, d)
    rec = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"props":'), F.col("props"),
                   F.lit(',"kind":'), F.coalesce(_jstr(F.col("event_type")), F.lit("null")),
                   F.lit(',"extra":1}'))
    schema = T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("props", T.StructType([T.StructField("k", T.IntegerType()),
                                             T.StructField("missing", T.StringType())])),
        T.StructField("kind", T.StringType())])
    out = coerce_json(ev.select(rec.alias("j")), "j", schema)
    return out.select(F.col("id").alias("event_id"), "props.k", "props.missing", F.col("kind"))


@register("coerce_string", "select event_id, cast(json(props) as varchar) as x from events")
def q_coerce_string(spark, d):
    ev = I.events(spark, d)
    return _one_field(ev, F.col("props"), T.StringType(), ["event_id"])


@register("coerce_variant",
          "select event_id, cast(json_extract(props, '$.k') as integer) as k from events")
def q_coerce_variant(spark, d):
    ev = I.events(spark, d)
    out = _one_field(ev, _jstr(F.col("props")), T.VariantType(), ["event_id"])
    return out.select("event_id", F.variant_get("x", "$.k", "int").alias("k"))


@register("coerce_errors", """
select o_orderkey, cast(substr(o_orderpriority, 1, 1) as bigint) as prio,
  cast(null as bigint) as raw, 1 as n_errors from orders""")
def q_coerce_errors(spark, d):
    o = I.table(spark, d, "orders")
    rec = F.concat(F.lit('{"prio":'), _jstr(F.substring("o_orderpriority", 1, 1)),
                   F.lit(',"raw":'), _jstr(F.col("o_orderpriority")), F.lit("}"))
    schema = T.StructType([T.StructField("prio", T.LongType()), T.StructField("raw", T.LongType())])
    out = coerce_json(o.select("o_orderkey", rec.alias("j")), "j", schema, mode="permissive",
                      keep=["o_orderkey"])
    return out.select("o_orderkey", "prio", "raw", F.size("_errors").alias("n_errors"))


@register("nested_as_text", """
select o_orderkey, '{"id":' || o_custkey || ',"status":"' || o_orderstatus || '"}' as user_text
from orders""")
def q_nested_as_text(spark, d):
    from keelson.operators.schema import nested_as_text
    o = I.table(spark, d, "orders")
    rec = F.to_json(F.struct(F.col("o_orderkey").alias("id"),
                             F.struct(F.col("o_orderstatus").alias("status"),
                                      F.col("o_custkey").alias("id")).alias("user")))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("user", T.StringType())])
    out = nested_as_text(o.select(rec.alias("j")), "j", schema)
    return out.select(F.col("id").alias("o_orderkey"), F.col("user").alias("user_text"))


# ---------------------------------------------------------------- schema inference
def _ddl_sql(table: str, col: str) -> str:
    """DuckDB: top-level keys of a JSON text column with their scalar types as Spark DDL."""
    return f"""
select case when count(*) = 0 then null
            else 'STRUCT<' || string_agg(k || ': ' || t, ', ' order by k) || '>' end as ddl
from (select k, case when count(distinct jt) > 1 then 'VARIANT'
                     else max(case jt when 'BIGINT' then 'BIGINT' when 'UBIGINT' then 'BIGINT'
                                      when 'DOUBLE' then 'DOUBLE' when 'VARCHAR' then 'STRING'
                                      when 'BOOLEAN' then 'BOOLEAN' when 'NULL' then 'STRING'
                                      else 'VARIANT' end) end as t
      from (select k, json_type({col}, '$."' || k || '"') as jt
            from {table}, unnest(json_keys({col})) u(k) where json_valid({col})) x
      group by k) y"""


@register("infer_schema", _ddl_sql("events", "props"))
def q_infer_schema(spark, d):
    from keelson.operators.schema import infer_schema
    return infer_schema(I.events(spark, d), "props")


@register("schema_log", _ddl_sql("events", "props"))
def q_schema_log(spark, d):
    """Four batches, each read once; the merged summaries give the schema of the whole."""
    from keelson.operators.schema_log import SchemaLog
    log = SchemaLog(spark, work_dir(spark, "schema-log"), "props")
    ev = I.arrival_batch(I.events(spark, d), ES, 4)
    for b in range(4):
        log.add(ev.where(F.col("__batch") == b), b)
    return log.as_frame()


@register("schema_fallback", f"""
select coalesce(ddl, '{{FALLBACK}}') as ddl, ddl is null as fallback, 'events.props' as source
from ({_ddl_sql("events", "props")}) a
union all
select coalesce(ddl, '{{FALLBACK}}'), ddl is null, 'conversations.text'
from ({_ddl_sql("(select text from conversations where json_valid(text) and json_type(text) = 'OBJECT')", "text")}) b
""".replace("{FALLBACK}", "STRUCT<id: STRING, created_at: STRING, updated_at: STRING>"))
def q_schema_fallback(spark, d):
    from keelson.operators.schema import schema_or_fallback
    ev = schema_or_fallback(I.events(spark, d), "props").withColumn("source", F.lit("events.props"))
    cv = schema_or_fallback(I.table(spark, d, "conversations"), "text") \
        .withColumn("source", F.lit("conversations.text"))
    return ev.unionByName(cv)


@register("schema_drift", """
select k as field, count(*) as records, 'declared' as status
from events, unnest(json_keys(props)) t(k) group by k
union all select 'j', 0, 'missing'""")
def q_schema_drift(spark, d):
    from keelson.operators.schema import schema_drift
    declared = T.StructType([T.StructField("k", T.LongType()), T.StructField("j", T.StringType())])
    return schema_drift(I.events(spark, d), "props", declared)


# ---------------------------------------------------------------- pages
from keelson.sources import pages as P  # noqa: E402


def _customer_schema(spark, d):
    return I.table(spark, d, "customer").schema


@register("unnest_results", "select * from customer")
def q_unnest_results(spark, d):
    pages = I.customer_pages(spark, d, shape="results")
    return P.unnest_results(pages, _customer_schema(spark, d))


@register("unnest_list", "select * from customer")
def q_unnest_list(spark, d):
    pages = I.customer_pages(spark, d, shape="mixed")
    return P.unnest_list(pages, _customer_schema(spark, d))


@register("page_chain", f"""
with p as (select distinct c_custkey // 100 as page from customer),
m as (select max(page) as last from p)
select 'customers' as table_name, 'run-1' as run_id, page,
  case when page = 0 then '{I.API_BASE}/customers'
       else '{I.API_BASE}/customers?cursor=' || page end as request_abs,
  case when page < last then '{I.API_BASE}/customers?cursor=' || (page + 1) end as next_abs,
  case when page < last then 'ok' else 'end' end as status
from p, m""")
def q_page_chain(spark, d):
    pages = I.customer_pages(spark, d, shape="results")
    return P.page_chain(pages, I.API_BASE)


LINK_CHAINS = f"""
with recursive p as (select distinct c_custkey // 100 as page from customer),
l as (select page, max(page) over () as last, '{I.API_BASE}/customers' || case when page = 0 then '' else '?cursor=' || page end as req,
        case when page < max(page) over () then '{I.API_BASE}/customers?cursor=' || (page + 1) end as nxt from p),
g as (select 'run-1' as run_id, req, nxt from l
      union all select 'run-2', req, coalesce(nxt, '{I.API_BASE}/customers?cursor=3') from l
      union all select 'run-3', req, case when page % 5 <> 4 then nxt end from l
      union all select 'run-4', req, nxt from l where page % 3 <> 2),
w(run_id, req, spot, n) as (select run_id, req, req, 0 from g
      union all select w.run_id, w.req, b.req, w.n + 1 from w join g a on a.run_id = w.run_id and a.req = w.spot
                join g b on b.run_id = a.run_id and b.req = a.nxt where w.n <= (select count(*) from p)),
f as (select run_id, req, max(n) as n, max_by(spot, n) as spot, max(n) > (select count(*) from p) as endless,
        bool_or(n > 0 and spot = req) as ring from w group by run_id, req)
select 'customers' as table_name, g.run_id, g.req as request_abs, g.nxt as next_abs, cast(1 as bigint) as landed,
  (select count(*) from g b where b.run_id = g.run_id and b.nxt = g.req) as n_before,
  case when not endless then spot end as tail, cast(case when not endless then n end as bigint) as ahead,
  cast(case when not endless then max(n) over (partition by g.run_id, endless, spot) - n end as bigint) as position,
  case when ring then 'cycle' when endless then 'to_cycle' when g.nxt is null then 'end' when n = 0 then 'unread' else 'ok' end as status
from g join f on g.run_id = f.run_id and g.req = f.req"""


@register("link_chains", LINK_CHAINS)
def q_link_chains(spark, d):
    return P.link_chains(I.customer_links(spark, d), I.API_BASE)


@register("stop_at_short_page", "select * from customer")
def q_stop_at_short_page(spark, d):
    pages = I.customer_offset_pages(spark, d)
    kept = P.stop_at_short_page(pages, I.PAGE_SIZE)
    return P.unnest_list(kept, _customer_schema(spark, d))


@register("derived_table", "select conv_id, turn, role, text from conversations")
def q_derived_table(spark, d):
    parents = I.conversation_parents(spark, d)
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    return P.derived_table(parents, "messages", "id", "conv_id", schema)


@register("nested_array_rows", f"""
select conv_id, turn // {I.CHUNK} as chunk,
  cast(row_number() over (partition by conv_id, turn // {I.CHUNK} order by turn) - 1 as integer) as pos,
  turn, role, text from conversations""")
def q_nested_array_rows(spark, d):
    return P.nested_array_rows(I.conversation_nested(spark, d), "messages", keep=["conv_id", "chunk"])


# ---------------------------------------------------------------- streams, sinks, sources
from keelson.streaming import flows as FL  # noqa: E402

SCD1_DELETES = f"select * from ({LATEST}) where event_type <> 'error'"


@register("snapshot_scan", "select * from orders")
def q_snapshot_scan(spark, d):
    schema = I.table(spark, d, "orders").schema
    return FL.snapshot_scan(spark, f"{d.rstrip('/')}/orders.parquet", schema)


@register("incremental_stream", "select * from events")
def q_incremental_stream(spark, d):
    """The events stream, several micro-batches in two runs, each in pieces of about 1000 rows by cursor."""
    return FL.capped_run(spark, d).drop("batch", "piece")


@register("append_sink", "select * from orders")
def q_append_sink(spark, d):
    return FL.append_run(spark, d, "orders")


@register("stream_resume", "select * from events")
def q_stream_resume(spark, d):
    return FL.resume_run(spark, d)


@register("stream_replay", LATEST)
def q_stream_replay(spark, d):
    return FL.stream_replay(spark, d)


@register("stream_scd1", LATEST)
def q_stream_scd1(spark, d):
    return FL.stream_scd(spark, d, "scd1")


@register("stream_scd2", HISTORY)
def q_stream_scd2(spark, d):
    return FL.stream_scd(spark, d, "scd2")


@register("stream_deletes", SCD1_DELETES)
def q_stream_deletes(spark, d):
    return FL.stream_deletes(spark, d)


@register("stream_state", SCD1_DELETES)
def q_stream_state(spark, d):
    from keelson.streaming.state import stream_state_run
    return stream_state_run(spark, d)


@register("upsert_sink", LATEST)
def q_upsert_sink(spark, d):
    return FL.upsert_sink_run(spark, d)


@register("snapshot_sink", f"with {V2} select * from v2")
def q_snapshot_sink(spark, d):
    return FL.snapshot_sink_run(spark, d)


@register("partitioned_scan", "select * from events")
def q_partitioned_scan(spark, d):
    """The whole table, read as eight slices of its cursor."""
    return FL.sliced_scan(spark, f"{d.rstrip('/')}/events.parquet", ES, 8)


@register("partitioned_stream", f"select * from events where ts > '{SINCE_TS}' and ts <= '{UNTIL_TS}'")
def q_partitioned_stream(spark, d):
    base = work_dir(spark, "pstream")
    stream = FL.partitioned_stream(spark, d, "events", ES, SINCE_TS, UNTIL_TS, files_per_batch=2)
    FL.run_available(stream, f"{base}/chk", sink=f"{base}/out")
    return spark.read.parquet(f"{base}/out")


# ---------------------------------------------------------------- multi-table ingest
def _connector(spark, d):
    from keelson.plans.ingest import ParquetTables
    return ParquetTables(spark, d, {
        "events": {"primary_keys": ["user_id"], "cursor_field": "ts", "tie": "event_id",
                   "ingestion_type": "cdc_with_deletes", "delete_when": "event_type = 'error'"},
        "orders": {"primary_keys": ["o_orderkey"], "cursor_field": "o_orderdate",
                   "ingestion_type": "snapshot"},
        "customer": {"primary_keys": ["c_custkey"], "ingestion_type": "cdc",
                     "cursor_field": "c_custkey"},
        "lineitem": {"ingestion_type": "append"},
    })


class _TwoSnapshots:
    """The given tables, with ``orders`` as snapshot v1 and, from the second run on, v2."""

    def __init__(self, spark, d):
        self.inner, self.runs, self.snapshots = _connector(spark, d), 0, [I.orders_v1(spark, d), I.orders_v2(spark, d)]
        self.metadata, self.read_stream, self.has_deletes = self.inner.metadata, self.inner.read_stream, self.inner.has_deletes

    def read(self, table, options):
        return self.snapshots[self.runs]


INGESTED = f"""
with {V2},
ev as ({SCD1_DELETES})
select 'events' as destination, cast(user_id as bigint) as k, cast(event_id as bigint) as n, value as x from ev
union all select '`main`.`sales`.`orders_snap`', o_orderkey, o_custkey, o_totalprice from v2
union all select 'customer', c_custkey, c_nationkey, c_acctbal from customer
union all select 'lineitem', l_orderkey, l_linenumber, l_extendedprice from lineitem"""


@register("ingest_multi", INGESTED)
def q_ingest_multi(spark, d):
    """Four tables, one per ingestion type, ingested twice; the second run sees a new snapshot
    of ``orders`` and nothing new elsewhere. All rows of all destinations."""
    from functools import reduce
    from keelson.plans.ingest import ingest, read_destination
    spec = {"connection_name": "parquet-tables", "objects": [
        {"table": {"source_table": "events", "table_configuration": {"tie": "event_id"}}},
        {"table": {"source_table": "orders", "destination_catalog": "main",
                   "destination_schema": "sales", "destination_table": "orders_snap"}},
        {"table": {"source_table": "customer"}},
        {"table": {"source_table": "lineitem"}},
    ]}
    cols = {"events": ("user_id", "event_id", "value"),
            "`main`.`sales`.`orders_snap`": ("o_orderkey", "o_custkey", "o_totalprice"),
            "customer": ("c_custkey", "c_nationkey", "c_acctbal"),
            "lineitem": ("l_orderkey", "l_linenumber", "l_extendedprice")}
    conn, root = _TwoSnapshots(spark, d), work_dir(spark, "ingest")
    for conn.runs in (0, 1):
        plans = ingest(spark, spec, conn, root)
    parts = [read_destination(spark, p).select(F.lit(name).alias("destination"), F.col(cols[name][0]).cast("bigint").alias("k"),
                                               F.col(cols[name][1]).cast("bigint").alias("n"), F.col(cols[name][2]).alias("x"))
             for name, p in plans.items()]
    return reduce(DataFrame.unionByName, parts)


@register("ingest_override", LATEST)
def q_ingest_override(spark, d):
    """Spec values beat source metadata: key, sequence and SCD type come from the spec."""
    from keelson.plans.ingest import ParquetTables, ingest, read_destination
    conn = ParquetTables(spark, d, {"events": {"primary_keys": ["event_id"], "cursor_field": "event_id",
                                               "ingestion_type": "cdc"}})
    spec = {"objects": [{"table": {"source_table": "events", "destination_table": "latest_by_user",
                                   "table_configuration": {"scd_type": "scd_type_1",
                                                           "primary_keys": '["user_id"]',
                                                           "sequence_by": "ts", "tie": "event_id"}}}]}
    plans = ingest(spark, spec, conn, work_dir(spark, "ingest-override"))
    return read_destination(spark, plans["latest_by_user"])


class _FailingOnce:
    """The given tables; the first read of ``orders`` fails."""

    def __init__(self, spark, d):
        self.inner, self.reads = _connector(spark, d), 0
        self.metadata, self.read_stream, self.has_deletes = self.inner.metadata, self.inner.read_stream, self.inner.has_deletes

    def read(self, table, options):
        self.reads += 1
        if self.reads == 1:
            raise OSError(f"{table} can't be reached")
        return self.inner.read(table, options)


@register("ingest_restart", f"""
select 'events' as destination, 1 as attempt, 'done' as status, (select count(*) from ({SCD1_DELETES})) as n_rows
union all select 'orders', 1, 'failed', (select count(*) from orders)
union all select 'orders', 2, 'done', (select count(*) from orders)
union all select 'customer', 1, 'done', (select count(*) from customer)
union all select 'lineitem', 1, 'done', (select count(*) from lineitem)""")
def q_ingest_restart(spark, d):
    """One of four tables fails; the same run again does that one only. The ledger of the run,
    with the rows of each destination after it."""
    from functools import reduce
    from keelson.plans.ingest import IngestFailed, RunLedger, ingest, read_destination
    spec = {"objects": [{"table": {"source_table": "events", "table_configuration": {"tie": "event_id"}}},
                        *[{"table": {"source_table": t}} for t in ("orders", "customer", "lineitem")]]}
    conn, root = _FailingOnce(spark, d), work_dir(spark, "ingest-restart")
    try:
        ingest(spark, spec, conn, root, run="r1")
    except IngestFailed:
        pass
    plans = ingest(spark, spec, conn, root, run="r1")
    sizes = reduce(DataFrame.unionByName, [read_destination(spark, p).agg(F.count(F.lit(1)).alias("n_rows"))
                                           .withColumn("destination", F.lit(name)) for name, p in plans.items()])
    return RunLedger(spark, f"{root}/_runs").rows().join(sizes, "destination").select("destination", "attempt", "status", "n_rows")


@register("error_budget", """
select cast(event_id as bigint) as event_id, case when bad then null else cast(user_id as bigint) end as code,
  bad as rejected, cast(bad as int) as n_reasons
from (select *, coalesce(event_type = 'error', false) as bad from events)""")
def q_error_budget(spark, d):
    """A typed stream in which some records have no number for ``code``: accepted and rejected rows
    of the run, whose budget allows for them."""
    from keelson.functions.coerce import coerce_json
    from keelson.streaming.intake import REASONS, REJECTED, Intake
    base = work_dir(spark, "error-budget")
    code = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("user_id").cast("string"))
    raw = FL.table_stream(spark, d, "events", files_per_batch=2).select(F.to_json(F.struct("event_id", code.alias("code"))).alias("j"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("code", T.LongType())])
    intake = Intake(f"{base}/intake", budget=0.5)
    FL.run_available(coerce_json(raw, "j", schema, mode="permissive"), f"{base}/chk", batch_fn=intake)
    return intake.rows(spark).select("event_id", "code", F.col(REJECTED).alias("rejected"), F.size(REASONS).alias("n_reasons"))


@register("ingest_quarantine", f"""
with good as (select * from events where event_type is distinct from 'error')
select 'kept' as place, event_id, user_id from ({LATEST.replace("from events", "from good")})
union all select 'rejected', event_id, user_id from events where event_type = 'error'""")
def q_ingest_quarantine(spark, d):
    """Rows that a table's spec rejects go to its quarantine, the others to the table."""
    from keelson.plans.ingest import ParquetTables, ingest, read_destination, read_quarantine
    conn = ParquetTables(spark, d, {"events": {"primary_keys": EK, "cursor_field": ES, "ingestion_type": "cdc"}})
    spec = {"objects": [{"table": {"source_table": "events", "table_configuration": {
        "tie": ET, "error_budget": 0.5, "reject_when": {"error event": "event_type = 'error'"}}}}]}
    found = ingest(spark, spec, conn, work_dir(spark, "ingest-quarantine"))["events"]
    of = lambda place, rows: rows.select(F.lit(place).alias("place"), "event_id", "user_id")
    return of("kept", read_destination(spark, found)).unionByName(of("rejected", read_quarantine(spark, found)))
