"""Rows out of landed API page bodies.

Pages are landed as rows ``(table_name, run_id, page | page_offset, request_link,
next_link, body)``; a body is JSON text. Unnesting is ``try_parse_json`` → ``variant_get`` →
``explode``: every page is handled by whichever task holds it, and the rows of one page
never meet the rows of another. Chain checks (S9, S10) are per (table, run).

A body that is there but can't be parsed (cut off, too large for VARIANT) fails the job in
strict mode; in permissive mode it gives one row of nulls whose ``_errors`` says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.coerce import ERRORS, coerce_variant_column
from keelson.functions.stamps import absolute_link
from keelson.operators.joins import spread_join
from keelson.operators.ordering import next_in_key
from keelson.session import checkpointed

RUN_KEYS = ["table_name", "run_id"]
_VARIANTS = "array<variant>"


def _results(v: Column) -> Column:
    return F.try_variant_get(v, "$.results", _VARIANTS)


def _list(v: Column) -> Column:
    return F.coalesce(_results(v), F.try_variant_get(v, "$", _VARIANTS))


def _problem(body: Column, v: Column) -> Column:
    """A message for a body that is not JSON, else null."""
    return F.when(body.isNotNull() & v.isNull(), F.concat(F.lit("page body is not JSON: "), F.substring(body, 1, 80)))


def _elements(pages: DataFrame, elems, body: str, keep: list[str], mode: str) -> DataFrame:
    """``keep``, one row per element (``__e``), and ``__page`` with a bad page's problem."""
    staged = pages.select(*keep, F.col(body).alias("__b"), F.try_parse_json(F.col(body)).alias("__v"))
    staged = staged.select(*keep, _problem(F.col("__b"), F.col("__v")).alias("__page"), elems(F.col("__v")).alias("__a"))
    bad = F.col("__page").isNotNull()
    if mode == "strict":
        checked = F.when(bad, F.raise_error(F.col("__page")).cast(_VARIANTS)).otherwise(F.col("__a"))
    else:
        checked = F.when(bad, F.array(F.lit(None).cast("variant"))).otherwise(F.col("__a"))
    return staged.select(*keep, "__page", F.explode(checked).alias("__e"))


def _rows(rows: DataFrame, schema: T.StructType | None, keep: list[str], mode: str) -> DataFrame:
    problem = F.when(F.col("__page").isNotNull(), F.array("__page")).otherwise(F.array().cast("array<string>"))
    if schema is None:
        out = rows if mode == "strict" else rows.withColumn(ERRORS, problem)
        return out.drop("__page")
    out = coerce_variant_column(rows, "__e", schema, mode=mode, keep=[*keep, "__page"])
    if mode == "permissive":
        out = out.withColumn(ERRORS, F.concat(problem, ERRORS))
    return out.drop("__page")


def unnest_results(pages: DataFrame, schema: T.StructType | None = None, body: str = "body",
                   keep: list[str] | None = None, mode: str = "strict") -> DataFrame:
    """One row per element of ``body.results``; a page without the array gives no rows."""
    keep = list(keep or [])
    return _rows(_elements(pages, _results, body, keep, mode), schema, keep, mode)


def unnest_list(pages: DataFrame, schema: T.StructType | None = None, body: str = "body",
                keep: list[str] | None = None, mode: str = "strict") -> DataFrame:
    """Rows of a bare-list body, or of ``.results`` when the body is an object."""
    keep = list(keep or [])
    return _rows(_elements(pages, _list, body, keep, mode), schema, keep, mode)


def page_chain(pages: DataFrame, base: str, order: str = "page") -> DataFrame:
    """Check the cursor chain of landed pages, per (table, run).

    The chain goes on while ``next_link`` is non-empty; a link is absolute when it starts
    with ``http``, else ``base`` + link. Per page, ``status`` is:
    ``ok`` (the next landed page was requested with this page's next link), ``end`` (no
    next link and no later page), ``broken`` (next link differs from the next request),
    ``unread`` (a next link but no later page landed), ``after_end`` (a page landed after
    a page without next link), ``repeated`` (the request link occurs twice in the run).
    """
    nl = F.col("next_link")
    has_next = nl.isNotNull() & (nl != "")
    d = pages.withColumn("next_abs", F.when(has_next, absolute_link(base, nl)))
    d = d.withColumn("request_abs", absolute_link(base, F.col("request_link")))
    d = next_in_key(d, RUN_KEYS, [order, "request_abs"], out="__nx")
    rep = (d.groupBy(*RUN_KEYS, "request_abs").agg(F.count(F.lit(1)).alias("__times"))
           .where(F.col("__times") > 1))
    d = d.join(rep, [*RUN_KEYS, "request_abs"], "left")
    nxt = F.col("__nx").getField("request_abs")
    status = (F.when(F.col("__times").isNotNull(), F.lit("repeated"))
              .when(~has_next & nxt.isNull(), F.lit("end"))
              .when(~has_next, F.lit("after_end"))
              .when(nxt.isNull(), F.lit("unread"))
              .when(nxt == F.col("next_abs"), F.lit("ok"))
              .otherwise(F.lit("broken")))
    return d.select(*RUN_KEYS, order, "request_abs", "next_abs", status.alias("status"))


def link_chains(pages: DataFrame, base: str) -> DataFrame:
    """S9 from the links alone: the order of landed pages, per (table, run), without a page number.

    A page leads to the landed page that was requested with its next link. Every page follows
    its links by pointer doubling: each round, it takes over the pointer of the page it points
    at, so a chain of n pages is ranked in log2(n) rounds, each one join whatever the chain.

    Returns one row per request link: ``request_abs, next_abs``, ``landed`` (times the request
    occurs; the smallest next link counts), ``n_before`` (pages that lead here; 0 for a
    head, more than 1 where chains meet), ``tail`` (the last page of the chain), ``ahead`` (pages between
    this one and the tail, the tail included), ``position`` (from the farthest head of that tail, from 0)
    and ``status``: ``ok`` (the next page landed), ``end`` (no next link), ``unread`` (a next link,
    but no such page), ``cycle`` (on a cycle) or ``to_cycle`` (leads into one); the last two have no
    tail, ahead or position.
    """
    run = [*RUN_KEYS]
    link, nxt = F.col("request_link"), F.col("next_link")
    named = pages.select(*run, absolute_link(base, link).alias("request_abs"),
                         F.when(nxt.isNotNull() & (nxt != ""), absolute_link(base, nxt)).alias("next_abs"))
    nodes = checkpointed(named.groupBy(*run, "request_abs").agg(F.min("next_abs").alias("next_abs"), F.count(F.lit(1)).alias("landed")))
    before = (nodes.where("next_abs is not null").groupBy(*run, F.col("next_abs").alias("request_abs"))
              .agg(F.count(F.lit(1)).alias("n_before")))
    known = nodes.select(*run, F.col("request_abs").alias("next_abs"), F.lit(True).alias("there"))
    state = (nodes.join(known, [*run, "next_abs"], "left")
             .select(*run, "request_abs", F.when(F.col("there"), F.col("next_abs")).alias("to"))
             .withColumn("ahead", F.when(F.col("to").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("bigint"))
             .withColumn("tail", F.when(F.col("to").isNull(), F.col("request_abs"))))
    state = checkpointed(state)
    n = nodes.count()
    steps = 1
    while steps < 2 * n and state.where("to is not null").limit(1).count():
        there = state.select(*run, F.col("request_abs").alias("to"), F.col("to").alias("__to"), F.col("ahead").alias("__ahead"),
                             F.col("tail").alias("__tail"))
        moving = state.where("to is not null").join(there, [*run, "to"])
        moved = moving.select(*run, "request_abs", F.col("__to").alias("to"), (F.col("ahead") + F.col("__ahead")).alias("ahead"),
                              F.col("__tail").alias("tail"))
        state = checkpointed(state.where("to is null").unionByName(moved))
        steps *= 2
    # who still moves after at least as many steps as there are pages goes round: a cycle is the
    # image of its own pages
    on_cycle = state.where("to is not null").select(*run, F.col("to").alias("request_abs")).distinct().withColumn("__on", F.lit(True))
    longest = (state.where("tail is not null").groupBy(*run, "tail").agg(F.max("ahead").alias("__most")))
    out = (nodes.join(state, [*run, "request_abs"]).join(before, [*run, "request_abs"], "left")
           .join(on_cycle, [*run, "request_abs"], "left").join(longest, [*run, "tail"], "left"))
    status = (F.when(F.col("__on"), "cycle").when(F.col("to").isNotNull(), "to_cycle").when(F.col("next_abs").isNull(), "end")
              .when(F.col("ahead") == 0, "unread").otherwise("ok"))
    return out.select(*run, "request_abs", "next_abs", F.col("landed"), F.coalesce("n_before", F.lit(0)).alias("n_before"), "tail",
                      F.when(F.col("to").isNull(), F.col("ahead")).alias("ahead"), (F.col("__most") - F.col("ahead")).alias("position"),
                      status.alias("status"))


def stop_at_short_page(pages: DataFrame, page_size: int = 100, body: str = "body",
                       offset: str = "page_offset", mode: str = "strict") -> DataFrame:
    """An offset chain stops at the first empty or short page; later pages are dropped.

    A page is a bare list or an object with ``results``. A page that can't be parsed fails
    the job in strict mode; in permissive mode its rows are unknown, so it does not end the
    chain, and unnesting it reports it. The stop offset is a per-(table, run) minimum
    (partial aggregate), joined back so that a run of any length can be split over tasks.
    """
    v = F.try_parse_json(F.col(body))
    d = pages.select("*", v.alias("__v"))
    problem = _problem(F.col(body), F.col("__v"))
    n = F.coalesce(F.size(_list(F.col("__v"))), F.lit(0))
    n = F.when(problem.isNotNull(), F.raise_error(problem).cast("int") if mode == "strict" else F.lit(page_size)).otherwise(n)
    sizes = d.select(*RUN_KEYS, offset, n.alias("__n"))
    stops = sizes.where(F.col("__n") < page_size).groupBy(*RUN_KEYS).agg(F.min(offset).alias("__stop"))
    d = spread_join(pages, stops, RUN_KEYS, "left")
    return d.where(F.col("__stop").isNull() | (F.col(offset) <= F.col("__stop"))).select(*pages.columns)


def derived_table(parents: DataFrame, array_path: str, parent_id: str, fill: str,
                  schema: T.StructType, body: str = "body", exact: bool = True,
                  mode: str = "strict") -> DataFrame:
    """Child rows from an array inside each parent record.

    One row per element; elements that are not objects are skipped, and so are parents
    whose value is not a list. ``fill`` takes the parent's ``parent_id`` when the child
    lacks the key (exact: key absent; lenient: absent or null). The child is filled first
    and then typed as a whole, so an empty child is a row and a bad parent id is an error.
    Permissive mode adds ``_errors``.
    """
    staged = parents.select(F.col(body).alias("__b"), F.try_parse_json(F.col(body)).alias("__v"))
    v = F.col("__v")
    staged = staged.select(F.try_variant_get(v, f"$.{parent_id}", "variant").alias("__pid"), F.col("__b").alias(body))
    d = _elements(staged, lambda x: F.try_variant_get(x, f"$.{array_path}", _VARIANTS), body, ["__pid"], mode)
    d = d.where(F.col("__page").isNotNull() | F.schema_of_variant("__e").startswith("OBJECT"))
    own = F.try_variant_get(F.col("__e"), f"$['{fill}']", "variant")
    lacks = own.isNull() if exact else own.isNull() | F.is_variant_null(own)
    members = F.try_variant_get(F.col("__e"), "$", "map<string,variant>")
    others = F.map_filter(members, lambda k, _: k != fill)
    filled = F.to_variant_object(F.map_concat(others, F.create_map(F.lit(fill), F.col("__pid"))))
    d = d.select("__page", F.when(F.col("__page").isNull() & lacks, filled).otherwise(F.col("__e")).alias("__e"))
    return _rows(d, schema, [], mode)


def nested_array_rows(df: DataFrame, col: str, keep: list[str] | None = None,
                      pos: str = "pos") -> DataFrame:
    """One row per element of an array-of-struct column (``posexplode_outer``)."""
    keep = list(keep or [c for c in df.columns if c != col])
    return (df.select(*keep, F.posexplode_outer(col).alias(pos, "__el"))
            .select(*keep, pos, "__el.*"))
