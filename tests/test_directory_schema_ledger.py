"""Page directory, schema summaries per batch, run ledger."""

import json
import random

import pytest

from keelson.operators.cursor import page_slice
from keelson.operators.directory import PageDirectory
from keelson.operators.schema import FALLBACK_DDL, infer_schema
from keelson.operators.schema_log import SchemaLog, join_kinds, kind_text, parse_kind
from keelson.session import work_dir


def _table(spark, n=90, seed=3):
    """Ties, repeated rows, and rows without a cursor value."""
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, 1, 2, 2, 2, 5]), rnd.randrange(12), "x") for _ in range(n)]
    return spark.createDataFrame(rows, "c int, k int, v string")


def test_pages_equal_page_slice(spark):
    df = _table(spark)
    pages = PageDirectory(spark, work_dir(spark, "t"), "c", ["k"], 20)
    pages.build(df)
    assert {(r.page, r.n_rows) for r in pages.entries().collect()} == {(1, 20), (2, 20), (3, 20), (4, 20), (5, 10)}
    for page in (1, 3, 5, 6):
        assert [tuple(r) for r in pages.page(df, page).collect()] == [tuple(r) for r in page_slice(df, "c", ["k"], page, 20).collect()]


def test_an_extended_directory_is_that_of_the_whole(spark):
    df = _table(spark)
    early, later = df.where("c is null or c <= 2"), df
    grown, whole = (PageDirectory(spark, work_dir(spark, "t"), "c", ["k"], 7) for _ in range(2))
    grown.build(early)
    grown.extend(later)
    whole.build(df)
    rows = lambda p: sorted(map(tuple, p.entries().collect()))
    assert rows(grown) == rows(whole)


def test_a_page_is_a_pushed_range_without_a_sort_by_range(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    pages = PageDirectory(spark, work_dir(spark, "t"), "o_orderdate", ["o_orderkey"], 100)
    pages.build(orders)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = pages.page(orders, 3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):].split("]")[0]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThanOrEqual(o_orderdate" in pushed
    assert "rangepartitioning" not in plan


def test_directory_of_an_empty_table_and_bad_orders(spark):
    df = spark.createDataFrame([], "c int, k int")
    pages = PageDirectory(spark, work_dir(spark, "t"), "c", ["k"], 5)
    pages.build(df)
    assert pages.page(df, 1).count() == 0
    more = spark.createDataFrame([(1, 1), (2, 2)], "c int, k int")
    pages.extend(more)
    assert pages.page(more, 1).count() == 2
    with pytest.raises(ValueError):
        PageDirectory(spark, "x", "page", ["k"], 5)
    with pytest.raises(ValueError):
        PageDirectory(spark, "x", "c", ["k"], 0)


NUMBERS = [1, 2 ** 40, 12345678901234567890123, 1.5, 1.0, 1e300, 0.001, None]


def _record(rnd):
    """Fields that agree in kind, down to their numbers, and one (``any``) that does not."""
    number = lambda: rnd.choice(NUMBERS)
    nested = lambda: {n: number() for n in rnd.sample(["a", "b c", "n:m", "`q", "INT"], rnd.randrange(4))}
    fields = {"n": number, "i": lambda: rnd.choice([1, None]), "s": lambda: rnd.choice(["x", None]), "r s": nested,
              "l": lambda: [nested() for _ in range(rnd.randrange(3))], "v": lambda: [number() for _ in range(rnd.randrange(3))],
              "any": lambda: rnd.choice([1, "s", True, nested(), [nested()], None])}
    return {n: fields[n]() for n in rnd.sample(list(fields), 3)}


@pytest.mark.parametrize("seed", range(3))
def test_any_split_gives_the_schema_of_the_whole(spark, seed):
    rnd = random.Random(seed)
    texts = [json.dumps(_record(rnd)) for _ in range(24)] + [None, "not json"]
    rnd.shuffle(texts)
    df = spark.createDataFrame([(t, rnd.randrange(4)) for t in texts], "j string, b int")
    log = SchemaLog(spark, work_dir(spark, "t"), "j")
    for b in (2, 0, 3, 1, 0):                               # any order; a batch again changes nothing
        log.add(df.where(f"b = {b}"), b)
    assert log.schema() == infer_schema(df, "j").first().ddl


def test_joins_of_types_are_a_lattice():
    kinds = [parse_kind(t) for t in ("VOID", "BIGINT", "DOUBLE", "DECIMAL(2,1)", "DECIMAL(38,0)", "STRING", "VARIANT", "ARRAY<VOID>",
                                     "ARRAY<BIGINT>", "OBJECT<>", "OBJECT<`a``: b`: BIGINT, c: ARRAY<OBJECT<d: DECIMAL(3,2)>>>")]
    for a in kinds:
        assert parse_kind(kind_text(a)) == a and join_kinds(a, a) == a
        for b in kinds:
            assert join_kinds(a, b) == join_kinds(b, a)
            for c in kinds:
                assert join_kinds(join_kinds(a, b), c) == join_kinds(a, join_kinds(b, c))


def test_a_log_without_samples(spark):
    log = SchemaLog(spark, work_dir(spark, "t"), "j")
    assert log.schema() is None and log.schema(fallback=True) == FALLBACK_DDL
    log.add(spark.createDataFrame([(None,)], "j string"), 0)
    assert log.schema() is None


def test_a_run_repeats_only_what_failed(spark, sf_small):
    from keelson.plans.catalog import _FailingOnce
    from keelson.plans.ingest import IngestFailed, RunLedger, ingest
    conn, root = _FailingOnce(spark, sf_small), work_dir(spark, "t")
    spec = {"objects": [{"table": {"source_table": t}} for t in ("orders", "customer")]}
    with pytest.raises(IngestFailed, match="orders can't be reached"):
        ingest(spark, spec, conn, root, run="a")
    ingest(spark, spec, conn, root, run="a")
    ingest(spark, spec, conn, root, run="a")                # nothing left to do
    ledger = RunLedger(spark, f"{root}/_runs")
    got = sorted((r.destination, r.attempt, r.status, bool(r.error)) for r in ledger.rows().collect())
    assert got == [("customer", 1, "done", False), ("orders", 1, "failed", True), ("orders", 2, "done", False)]
    assert conn.reads == 2 and ledger.attempts("b") == {}
