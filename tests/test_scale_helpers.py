"""Scale helpers: shared scratch folder, partition sizing, joins with hot keys."""

import pytest

from keelson.session import shuffle_partitions_for, work_dir


def test_work_dir_uses_configured_checkpoint_dir(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b                                   # a fresh folder per call
    if configured:
        assert a.startswith(configured.rstrip("/") + "/keelson/")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_shuffle_partitions_for():
    assert shuffle_partitions_for(0) == 200
    assert shuffle_partitions_for(100 * 2**40) == 819_200
    assert shuffle_partitions_for(10 * 2**30, per_partition=256 << 20) == 200


def test_session_sizes_shuffles_for_its_input():
    from keelson.session import build_session
    import inspect
    assert "input_bytes" in inspect.signature(build_session).parameters


def test_work_dir_demands_a_shared_folder_off_local_mode(monkeypatch):
    from types import SimpleNamespace
    conf = SimpleNamespace(get=lambda *a: None)
    fake = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(fake)


def test_spread_join_exchanges_both_sides(spark):
    """An aggregated side is exchanged anew, so adaptive execution can split the other."""
    from keelson.operators.joins import spread_join
    left = spark.range(100).selectExpr("id % 3 as k", "id as v")
    right = left.groupBy("k").count()
    joined = spread_join(left, right, ["k"]).hint("merge")
    assert joined.count() == 100
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spread_join(left, right, ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(k") >= 3
