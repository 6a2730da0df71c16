"""Scratch space, checkpoints and size checks."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from geoloom.runtime import broadcast_if_small, checkpoint, fits, scratch_path, scratch_root


def session(master, named=None, current=None):
    values = {"spark.checkpoint.dir": named}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: values.get(key) or default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: current, getConf=lambda: SimpleNamespace(get=lambda key: None)))


def test_the_named_folder_comes_first():
    assert scratch_root(session("yarn", "hdfs:///shared", "file:/other")) == "hdfs:///shared"
    assert scratch_root(session("yarn", None, "hdfs:///set")) == "hdfs:///set"
    assert scratch_path(session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/geoloom-x-")


def test_a_session_without_one_is_an_error():
    for master in ("spark://host:7077", "local[2]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_root(session(master))


def test_checkpoints_are_reliable_and_cut_the_plan(spark):
    df = checkpoint(spark.range(100).withColumn("x", F.col("id") * 2))
    assert "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
    assert df.agg(F.sum("x")).first()[0] == 9900


def test_broadcasts_are_measured(spark):
    df = spark.range(1000)
    assert fits(df, limit=1000) and not fits(df, limit=999) and fits(df, F.lit(10), 10_000) and not fits(df, F.lit(10), 9_999)
    hint = "ResolvedHint (strategy=broadcast)"
    assert hint in broadcast_if_small(df)._jdf.queryExecution().analyzed().toString()
    assert hint not in broadcast_if_small(df, F.lit(1 << 20))._jdf.queryExecution().analyzed().toString()


def test_long_id_lists_join_without_broadcast_when_large(spark, monkeypatch):
    import geoloom.runtime as runtime
    from geoloom.operators.filters import id_filter

    monkeypatch.setattr(runtime.fits, "__defaults__", (None, 10))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wanted = spark.range(0, 20_000, 7).unionAll(spark.range(3000).select(F.lit(7).alias("id")))
        kept = id_filter(spark.range(10_000), "id", wanted)
        assert "SortMergeJoin" in kept._jdf.queryExecution().executedPlan().toString() and kept.count() == 1429
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
