"""Operator building blocks on small fixtures, including their plans."""

import os
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from scorewright.operators import joins as jn
from scorewright.operators import mutate as mu
from scorewright.operators import reshape as rs
from scorewright.operators import windows as wn
from scorewright.plans.recommend import number_duplicates
from scorewright.session import cluster_settings
from scorewright.sources import sinks
from scorewright.sources.tables import constants


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_constants_are_local_relations(spark):
    df = constants(spark, [(1, "a"), (2, None)], "k int, v string")
    assert "LocalTableScan" in executed(df)
    assert [tuple(r) for r in df.collect()] == [(1, "a"), (2, None)]
    empty = constants(spark, [], "k int, v string")
    assert empty.count() == 0 and empty.columns == ["k", "v"]


def test_spread_join_equals_plain_join_and_never_shuffles_on_the_key_alone(spark):
    big = spark.range(1000).selectExpr("id", "id % 7 AS k")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (9, "z")], "sk long, v string")
    plain = big.join(small, F.expr("k = sk"), "left")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = jn.spread_join(big, small, "k = sk", "id")
        plan = executed(spread)
        keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
        assert "SortMergeJoin" in plan and len(keys) == 2
        assert all("_salt" in k or "_part" in k for k in keys)
        assert spread.exceptAll(plain).count() == 0 and plain.exceptAll(spread).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_materialise_modes_keep_rows(spark):
    df = spark.range(50).withColumn("v", F.col("id") * 2)
    for mode in ("none", "cache", "table", "checkpoint"):
        m = sinks.materialise(df, mode, f"t-{mode}")
        assert m.count() == 50 and m.agg(F.sum("v")).first()[0] == 2450
    table = sinks.materialise(df, "table", "scan")
    assert "FileScan parquet" in executed(table)


def test_overwrite_replaces_content(spark, tmp_path):
    p = str(tmp_path / "sink")
    sinks.overwrite(spark.range(10), p)
    sinks.overwrite(spark.range(3), p)
    assert sinks.read_back(spark, p).count() == 3


def test_append_all_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    out = sinks.append_all([a, a.select("v", "k")], ["k", "v"])
    assert out.count() == 2


def test_to_long_keep_and_drop_nulls(spark):
    df = spark.createDataFrame([("e1", 1, None), ("e2", None, None)], "id string, a int, b int")
    vals = {1: F.col("a"), 2: F.col("b")}
    keep = rs.to_long(df, ["id"], vals, keep_nulls=True)
    drop = rs.to_long(df, ["id"], {1: "a", 2: "b"}, keep_nulls=False)
    assert keep.count() == 4 and drop.count() == 1
    assert [tuple(r) for r in drop.collect()] == [("e1", 1, 1)]
    assert "Expand" in executed(keep)


def test_union_distinct(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(r[0] for r in rs.union_distinct([a, b]).collect()) == [1, 2, 3]


def test_fill_if_exists_never_multiplies_rows(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1)], "k int, active int")
    ev = spark.createDataFrame([(1,), (1,), (1,), (3,)], "ek int")
    out = mu.fill_if_exists(df, "active", 0, ev, "k", "ek")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 0), (2, None), (3, 1)]


def test_number_duplicates_equals_row_number(spark):
    rows = [("e1", "4", 10), ("e1", "4", 10), ("e1", "4", 3), ("e1", None, 3), ("e2", "1", 10)] * 3
    fired = spark.createDataFrame(rows, "entity_id string, level_id string, resource_id int")
    w = Window.partitionBy("entity_id", "level_id").orderBy("resource_id")
    ref = fired.withColumn("order_id", F.row_number().over(w)).select("resource_id", "level_id", "entity_id", "order_id")
    got = number_duplicates(fired)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_top1_and_latest_per_key(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 3, "c"), (2, 1, "z")], "k int, v int, name string")
    top = wn.top1(df, "k", [F.col("v").desc(), F.col("name").asc()])
    assert sorted(tuple(r) for r in top.collect()) == [(1, 5, "a"), (2, 1, "z")]
    assert "WindowGroupLimit" in executed(top)
    ranked = wn.latest_per_key(df, "k", [F.col("v").desc()]).where("rnk = 1")
    assert ranked.count() == 3          # ties kept


def test_cross_with_constants_is_a_generate(spark):
    df = spark.range(4).withColumnRenamed("id", "entity")
    out = jn.cross_with_constants(df, [(8, "a"), (9, "b")], ["metric_id", "tag"])
    assert out.count() == 8 and set(out.columns) == {"entity", "metric_id", "tag"}
    plan = executed(out)
    assert "Generate" in plan and "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_semi_join_and_left_join_defaults(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(1, 5), (1, 6), (3, 7)], "k int, v int")
    assert jn.semi_join(a, b, "k").count() == 2
    out = jn.left_join(a, b, "k", defaults={"v": 0})
    assert sorted(tuple(r) for r in out.collect()) == [(1, 5), (1, 6), (2, 0), (3, 7)]


def test_cluster_settings_scale_with_input():
    small = cluster_settings(10 * 1024 ** 3)
    huge = cluster_settings(100 * 1024 ** 4)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(huge["spark.sql.shuffle.partitions"]) == 409600
    assert huge["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert huge["spark.sql.adaptive.forceOptimizeSkewedJoin"] == "true"


def test_hot_key_sequence_equals_window(spark):
    rows = [("hot", i % 50, i) for i in range(400)] + [(None, i, i) for i in range(150)] + [(f"c{i % 9}", i, i) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, o int, tie int").repartition(7)
    order = [F.col("o").desc(), F.col("tie").asc()]
    plain = wn.with_sequence(df, ["k"], order)
    hot = wn.with_sequence(df, ["k"], order, hot_rows=100)
    assert hot.columns == plain.columns
    assert hot.exceptAll(plain).count() == 0 and plain.exceptAll(hot).count() == 0
    assert wn.with_sequence(df.where("k <> 'hot'"), ["k"], order, hot_rows=100).count() == 60


def test_duplicate_patch_keys_raise(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, new_value string")
    with pytest.raises(Exception, match="several patch rows for key 1"):
        mu.keyed_update(t, twice, "k", "v").collect()
    unasked = spark.createDataFrame([(7, "x"), (7, "y"), (2, "z")], "k int, new_value string")
    assert sorted(tuple(r) for r in mu.keyed_update(t, unasked, "k", "v").collect()) == [(1, "a"), (2, "z")]


def test_large_duplicate_counts_expand_in_chunks(spark, monkeypatch):
    from scorewright.plans import recommend

    monkeypatch.setattr(recommend, "CHUNK", 7)
    fired = spark.range(50).selectExpr("'e' AS entity_id", "'4' AS level_id", "CAST(id % 2 AS INT) AS resource_id")
    got = sorted((r["order_id"], r["resource_id"]) for r in number_duplicates(fired).collect())
    assert got == [(i + 1, int(i >= 25)) for i in range(50)]


def test_workspace_releases_frames_and_tables(spark):
    work = sinks.Workspace()
    cached = sinks.materialise(spark.range(5), "cache", work=work)
    table = sinks.materialise(spark.range(5), "table", "w", work)
    cached.count()
    path = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert cached.is_cached and os.path.isdir(path)
    work.release()
    assert not cached.is_cached and not os.path.exists(path)
