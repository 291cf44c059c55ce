"""Properties of the report over the driver tables."""

import os

import pytest
from pyspark.sql import functions as F

from scorewright.plans import compare as cmp
from scorewright.plans import report, testbed
from scorewright.registry.spark_queries import e0_report, full_report

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rep(spark):
    return full_report(spark, ROOT)


def test_nine_kpi_rows_per_wide_row(rep):
    assert rep.entity_metrics.count() == 9 * rep.wide.count()


def test_sequence_is_one_to_n(rep):
    g = rep.recommendations.groupBy("entity_id", "level_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("order_id").alias("lo"), F.max("order_id").alias("hi"),
        F.countDistinct("order_id").alias("d"))
    assert g.where("lo <> 1 OR hi <> n OR d <> n").count() == 0


def test_nation_benchmark_equals_recomputation_without_hierarchy(rep):
    nat = rep.benchmarks.where(f"level_id = '1' AND metric_id = 26").select("value").first()[0]
    w = rep.wide.agg(F.sum("loyal_returns").alias("a"), F.sum("market_returns").alias("b")).first()
    from decimal import ROUND_HALF_UP, Decimal
    expect = (Decimal(w["a"]) / Decimal(w["b"])).quantize(Decimal("0.001"), ROUND_HALF_UP) * 100
    assert nat == expect


@pytest.mark.parametrize("level", ["zone", "region"])
def test_rewrite_equals_literal_on_null_keyed_hierarchy(spark, level):
    em, bench = e0_report(spark, ROOT)
    cols = ["entity_id", "metric_id", "level_id", "b_value"]
    fast = cmp.level_matches(em, bench, level, testbed.TOTAL_LABEL).select(*cols)
    literal = cmp.level_matches_literal(em, bench, level, testbed.TOTAL_LABEL).select(*cols)
    assert fast.exceptAll(literal).count() == 0 and literal.exceptAll(fast).count() == 0


def test_rerun_gives_identical_scorecard(spark, rep):
    again = report.build(spark, testbed.sources(spark, ROOT), testbed.config())
    assert again.scorecard.exceptAll(rep.scorecard).count() == 0
    assert rep.scorecard.exceptAll(again.scorecard).count() == 0


def test_refresh_writes_every_sink(spark, tmp_path):
    out = report.refresh(spark, testbed.sources(spark, ROOT), testbed.config(), str(tmp_path))
    want = full_report(spark, ROOT)
    expected = {"header": want.header, "scorecard": want.scorecard, "recommendations": want.recommendations,
                "footnotes": want.footnotes, "metric_names": want.metric_names}
    assert set(out) == set(expected)
    tables = report.current_tables(spark, str(tmp_path))
    for name, path in out.items():
        assert os.path.isdir(path)
        got = spark.read.parquet(path)
        assert got.exceptAll(expected[name]).count() == 0 and expected[name].exceptAll(got).count() == 0
        assert tables[name].count() == got.count()
    assert tables["scorecard"].count() == 36 * want.wide.count()


def test_flagship_plan_pushes_down_and_broadcasts(rep):
    plan = rep.scorecard._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_input_row_order_does_not_matter(spark, rep):
    from scorewright.plans import catalogue as cat
    from scorewright.plans.metrics import benchmark_metrics, entity_metrics
    from scorewright.plans.recommend import recommendations, resource_catalogue

    c = cat.standard_catalogue()
    shuffled = rep.wide.repartition(5, F.rand(seed=7)).sortWithinPartitions(F.rand(seed=11))
    b1 = benchmark_metrics(rep.wide, c, testbed.TOTAL_LABEL)
    b2 = benchmark_metrics(shuffled, c, testbed.TOTAL_LABEL)
    assert b1.exceptAll(b2).count() == 0 and b2.exceptAll(b1).count() == 0
    src = testbed.sources(spark, ROOT)
    res = resource_catalogue(src.metric_names, src.resource_map, src.resource_links)
    r1 = recommendations(entity_metrics(rep.wide, c), b1, res, testbed.TOTAL_LABEL)
    r2 = recommendations(entity_metrics(shuffled, c), b2, res, testbed.TOTAL_LABEL)
    assert r1.exceptAll(r2).count() == 0 and r2.exceptAll(r1).count() == 0


def test_batch_and_subquery_snapshots_agree(spark, rep):
    alt = report.build(spark, testbed.sources(spark, ROOT), testbed.config(snapshot_mode="subquery"))
    assert alt.scorecard.exceptAll(rep.scorecard).count() == 0
    assert rep.scorecard.exceptAll(alt.scorecard).count() == 0
    assert alt.footnotes.exceptAll(rep.footnotes).count() == 0


def test_command_line_refresh(spark, tmp_path, capsys):
    import json

    from scorewright.__main__ import main

    main(["--tables", ROOT, "--out", str(tmp_path / "report"), "--master", "local[8]"])
    written = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(written) == {"header", "scorecard", "recommendations", "footnotes", "metric_names"}
    assert spark.read.parquet(written["footnotes"]).count() == 6
