"""Plan guards: no pair enumeration and no Python in any report query, and the plan shapes the README states."""

import re

import pytest
from pyspark.sql import functions as F

from scorewright.operators.joins import SALTS, widen
from scorewright.plans import report, testbed
from scorewright.plans.compare import LEVELS, keyed_bench, level_parts
from scorewright.plans.dimension import entity_dimension
from scorewright.plans.facts import advocates, participation, visit_sales
from scorewright.plans.metrics import benchmark_metrics
from scorewright.registry.spark_queries import full_report, rep_sources
from scorewright.registry.spark_queries import QUERIES

ROOT = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_or_python(spark, name):
    df = QUERIES[name](spark, ROOT)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, f"{name}: {found}"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def test_dimension_ranks_base_rows_before_any_join(spark, no_broadcast):
    src, cfg = rep_sources(spark, ROOT), testbed.config()
    plan = plan_of(entity_dimension(src.history, src.current, src.regions, keep=cfg.keep))
    limits = re.findall(r"WindowGroupLimit .*", plan)
    assert [x.rsplit(", ", 1)[1] for x in limits] == ["Final", "Partial"]
    # every join is above the ranking; the orders are shuffled once, by the key that also joins them to the customers
    below = plan[plan.index("WindowGroupLimit"):]
    ranked = below[:below.index("parquet [o_custkey")]
    assert "Join" not in ranked and ranked.count("Exchange") == 1 and "Exchange hashpartitioning(o_custkey" in ranked
    scan = re.search(r"FileScan parquet \[(o_custkey[^]]*)\]", plan)[1]
    assert len(scan.split(",")) == 4
    assert not re.search(r"Exchange hashpartitioning\(region_name#\d+, \d+\)", plan)      # regions are few: spread
    registered = plan_of(QUERIES["job_entity_dimension"](spark, ROOT))
    assert registered.index("WindowGroupLimit") < registered.index("parquet [o_custkey")


def test_dimension_of_a_plain_history_is_the_same(spark):
    src, cfg = rep_sources(spark, ROOT), testbed.config()
    a, b = (entity_dimension(h, src.current, src.regions, keep=cfg.keep) for h in (src.history, src.history.frame()))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


def test_order_over_joined_columns_is_ranked_after_the_joins(spark):
    src = rep_sources(spark, ROOT)
    by_lines = entity_dimension(src.history, src.current, src.regions, order=[F.col("lines").asc_nulls_last(), F.col("period").desc()])
    default = entity_dimension(src.history, src.current, src.regions)
    assert by_lines.exceptAll(default).count() == 0 and default.exceptAll(by_lines).count() == 0


def test_snapshots_reach_the_scan(spark):
    src = rep_sources(spark, ROOT)
    periods = report.snapshot_periods(src, testbed.config())
    for plan in (plan_of(visit_sales(src.visits, latest=periods["visits"])), plan_of(advocates(src.advocates, periods["advocates"]))):
        assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\((o_orderdate|ts),", plan), plan
    fresh = testbed.sources(spark, ROOT)        # a source whose facts aren't cached
    staged = fresh.usage.of.source.at(periods["usage"])      # what is written for that year
    year = plan_of(staged)
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(l_shipdate,", year), year
    assert staged.selectExpr("min(period) = max(period)").first()[0]
    usage = plan_of(participation(fresh.usage, periods["usage"]))
    assert len(fresh.work.paths) == 1 and usage.count("FileScan") == 1 and "lineitem" not in usage
    fresh.loyalty.at(periods["loyalty"])
    assert len(fresh.work.paths) == 1       # one staged year for all sources of it
    fresh.work.release()
    latest = plan_of(QUERIES["latest_snapshot"](spark, ROOT))
    assert "DataFilters: [isnotnull(o_orderdate" in latest and "subquery" in latest.lower()


@pytest.mark.parametrize("name", ["scorecard", "recommendations"])
def test_comparisons_read_the_kpis_once(spark, name):
    plan = plan_of(getattr(full_report(spark, ROOT), name))
    assert plan.count("FileScan") == 2 and "Generate" in plan      # the KPIs and the keyed benchmarks


@pytest.mark.parametrize("name", ["job_scorecard", "job_recommendations", "compare_nation", "join_theta_residual"])
def test_no_shuffle_on_the_kpi_alone(spark, name, no_broadcast):
    lines = plan_of(QUERIES[name](spark, ROOT)).split("\n")
    depth = [re.search(r"[A-Za-z]", x + "z").start() for x in lines]
    for i, line in enumerate(lines):
        if keys := re.search(r"Exchange hashpartitioning\(([^)]*)\)", line):
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            names = {re.sub(r"#.*", "", k.strip()) for k in keys[1].split(",")[:-1]}
            if any("FileScan" in x for x in lines[i:end]):         # not the joins among the literal config tables
                assert not names <= {"metric_id", "b_metric", "_res_metric"}, line


def test_few_keys_of_a_level_are_dealt_over_parts(spark, no_broadcast):
    """With 5 regions and one total, the comparison's shuffle still has dozens of keys per KPI at each level."""
    rep = full_report(spark, ROOT)
    parts = level_parts(rep.benchmarks)
    keyed = keyed_bench(rep.benchmarks, testbed.TOTAL_LABEL)
    assert parts["nation"] == SALTS and parts["region"] >= SALTS // 10 and keyed.parts == parts
    per_level = keyed.frame.selectExpr("lv", "k1", "k2", "k3", "part").distinct().groupBy("lv").count().collect()
    assert {r["lv"] for r in per_level} == set(LEVELS) and all(r["count"] >= SALTS for r in per_level)
    plan = plan_of(QUERIES["job_scorecard"](spark, ROOT))
    assert re.search(r"Exchange hashpartitioning\(lv#\d+, metric_id#\d+, k1#\d+, k2#\d+, k3#\d+, part#\d+", plan)


def test_rollup_expands_partial_states_only(spark):
    for name in ("grouping_sets", "level_label", "job_benchmark_metrics"):
        df = full_report(spark, ROOT).wide if name.startswith("job") else None
        plan = plan_of(QUERIES[name](spark, ROOT) if df is None else benchmark_metrics(df, testbed.config().catalogue, "T"))
        at = [m.start() for m in re.finditer(r"Expand \[.*spark_grouping_id", plan)]
        assert len(at) == 1, name
        below = plan[at[0]:]
        assert below.count("HashAggregate") >= 2 and "Exchange" in below, name      # the finest level comes first


def test_hot_key_of_the_wide_join_is_split(spark, no_broadcast, tmp_path):
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        spine = spark.range(60_000).selectExpr(
            "CASE WHEN id % 10 < 9 THEN 'hot' ELSE CAST(id AS STRING) END AS entity_id", "md5(CAST(id AS STRING)) AS pad").repartition(6)
        facts = [spark.range(6_000).selectExpr("CASE WHEN id = 0 THEN 'hot' ELSE CAST(id * 10 + 9 AS STRING) END AS entity_id",
                                               f"id AS f{i}") for i in range(2)]
        out = widen(spine, facts, "entity_id")
        out.write.parquet(str(tmp_path / "wide"))
        df = widen(spine, facts, "entity_id")
        assert df.collect() and plan_of(df).split("Initial Plan")[0].count("skew=true") >= 1
        assert df.count() == 60_000
    finally:
        for k in settings:
            spark.conf.unset(k)
