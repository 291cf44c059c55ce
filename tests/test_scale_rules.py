"""Rules that only larger or other data than the driver tables would show."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from scorewright import fixed, session
from scorewright.plans import catalogue as cat
from scorewright.plans import compare as cmp
from scorewright.plans import report, testbed
from scorewright.plans.metrics import benchmark_metrics, entity_metrics

ROOT = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def copied(spark, root, tables=TABLES):
    for t in tables:
        spark.read.parquet(f"{ROOT}/{t}.parquet").write.parquet(f"{root}/{t}.parquet")


def test_large_keys_stay_apart(spark, tmp_path):
    """Customers 1, 1000001 and a key beyond nine digits: separate in every fact and in the wide table."""
    root = str(tmp_path)
    copied(spark, root, [t for t in TABLES if t not in ("customer", "orders", "lineitem", "events")])
    far = (1, 1_000_001, 12_345_678_901)
    read = lambda t: spark.read.parquet(f"{ROOT}/{t}.parquet")
    one = read("customer").where("c_custkey = 1").drop("c_custkey", "c_name", "c_acctbal")
    keys = spark.createDataFrame([(k, f"Customer#{k:09d}", 6000.0) for k in far], "c_custkey long, c_name string, c_acctbal double")
    keys.crossJoin(one).select(read("customer").columns).write.parquet(f"{root}/customer.parquet")
    orders = spark.createDataFrame([(i, k) for i, k in enumerate(far, 1)], "o_orderkey long, o_custkey long")
    o = read("orders").limit(1).drop("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    orders = orders.crossJoin(o).withColumn("o_orderdate", F.lit("2001-03-01").cast("timestamp_ntz")).withColumn("o_orderstatus", F.lit("F"))
    orders.select(read("orders").columns).write.parquet(f"{root}/orders.parquet")
    li = read("lineitem").limit(1).drop("l_orderkey", "l_shipdate")
    li = spark.createDataFrame([(i,) for i in (1, 2, 3)], "l_orderkey long").crossJoin(li)
    li.withColumn("l_shipdate", F.lit("2001-04-01").cast("timestamp_ntz")).select(read("lineitem").columns).write.parquet(
        f"{root}/lineitem.parquet")
    ev = read("events").limit(1).drop("user_id")
    spark.createDataFrame([(k,) for k in far], "user_id long").crossJoin(ev).select(read("events").columns).write.parquet(
        f"{root}/events.parquet")
    rep = report.build(spark, testbed.sources(spark, root), testbed.config())
    ids = {"Customer#000000001", "Customer#001000001", "Customer#12345678901"[-19:]}
    for name in ("participation", "service", "visit_sales", "loyalty", "enrollment", "opportunity", "campaigns", "advocates"):
        got = [r[0] for r in getattr(rep.facts, name).select("entity_id").collect()]
        assert sorted(got) == sorted(ids), name
    wide = rep.wide.collect()
    assert sorted(r["entity_id"] for r in wide) == sorted(ids)
    assert all(r["attributed_sales"] == wide[0]["attributed_sales"] and r["visit_households"] == 1 for r in wide)
    rep.release()


def test_short_code_length_is_configuration(spark):
    cfg = testbed.config(short_code_len=6)
    rep = report.build(spark, testbed.sources(spark, ROOT), cfg)
    assert {len(r[0]) for r in rep.dimension.select("entity_id").distinct().collect()} == {6}
    assert report.ReportConfig("2001-01-01", "T", "M").short_code_len == 6


def wide_rows(spark, kind):
    cols = ["favour_brand", "favour_undecided", "count_new", "count_mine", "count_old", "count_any", "inspections_done",
            "repair_orders", "visit_sales", "visit_households", "loyal_returns", "market_returns", "attributed_sales",
            "retail_sales", "units_sold", "customers_contacted"]
    rows = [("a", "R", "Z", "D", 1, "1.5 2.0 3.5 0 0 0 1.5 2.5 1.4 2.4 0.1 0.3 10.25 30.5 2 4".split()),
            ("b", "R", "Z", "D", 1, "2.0 1.5 3.5 0 0 0 0.5 1.5 2.2 3.2 0.2 0.3 1.75 3.5 1 3".split())]
    return spark.createDataFrame([(*r[:5], *map(Decimal, r[5])) for r in rows],
                                 "entity_id string, region string, zone string, district string, participation int, "
                                 + ", ".join(f"{c} {kind}" for c in cols))


def exact(a, b):
    return ((Decimal(a) / Decimal(b)).quantize(Decimal("0.001"), "ROUND_HALF_UP") * 100)


def test_fractional_measures_keep_their_fractions(spark):
    wide, c = wide_rows(spark, "decimal(12,2)"), cat.standard_catalogue()
    em = {(r["entity_id"], r["metric_id"]): r["value"] for r in entity_metrics(wide, c).collect()}
    assert em["a", 9] == Decimal("3.5") and em["a", 14] == Decimal("3.5")
    assert em["a", 15] == exact("1.5", "2.5") and em["a", 25] == exact("1.4", "2.4") and em["a", 27] == exact("10.25", "30.5")
    bench = {r["metric_id"]: r["value"] for r in benchmark_metrics(wide, c, "T").where("level_id = '1'").collect()}
    assert bench[9] == Decimal("3.5") and bench[14] == Decimal("3.5")
    assert bench[15] == exact("2.0", "4.0") and bench[25] == exact("3.6", "5.6") and bench[26] == exact("0.3", "0.6")
    assert bench[27] == exact("12.00", "34.0") and bench[28] == exact("3", "7")
    assert dict(entity_metrics(wide, c).dtypes)["value"] == dict(benchmark_metrics(wide, c, "T").dtypes)["value"] == "decimal(20,10)"


def test_integer_averages_still_truncate(spark):
    wide = wide_rows(spark, "decimal(12,2)").withColumns({k: F.col(k).cast("long") for k in ("favour_brand", "favour_undecided")})
    bench = benchmark_metrics(wide, cat.standard_catalogue(), "T").where("level_id = '1' AND metric_id = 9").first()
    assert bench["value"] == 3


def test_null_region_hierarchy_needs_no_hint_and_keeps_its_rows(spark):
    """500 districts without a region: every entity KPI pairs with each of their rows at the total, in every plan."""
    em = spark.createDataFrame([(f"e{i}", None if i % 2 else "R", f"Z{i}", f"D{i}", 25, Decimal(i)) for i in range(20)],
                               "entity_id string, region string, zone string, district string, metric_id int, value decimal(20,10)")
    bench = spark.createDataFrame(
        [("T", f"Z{i}", f"D{i}", "1", 25, Decimal(i)) for i in range(500)] + [("R", None, None, "2", 25, Decimal(1))],
        "region string, zone string, district string, level_id string, metric_id int, value decimal(20,10)")
    cols = ["entity_id", "metric_id", "level_id", "b_value"]
    for limit in ("-1", "100m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            for level in cmp.LEVELS:
                fast = cmp.level_matches(em, bench, level, "T").select(*cols)
                slow = cmp.level_matches_literal(em, bench, level, "T").select(*cols)
                assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
                assert "ResolvedHint" not in fast._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert cmp.level_matches(em, bench, "nation", "T").count() == 20 * 500


def test_second_refresh_reads_changed_tables(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    copied(spark, root)
    first = report.refresh(spark, testbed.sources(spark, root), testbed.config(), out)
    before = {r["entity_id"]: r["vendor_tool"] for r in spark.read.parquet(first["header"]).collect()}
    spark.read.parquet(f"{ROOT}/lineitem.parquet").withColumn("l_suppkey", F.lit(987654).cast("long")).write.mode(
        "overwrite").parquet(f"{root}/lineitem.parquet")
    second = report.refresh(spark, testbed.sources(spark, root), testbed.config(), out)
    after = {r["entity_id"]: r["vendor_tool"] for r in report.current_tables(spark, out)["header"].collect()}
    assert "Vendor 987654" in after.values() and "Vendor 987654" not in before.values() and set(before) == set(after)
    assert spark.read.parquet(first["scorecard"]).count() and first["scorecard"] != second["scorecard"]
    report.refresh(spark, testbed.sources(spark, root), testbed.config(), out)
    assert not (tmp_path / "out" / first["header"].split("/")[-2]).exists()      # older than the version before


def test_registered_queries_notice_changed_tables(spark, tmp_path):
    from scorewright.registry.spark_queries import state_key

    root = str(tmp_path)
    copied(spark, root, ["region"])
    a = state_key(spark, root)
    assert state_key(spark, root) == a
    spark.range(3).write.parquet(f"{root}/more.parquet")
    assert state_key(spark, root) != a


def test_registered_queries_release_old_states(spark, tmp_path):
    import os

    from scorewright.registry import spark_queries as q

    root = str(tmp_path)
    copied(spark, root)
    q.e0_report(spark, root)
    first = q.state_key(spark, root)
    held = [p.removeprefix("file:") for w in (q._sources[first].work, q._reports[first].work, q._e0[first][2]) for _, p in w.paths]
    assert held and all(os.path.exists(p) for p in held)
    spark.range(3).write.parquet(f"{root}/more.parquet")
    assert q.QUERIES["job_header"](spark, root).count() > 0
    assert not any(os.path.exists(p) for p in held)
    assert not {first} & {*q._sources, *q._reports, *q._e0}


def test_hot_keys_are_found_by_the_sketch(spark):
    from scorewright.operators.windows import hot_keys

    df = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE CAST(id AS STRING) END AS k",
                                        "id % 2 AS j")
    got = {tuple(r) for r in hot_keys(df, ["k", "j"], 1_000, tracked=1_000).collect()}
    assert got == {("hot", 0), ("hot", 1), (None, 0), (None, 1)}
    assert hot_keys(df, ["k", "j"], 6_000) is None and hot_keys(df.limit(0), ["k"], 1) is None


def test_refresh_releases_what_it_holds(spark, tmp_path):
    persisted = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = persisted()
    src = testbed.sources(spark, ROOT)
    assert not src.work.paths      # nothing is staged before a period is asked for
    src.usage.at(src.usage.latest())
    staged = src.work.paths[0][1].removeprefix("file:")
    report.refresh(spark, src, testbed.config(), str(tmp_path))
    assert persisted() <= before and not src.work.paths
    import os
    assert not os.path.exists(staged)


def test_command_line_with_own_sources(spark, tmp_path, capsys):
    import dataclasses

    from scorewright.__main__ import main
    from scorewright.sources.snapshot import rows_of

    src = testbed.sources(spark, ROOT)
    for f in dataclasses.fields(src):
        if f.name != "work":
            rows_of(getattr(src, f.name)).write.parquet(str(tmp_path / "src" / f"{f.name}.parquet"))
    cfg = {"report_date": "2001-06-30", "total_label": testbed.TOTAL_LABEL, "manager_title_prefix": testbed.MANAGER_PREFIX,
           "keep": "open_flag = 'N'", "order": ["period DESC"], "region_suffix": testbed.REGION_SUFFIX, "short_code_len": 19,
           "source_labels": testbed.SOURCE_LABELS, "tooltip_sources": testbed.TOOLTIP_SOURCES}
    (tmp_path / "cfg.json").write_text(json.dumps(cfg))
    main(["--sources", str(tmp_path / "src"), "--config", str(tmp_path / "cfg.json"), "--out", str(tmp_path / "out"), "--master", "local[8]"])
    written = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    want = report.build(spark, src, testbed.config()).scorecard
    got = spark.read.parquet(written["scorecard"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_only_known_local_masters_get_a_private_folder():
    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, key, default=None):
            if self.master is None:
                raise RuntimeError("no such setting")
            return self.master

    class Spark:
        def __init__(self, master):
            self.conf = Conf(master)

    assert [session._is_local(Spark(m)) for m in ("local", "local[8]", "local-cluster[3,2,5000]", "yarn", "", None)] == [
        True, True, False, False, False, False]


@pytest.mark.parametrize("name, value", [
    ("SHORT_CODE_LEN", 6), ("CAMPAIGN_FLAG", "1"), ("FLAG_ON", "1"), ("KPI_DECIMAL", "DECIMAL(20,10)"),
    ("WIDEN_DECIMAL", "DECIMAL(20,13)"), ("RATIO_PLACES", 3), ("PERCENT_PLACES", 1), ("LEVEL_NATION", "1"),
    ("LEVEL_REGION", "2"), ("LEVEL_ZONE", "3"), ("LEVEL_DISTRICT", "4"), ("YES", "Y"), ("NO", "N"), ("MISSING_TEXT", "-"),
    ("GREEN", "226,240,217"), ("RED", "244,186,186"), ("WHITE", "255,255,255"), ("MISSING_NAME", "None"),
    ("FOOTNOTE_TYPE", "Footer"), ("SOURCE_SEPARATOR", " Data Source: "), ("FOOTNOTE_TAIL", "  "), ("TOOLTIP_SEPARATOR", " "),
    ("RECOMMENDATION_RULES", ((10, "below_bench"), (3, "not_one"))),
])
def test_fixed_values(name, value):
    assert getattr(fixed, name) == value


def test_fixed_resource_map():
    assert dict(fixed.RESOURCE_METRIC_MAP) == {1: 4, 2: 6, 3: 8, 4: 10, 5: 12, 6: 17, 7: 22, 8: 23, 9: 24, 10: 26, 11: 29,
                                               12: 30, 13: 31, 14: 35, 15: 36}
    assert cat.standard_catalogue().ids == [8, 9, 14, 15, 25, 26, 27, 28, 34]
