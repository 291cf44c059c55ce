"""Semantics traps T1-T13 on micro-fixtures (FIXTURES.md F1-F15)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from scorewright.operators import aggregate as agg
from scorewright.operators import mutate as mu
from scorewright.plans import catalogue as cat
from scorewright.plans import compare as cmp
from scorewright.plans import facts as fx
from scorewright.plans.dimension import entity_dimension, infer_activity
from scorewright.plans.metrics import benchmark_metrics
from scorewright.plans.recommend import recommendations
from scorewright.sources import snapshot
from scorewright.sources.tables import constants

TOTAL = "NATIONWIDE"
EM_SCHEMA = "entity_id string, region string, zone string, district string, metric_id int, value decimal(20,10)"
BENCH_SCHEMA = "region string, zone string, district string, level_id string, metric_id int, value decimal(20,10)"


def D(x):
    return None if x is None else Decimal(str(x))


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# ---------------------------------------------------------------------------
# T1 / T2 / F8 / F9: formatting and colours
# ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def card_fixture(spark):
    em = spark.createDataFrame([
        ("e1", "R", "Z", "D", 8, None), ("e1", "R", "Z", "D", 9, None), ("e1", "R", "Z", "D", 15, None),
        ("e2", "R", "Z", "D", 25, D(50)), ("e3", "R", "Z", "D", 25, D(40)), ("e4", "R", "Z", "D", 25, D(60)),
        ("e5", "R", "Z", "D", 15, D(10)), ("e6", "R", "Z", "D", 8, D(1)), ("e7", "R", "Z", "D", 9, D(1234567)),
        ("e8", "R", "Z", "X", 25, D(70)),
    ], EM_SCHEMA)
    bench = spark.createDataFrame([
        ("R", "Z", "D", "4", 25, D(50)), ("R", "Z", "D", "4", 15, D(20)), ("R", "Z", "D", "4", 9, D(1000.9)),
        ("R", "Z", "D", "4", 8, D(62.5)),
    ], BENCH_SCHEMA)
    card = cmp.scorecard(em, bench, cat.standard_catalogue(), "2017-12-31", TOTAL, levels=("district",))
    return {r["entity_id"] + "/" + str(r["metric_id"]): r for r in card.collect()}


def test_t1_null_value_shows_n_for_every_kpi(card_fixture):
    assert card_fixture["e1/8"]["value_text"] == "N"
    assert card_fixture["e1/9"]["value_text"] == "N"
    assert card_fixture["e1/15"]["value_text"] == "N"


def test_f9_colours_vs_benchmark(card_fixture):
    assert card_fixture["e2/25"]["value_rgb"] == cat.GREEN   # equal -> green
    assert card_fixture["e3/25"]["value_rgb"] == cat.RED     # below -> red
    assert card_fixture["e4/25"]["value_rgb"] == cat.GREEN   # above -> green
    assert card_fixture["e5/15"]["value_rgb"] == cat.WHITE   # KPI 15 is never coloured
    assert card_fixture["e6/8"]["value_rgb"] == cat.GREEN and card_fixture["e6/8"]["value_text"] == "Y"


def test_t2_unmatched_benchmark_text_is_null(card_fixture):
    r = card_fixture["e8/25"]
    assert r["level_id"] is None and r["bench_text"] is None and r["value_rgb"] == cat.WHITE
    assert card_fixture["e2/25"]["bench_text"] == "50.0%"
    assert card_fixture["e7/9"]["value_text"] == "1,234,567" and card_fixture["e7/9"]["bench_text"] == "1,000"
    assert card_fixture["e6/8"]["bench_text"] == "62.5%"
    assert card_fixture["e1/8"]["period"] == dt.date(2017, 12, 31)


# ---------------------------------------------------------------------------
# T3: level labels from values; T4: filter after the outer join
# ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def wide_with_null_keys(spark):
    schema = "entity_id string, region string, zone string, district string, visit_sales long, visit_households long"
    return spark.createDataFrame([
        ("a", "R1", "Z1", "D1", 1, 2), ("b", "R1", "Z1", None, 1, 4), ("c", None, "Z9", "D9", 2, 4),
    ], schema)


def _one_kpi():
    k = [x for x in cat.standard_catalogue().kpis if x.metric_id == 25]
    return cat.Catalogue(tuple(k))


def test_t3_real_null_keys_are_labelled_like_subtotals(wide_with_null_keys):
    b = benchmark_metrics(wide_with_null_keys, _one_kpi(), TOTAL)
    got = rows(b, "region", "zone", "district", "level_id")
    # R1/Z1/NULL appears twice with level '3' (subtotal and the real NULL district);
    # the real NULL region yields a region-NULL row in each of the three keyed grouping sets,
    # all labelled '1' and renamed to the total label, besides the grand total itself: 4 rows.
    assert got.count(("R1", "Z1", None, "3")) == 2
    assert sum(1 for g in got if g[0] == TOTAL and g[3] == "1") == 4
    assert ("R1", None, None, "2") in got


@pytest.fixture(scope="module")
def t4_fixture(spark):
    em = spark.createDataFrame([
        ("zone_row", "R", "Z1", "D1", 25, D(1)),     # zone-level benchmark row exists -> level 3
        ("deep_only", "R", "Z2", "D2", 25, D(1)),    # only a district row exists -> lost at zone level
        ("nothing", "R", "Z3", "D3", 25, D(1)),      # no benchmark at all -> kept with NULLs
        ("null_zone", "R", None, "D4", 25, D(1)),    # NULL key never matches -> kept with NULLs
        ("dup", "R", "Z5", "D5", 25, D(1)),          # zone row + a real NULL-district row -> two rows
    ], EM_SCHEMA)
    bench = spark.createDataFrame([
        ("R", "Z1", None, "3", 25, D(5)), ("R", "Z1", "D1", "4", 25, D(5)),
        ("R", "Z2", "D2", "4", 25, D(5)),
        ("R", "Z5", None, "3", 25, D(5)), ("R", "Z5", None, "3", 25, D(6)),
        ("R", None, None, "2", 25, D(7)), (TOTAL, None, None, "1", 25, D(8)),
    ], BENCH_SCHEMA)
    return em, bench


@pytest.mark.parametrize("level", ["district", "zone", "region", "nation"])
def test_t4_rewrite_equals_literal_outer_join_then_filter(t4_fixture, level):
    em, bench = t4_fixture
    cols = ("entity_id", "metric_id", "level_id", "b_value")
    fast = rows(cmp.level_matches(em, bench, level, TOTAL), *cols)
    literal = rows(cmp.level_matches_literal(em, bench, level, TOTAL), *cols)
    assert fast == literal


def test_t4_zone_outcomes(t4_fixture):
    em, bench = t4_fixture
    got = rows(cmp.level_matches(em, bench, "zone", TOTAL), "entity_id", "level_id")
    assert ("zone_row", "3") in got
    assert not any(g[0] == "deep_only" for g in got)
    assert ("nothing", None) in got and ("null_zone", None) in got
    assert got.count(("dup", "3")) == 2


# ---------------------------------------------------------------------------
# T5 / T12 / T7 / T13: dimension, ranking, mutation
# ---------------------------------------------------------------------------

HIST = ("entity_code string, dba_name string, legal_name string, region_name string, zone string, "
        "district string, manager string, svc_zone string, svc_district string, svc_manager string, "
        "period date, open_flag string")


@pytest.fixture(scope="module")
def dim_sources(spark):
    d1, d2 = dt.date(2017, 11, 30), dt.date(2017, 12, 31)
    hist = spark.createDataFrame([
        ("XX111111", None, "Legal A", "NORTH REGION", "Z", "D", "m", "sz", "sd", "sm", d2, "N"),   # F1 tie
        ("XX111111", "DBA A", "Legal A", "NORTH REGION", "Z", "D", "m", "sz", "sd", "sm", d2, "N"),
        ("XX111111", "Old", "Legal A", "NORTH REGION", "Z", "D", "m", "sz", "sd", "sm", d1, "N"),
        ("YY111111", "DBA B", "Legal B", "SOUTH REGION", "Z", "D", "m", "sz", "sd", "sm", d2, "N"),  # F2 suffix
        ("ZZ222222", "Closed", "Legal C", "SOUTH REGION", "Z", "D", "m", "sz", "sd", "sm", d2, "Y"),
    ], HIST)
    current = spark.createDataFrame([("XX111111", "lines-a")], "entity_code string, lines string")
    regions = spark.createDataFrame([("NORTH REGION", "NO")], "region_name string, region_short string")
    return hist, current, regions


def test_t5_t12_ties_kept_and_suffix_cut_after_ranking(dim_sources):
    hist, current, regions = dim_sources
    dim = entity_dimension(hist, current, regions, keep=F.col("open_flag") == "N", region_suffix=" REGION")
    got = rows(dim, "entity_id", "entity_name", "active", "region", "region_short", "rnk")
    assert got == sorted([
        ("111111", "Legal A", 1, "NORTH", "NO", 1),   # NULL dba name falls back to the legal name
        ("111111", "DBA A", 1, "NORTH", "NO", 1),     # rank tie kept
        ("111111", "DBA B", None, "SOUTH", None, 1),  # another long code with the same suffix survives
    ], key=repr)


def test_t7_ranking_order_is_a_parameter(dim_sources):
    hist, current, regions = dim_sources
    dim = entity_dimension(hist, current, regions, keep=F.col("open_flag") == "N",
                           order=[F.col("period").asc()])
    assert rows(dim, "entity_name") == sorted([("Old",), ("DBA B",)], key=repr)


def test_job2_activity_from_service_evidence(spark, dim_sources):
    hist, current, regions = dim_sources
    dim = entity_dimension(hist, current, regions, keep=F.col("open_flag") == "N")
    service = spark.createDataFrame([("111111", 0, 0, 3)],
                                    "entity_id string, repair_orders int, inspections_done int, menus_presented int")
    out = rows(infer_activity(dim, service), "entity_name", "active")
    assert ("DBA B", 0) in out and ("DBA A", 1) in out
    zero = spark.createDataFrame([("111111", 0, None, 0)],
                                 "entity_id string, repair_orders int, inspections_done int, menus_presented int")
    assert ("DBA B", None) in rows(infer_activity(dim, zero), "entity_name", "active")   # F4: stays unknown


def test_t13_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "k int, n int")
    assert rows(mu.delete_where(df, F.col("n") < 10), "k") == [(2,), (3,)]


def test_keyed_update_null_patch_sets_null(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    p = spark.createDataFrame([(1, None), (2, "B")], "k int, new_value string")
    assert rows(mu.keyed_update(t, p, "k", "v"), "k", "v") == [(1, None), (2, "B"), (3, "c")]


# ---------------------------------------------------------------------------
# T5 fan-out through a measure (F7), T6 integer average (F13), T8/F15 dates, T11 tie-breaks
# ---------------------------------------------------------------------------

def test_f7_group_by_measure_fans_out(spark):
    d = dt.date(2017, 12, 1)
    usage = spark.createDataFrame([
        ("e1", d, "v2", 5, 100), ("e1", d, "v1", 5, 100), ("e1", d, "v3", 1, 200),
        ("e2", dt.date(2017, 11, 1), "v9", 9, 100),
    ], "entity_id string, period date, vendor string, attributed_sales long, retail_sales int")
    got = rows(fx.participation(usage), "entity_id", "retail_sales", "attributed_sales", "vendor", "participation")
    # two rows for e1 (one per retail value), the older period is not the latest snapshot;
    # the top vendor tie (5 vs 5) is broken by the smaller vendor name
    assert got == sorted([("e1", 100, 10, "v1", 1), ("e1", 200, 1, "v1", 1)], key=repr)


def test_t6_integer_average_truncates(spark):
    df = spark.createDataFrame([(1,), (2,)], "x long")
    r = df.agg(agg.avg_expr(["x"], integer=True).alias("i"), agg.avg_decimal("x", 0).alias("d")).first()
    assert r["i"] == 1 and r["d"] == Decimal("2")


def test_f15_campaign_end_inclusive(spark):
    d = dt.date(2017, 12, 1)
    src = spark.createDataFrame([
        ("e1", d, 1, 1, dt.date(2017, 12, 31)), ("e1", d, 1, 1, dt.date(2018, 1, 1)),
    ], "entity_id string, period date, units_sold int, customers_contacted int, end_date date")
    got = fx.campaigns(src, "2017-12-31").first()
    assert got["customers_contacted"] == 1 and got["campaign_flag"] == "1"


def test_t8_latest_snapshot_per_table_and_empty(spark):
    df = spark.createDataFrame([(1, dt.date(2017, 1, 1)), (2, dt.date(2017, 2, 1)), (3, dt.date(2017, 2, 1))],
                               "k int, period date")
    assert rows(snapshot.latest_snapshot(df, "period"), "k") == [(2,), (3,)]
    assert snapshot.latest_snapshot(df.where("k > 10"), "period").count() == 0


def test_f11_manager_null_first_name_and_fanout(spark):
    dim = spark.createDataFrame([("e1", "D1")], "entity_id string, district string")
    emp = spark.createDataFrame([
        (None, "Smith", "Area Success Manager", "D1"), ("Ann", "Lee", "Area Success Lead", "D1"),
        ("Bob", "Ray", "Analyst", "D1"),
    ], "name_first string, name_last string, job string, district string")
    got = rows(fx.digital_managers(dim, emp, "Area Success"), "entity_id", "digital_manager")
    assert got == sorted([("e1", "Ann Lee"), ("e1", None)], key=repr)


# ---------------------------------------------------------------------------
# recommendations: only the rules fire, sequence 1..n per (entity, level)
# ---------------------------------------------------------------------------

def test_recommendation_rules_and_sequence(spark):
    em = spark.createDataFrame([
        ("e1", "R", "Z", "D", 26, D(10)), ("e1", "R", "Z", "D", 8, D(0)), ("e2", "R", "Z", "D", 26, D(90)),
    ], EM_SCHEMA)
    bench = spark.createDataFrame([("R", "Z", "D", "4", 26, D(50)), ("R", "Z", "D", "4", 8, D(50))], BENCH_SCHEMA)
    res = constants(spark, [(10, 26), (3, 8), (4, 10)], "resource_id int, metric_id int")
    got = rows(recommendations(em, bench, res, TOTAL, levels=("district",)),
               "entity_id", "level_id", "resource_id", "order_id")
    assert got == sorted([("e1", "4", 3, 1), ("e1", "4", 10, 2)], key=repr)


# ---------------------------------------------------------------------------
# an empty source -> catalogue row with NULL period, NULL footnote date, NULL tooltip
# ---------------------------------------------------------------------------

def test_f12_empty_source_gives_null_date_and_tooltip(spark):
    from scorewright.plans.annotate import SourceSpec, footnotes, source_catalogue, tooltips

    full = spark.createDataFrame([(dt.date(2017, 12, 1),)], "period date")
    empty = full.where("period IS NULL")
    catalog = source_catalogue([SourceSpec("Full", "origin A", full, "period", 3),
                                SourceSpec("Empty", "origin B", empty, "period", 4)])
    got = {r["metric"]: r for r in catalog.collect()}
    assert got["Full"]["period"] == dt.date(2017, 12, 1) and got["Empty"]["period"] is None
    assert got["Empty"]["order_id"] == 4
    notes = {r["footnote_name"]: r for r in footnotes(catalog).collect()}
    assert notes["Full"]["footnote_text"] == "Full Data Source: origin A  "
    assert notes["Full"]["footnote_date"] == "December 2017"
    assert notes["Empty"]["footnote_date"] is None
    names = constants(spark, [(8, "m8", "old"), (9, "m9", "old"), (34, "m34", "keep")],
                      "metric_id int, metric_name string, tooltip string")
    base = constants(spark, [(8, "m8", "Base eight"), (9, "m9", "Base nine")],
                     "metric_id int, metric_name string, tooltip string")
    out = {r["metric_id"]: r["tooltip"] for r in tooltips(spark, names, base, footnotes(catalog),
                                                          {8: "Full", 9: "Empty"}).collect()}
    assert out == {8: "Base eight December 2017", 9: None, 34: "keep"}
