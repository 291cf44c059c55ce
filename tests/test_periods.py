"""Latest periods from statistics, staged periods, and scalar subqueries (OP-02, OP-08, OP-29, OP-30, OP-38)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from scorewright.operators.joins import lookup
from scorewright.plans import facts as fx
from scorewright.plans import testbed
from scorewright.sources.sinks import Workspace
from scorewright.sources.snapshot import (
    DateColumn, DerivedPeriods, PeriodSource, StagedPeriods, latest_periods, latest_snapshot, period_after, scalar_value)

ROOT = "/root/testdata/sf0.001"


def dates(spark, values):
    return spark.createDataFrame([(v,) for v in values], "at timestamp_ntz")


def stamp(year, month=1, day=1):
    return dt.datetime(year, month, day, 5)


@pytest.mark.parametrize("grain", ["year", "month"])
def test_latest_period_equals_the_maximum(spark, grain):
    rng = random.Random(3)
    for rows in ([], [None], [stamp(1999, 12, 31)], [None, stamp(2001, 2), stamp(2000, 12, 31), stamp(2001, 1)],
                 [stamp(1990 + i) for i in range(60)], [stamp(2050 - i) for i in range(60)],
                 [stamp(rng.randrange(1990, 2020), rng.randrange(1, 13)) for _ in range(200)]):
        known = [r for r in rows if r]
        want = max(known).date().replace(day=1) if known else None
        want = want and (want.replace(month=1) if grain == "year" else want)
        column = DateColumn(dates(spark, rows), "at", grain, probe_rows=2)
        assert column.latest() == want
        if known:
            earlier = [r for r in known if r.date() < want]
            before = max(earlier).date().replace(day=1) if earlier else None
            assert column.latest(before=want) == (before and (before.replace(month=1) if grain == "year" else before))


def test_period_arithmetic():
    assert period_after(dt.date(1999, 12, 1), "month") == dt.date(2000, 1, 1)
    assert period_after(dt.date(1999, 1, 1), "year", 3) == dt.date(2002, 1, 1)
    assert period_after(dt.date(9999, 12, 1), "month") is None


def test_later_row_groups_are_asked_by_pushed_filters(spark):
    column = DateColumn(spark.read.parquet(f"{ROOT}/orders.parquet").select("o_orderdate"), "o_orderdate", "year")
    assert column.latest() == spark.read.parquet(f"{ROOT}/orders.parquet").selectExpr("max(trunc(to_date(o_orderdate), 'year'))").first()[0]
    later = column.table.where("o_orderdate IS NOT NULL").selectExpr("o_orderdate AS _at").where("_at >= DATE'2030-01-01'")
    assert "GreaterThanOrEqual(o_orderdate" in later._jdf.queryExecution().executedPlan().toString()


def source(spark, base, other, made):
    def rows(where):
        made.append(where)
        return base.where(where).join(other, "k").selectExpr("k", "trunc(CAST(at AS DATE), 'year') AS period")

    return PeriodSource(rows, "at", "year", DateColumn(base.select("at"), "at", "year"), complete=False)


def test_a_period_without_joined_rows_is_passed_over(spark):
    base = spark.createDataFrame([(1, stamp(2003)), (2, stamp(2002)), (3, stamp(2001)), (3, stamp(2001, 5))], "k int, at timestamp_ntz")
    other = spark.createDataFrame([(3,)], "k int")
    made = []
    src = source(spark, base, other, made)
    assert src.latest() == dt.date(2001, 1, 1) == src.frame().selectExpr("max(period)").first()[0]
    work = Workspace()
    staged = StagedPeriods(src, "staged", work)
    a, b = DerivedPeriods(staged, lambda df: df.select("k")), DerivedPeriods(staged, lambda df: df.groupBy("k").count())
    found = latest_periods({"a": (a, "period"), "b": (b, "period"), "c": (spark.range(3).selectExpr("id AS p"), "p")})
    assert found == {"a": dt.date(2001, 1, 1), "b": dt.date(2001, 1, 1), "c": 2}
    n = len(work.paths)
    assert a.at(found["a"]).count() == 2 and b.at(found["b"]).collect()[0]["count"] == 2 and len(work.paths) == n
    assert latest_snapshot(a, "period").count() == 2        # without a period given, the latest one's table
    work.release()


def test_no_rows_at_all(spark):
    base = spark.createDataFrame([(1, stamp(2003))], "k int, at timestamp_ntz")
    src = source(spark, base, spark.createDataFrame([], "k int"), [])
    assert src.latest() is None and latest_snapshot(src, "period", src.latest()).count() == 0


def test_only_the_years_in_use_are_staged(spark):
    src = testbed.sources(spark, ROOT)
    lines = src.usage.of
    years = {src.usage.latest(), src.service_entities.latest()}
    for y in years:
        src.inspections.at(y)
        src.loyalty.at(y)
    whole = testbed.line_orders_frame(spark, ROOT)
    assert set(lines._tables) == years
    for y in years:
        assert lines.at(y).exceptAll(whole.where(F.col("period") == F.lit(y))).count() == 0
        assert lines.at(y).count() == whole.where(F.col("period") == F.lit(y)).count() > 0
    src.work.release()


def test_scalar_value_of_several_rows_raises(spark):
    two = spark.range(2)
    assert spark.range(5).where(F.col("id") == scalar_value(two, F.max("id"))).count() == 1
    assert spark.range(5).where(F.col("id") == scalar_value(two.where("id > 9"), F.col("id"))).count() == 0
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        spark.range(5).where(F.col("id") == scalar_value(two, F.col("id"))).count()


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_correlated_lookup(spark, threshold, tmp_path):
    rows = spark.createDataFrame([("x", 1), ("y", 2), (None, 3), ("x", 4)], "k string, n int")
    for name, data in (("one", [("x", "v1"), ("z", "v2"), (None, "v3"), ("w", None), ("u", "a"), ("u", "b")]),
                       ("two", [("x", "v1"), ("x", "v1"), ("y", "v2")])):
        spark.createDataFrame(data, "k string, v string").write.parquet(str(tmp_path / name))
    one, two = (spark.read.parquet(str(tmp_path / n)) for n in ("one", "two"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
    try:
        out = lookup(rows, one, "k", "v")
        assert sorted(map(tuple, out.collect()), key=str) == sorted(
            [("x", 1, "v1"), ("y", 2, None), (None, 3, None), ("x", 4, "v1")], key=str)      # 'u' is repeated but not asked for
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        with pytest.raises(Exception, match="more than one row for k x"):
            lookup(rows, two, "k", "v").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_both_forms_of_participation_agree(spark):
    src = testbed.sources(spark, ROOT)
    year = src.usage.latest()
    a, b = (f(src.usage, year) for f in (fx.participation, fx.participation_by_lookup))
    assert a.exceptAll(b.select(a.columns)).count() == 0 and b.count() == a.count() > 0
    src.work.release()
