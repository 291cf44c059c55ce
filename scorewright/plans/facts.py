"""Fact builders feeding the wide table (JOB-12).

Every builder first restricts its source to the source's own latest period
(scalar-subquery filter), then aggregates to the entity key, so the wide
joins are key-to-key.  Input contracts are listed per function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewright.fixed import CAMPAIGN_FLAG, SHORT_CODE_LEN
from scorewright.functions import sql as S
from scorewright.operators.joins import left_join, lookup, spread_join
from scorewright.operators.windows import top1
from scorewright.sources.snapshot import SUBQUERY, as_of, latest_snapshot, rows_of


def top_vendor(usage: DataFrame, latest=SUBQUERY) -> DataFrame:
    """usage(entity_id, period, vendor, attributed_sales): the vendor with the most
    attributed sales per entity in the latest period (ties: smallest vendor)."""
    rows = latest_snapshot(usage, "period", latest)
    return top1(
        rows.select("entity_id", "vendor", "attributed_sales"),
        "entity_id",
        [F.col("attributed_sales").desc(), F.col("vendor").asc_nulls_last()],
    ).select("entity_id", "vendor")


def participation(usage: DataFrame, latest=SUBQUERY) -> DataFrame:
    """usage(entity_id, period, vendor, attributed_sales, retail_sales).

    Grouped by entity, retail_sales and period: an entity with several retail
    values in the period yields several rows (kept, as in the source).  The
    vendor is that of ``top_vendor``, found in the same pass: the rows are
    first summed per vendor, keeping the largest single sale, and the window
    over those few rows per entity leaves them clustered for the last sum.
    """
    rows = latest_snapshot(usage, "period", latest).where("entity_id IS NOT NULL")
    per_vendor = rows.groupBy("entity_id", "retail_sales", "period", "vendor").agg(
        F.expr("sum(attributed_sales) AS _sum"), F.expr("max(attributed_sales) AS _best"))
    w = Window.partitionBy("entity_id").orderBy(F.col("_best").desc(), F.col("vendor").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    top = per_vendor.withColumn("_top", F.first("vendor").over(w))
    return top.groupBy("entity_id", "retail_sales", "period", "_top").agg(
        F.expr("sum(_sum) AS attributed_sales")).selectExpr(
        "period", "entity_id", "attributed_sales", "1 AS participation", "retail_sales", "_top AS vendor")


def participation_by_lookup(usage: DataFrame, latest=SUBQUERY) -> DataFrame:
    """``participation`` as the source states it: the vendor is a correlated scalar subquery per grouped row."""
    rows = latest_snapshot(usage, "period", latest).where("entity_id IS NOT NULL")
    grouped = rows.groupBy("entity_id", "retail_sales", "period").agg(F.expr("sum(attributed_sales) AS attributed_sales"))
    return lookup(grouped, top_vendor(usage, latest), "entity_id", "vendor").selectExpr(
        "period", "entity_id", "attributed_sales", "1 AS participation", "retail_sales", "vendor")


def opportunity(src: DataFrame, latest=SUBQUERY) -> DataFrame:
    """src(entity_id, period, favour_brand, favour_undecided, count_new, count_mine,
    count_old, count_any): the latest snapshot rows as they are (duplicates kept)."""
    return latest_snapshot(src, "period", latest).select(
        "period", "entity_id", "favour_brand", "favour_undecided",
        "count_new", "count_mine", "count_old", "count_any",
    )


def campaigns(src: DataFrame, report_date, latest=SUBQUERY) -> DataFrame:
    """src(entity_id, period, units_sold, customers_contacted, end_date): campaigns
    of the latest period that ended on or before the report date, summed per entity."""
    rows = as_of(latest_snapshot(src, "period", latest), "end_date", report_date)
    # One period remains after the snapshot filter, so grouping by the entity alone
    # equals grouping by (period, entity) and leaves the output hash-partitioned
    # by the wide table's join key: no second exchange before that join.
    return rows.groupBy("entity_id").agg(
        F.expr("max(period) AS period"),
        F.expr(f"{S.lit(CAMPAIGN_FLAG)} AS campaign_flag"),
        F.expr("sum(units_sold) AS units_sold"),
        F.expr("sum(customers_contacted) AS customers_contacted"),
    ).selectExpr("period", "entity_id", "campaign_flag", "units_sold", "customers_contacted")


def service(entities: DataFrame, orders: DataFrame, inspections: DataFrame, latest=SUBQUERY) -> DataFrame:
    """entities(entity_id, period), orders(entity_id, period, repair_orders),
    inspections(entity_id, period, inspections_done, menus_presented).

    The latest period of ``entities`` decides; the other two must match both
    entity and period; missing measures become 0.
    """
    d = latest_snapshot(entities, "period", latest).select("entity_id", "period")
    if latest is not SUBQUERY:      # only that period can match: read no other
        orders, inspections = (latest_snapshot(x, "period", latest) for x in (orders, inspections))
    orders, inspections = rows_of(orders), rows_of(inspections)
    out = left_join(d, orders.select("entity_id", "period", "repair_orders"), ["entity_id", "period"])
    out = left_join(out, inspections.select("entity_id", "period", "inspections_done", "menus_presented"),
                    ["entity_id", "period"])
    return out.selectExpr(
        "period", "entity_id",
        "coalesce(repair_orders, 0) AS repair_orders",
        "coalesce(inspections_done, 0) AS inspections_done",
        "coalesce(menus_presented, 0) AS menus_presented",
    )


def visit_sales(src: DataFrame, short_len: int = SHORT_CODE_LEN, latest=SUBQUERY) -> DataFrame:
    """src(entity_code, period, visit_households, visit_sales): long codes cut to the short code."""
    return latest_snapshot(src, "period", latest).selectExpr(
        "period", f"{S.right('entity_code', short_len)} AS entity_id", "visit_households", "visit_sales",
    )


def advocates(src: DataFrame, latest=SUBQUERY) -> DataFrame:
    """src(entity_id, period, advocate_name): the greatest name per entity.

    MAX over a string buffer is planned as a sort-based aggregate.  The rows
    are first collapsed to distinct (entity, name) pairs by a hash aggregate
    (map-side combine), so the sort-based step only sees each entity's
    distinct names, however many raw rows a hot entity has.
    """
    rows = latest_snapshot(src, "period", latest)
    pairs = rows.groupBy("entity_id", "advocate_name").agg(F.expr("max(period) AS period"))
    return pairs.groupBy("entity_id").agg(
        F.expr("max(advocate_name) AS advocate"), F.expr("max(period) AS period"),
    )


def digital_managers(dim: DataFrame, employees: DataFrame, title_prefix: str) -> DataFrame:
    """employees(name_first, name_last, job, district): managers whose job title starts
    with ``title_prefix``, matched to entities by district name.

    The employee table is joined on a key with few values: Spark broadcasts it
    while it is small, and beyond that a district's entities are spread over
    tasks (``spread_join``).  Several managers per district multiply rows.
    """
    emp = employees.selectExpr(
        f"{S.concat_null('name_first', S.lit(' '), 'name_last')} AS digital_manager",
        "job", "district AS _emp_district",
    )
    # LEFT JOIN ... WHERE job LIKE 'prefix%': the predicate rejects NULL-extended
    # rows, so Catalyst plans an inner join and pushes the filter into the employee side.
    joined = spread_join(dim, emp, "district = _emp_district", "entity_id").where(F.col("job").startswith(title_prefix))
    return joined.selectExpr("entity_id", "digital_manager", "job", "_emp_district AS district")


def loyalty(src: DataFrame, latest=SUBQUERY) -> DataFrame:
    """src(entity_id, period, loyal_returns, market_returns): summed per entity in the latest period."""
    rows = latest_snapshot(src, "period", latest).where("entity_id IS NOT NULL")
    # single period after the snapshot filter: group by the entity (see campaigns)
    return rows.groupBy("entity_id").agg(
        F.expr("max(period) AS period"),
        F.expr("sum(loyal_returns) AS loyal_returns"), F.expr("sum(market_returns) AS market_returns"),
    )


def enrollment(src: DataFrame, latest=SUBQUERY) -> DataFrame:
    """src(entity_id, period, enrolled_ref): 'Y' when a reference is present, else 'N'."""
    return latest_snapshot(src, "period", latest).selectExpr(
        "period", "entity_id", "CASE WHEN enrolled_ref IS NOT NULL THEN 'Y' ELSE 'N' END AS enrolled",
    )
