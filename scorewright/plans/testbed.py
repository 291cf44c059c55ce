"""Maps the driver's TPC-H-style tables onto the report's source contracts.

Entity = customer.  Long code = 'Customer#' + the key, zero-padded to 9 digits
(== c_name); the entity key is its last 19 characters, which hold every digit of
any key, so that no two customers share one.  Hierarchy: region = r_name, zone = n_name,
district = c_mktsegment.  Periods are calendar years of order/ship dates
(months for events), so "latest snapshot" means the latest year.

Every source is derived from the given tables by Spark, so its size grows
with the scale factor.  The only staged table is ``line_orders`` (lineitem
joined to its order's customer): three sources read it, so each year that a
report asks for is joined once and written to the shared checkpoint folder;
``ReportSources.work`` releases it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.plans.catalogue import RESOURCE_METRIC_MAP, standard_catalogue
from scorewright.plans.dimension import HistorySource
from scorewright.plans.report import ReportConfig, ReportSources
from scorewright.sources.sinks import Workspace
from scorewright.sources.snapshot import DateColumn, DerivedPeriods, PeriodSource, StagedPeriods
from scorewright.sources.tables import constants, scan

REPORT_DATE = "2001-06-30"
TOTAL_LABEL = "ALL REGIONS"
MANAGER_PREFIX = "Area Success"
SHORT_CODE_LEN = 19         # digits of the longest key
REGION_SUFFIX = " REGION"   # the testbed appends it to region names; the dimension removes it
ENROLLMENT_PERIOD = _dt.date(2001, 12, 31)
E0_NULL_DISTRICT = "MACHINERY"
E0_NULL_REGION = "ASIA"

SOURCE_LABELS = (
    ("Participation", "Line items", "participation", 3),
    ("Service", "Orders and line items", "service", 4),
    ("Visits", "Orders", "visit_sales", 5),
    ("Loyalty", "Line items", "loyalty", 9),
    ("Enrollment", "Customers", "enrollment", 11),
    ("Campaigns", "Orders", "campaigns", 13),
)
TOOLTIP_SOURCES = {8: "Participation", 9: "Campaigns", 14: "Campaigns", 15: "Service",
                   25: "Visits", 26: "Loyalty", 27: "Participation", 28: "Campaigns"}



def long_code_sql(c: str) -> str:
    """c_name of a customer key; longer keys are never cut."""
    k = f"CAST({c} AS STRING)"
    return f"concat('Customer#', repeat('0', greatest(9 - length({k}), 0)), {k})"


def code_sql(c: str) -> str:
    """Entity key of a customer key."""
    return f"right({long_code_sql(c)}, {SHORT_CODE_LEN})"


def code(c: str) -> Column:
    return F.expr(code_sql(c))


NAME_CODE = f"right(c_name, {SHORT_CODE_LEN})"


def year_sql(c: str) -> str:
    return f"trunc(to_date({c}), 'year')"


def month_sql(c: str) -> str:
    return f"trunc(to_date({c}), 'month')"


def year_of(c: str) -> Column:
    return F.expr(year_sql(c))


def month_of(c: str) -> Column:
    return F.expr(month_sql(c))


def geography(spark: SparkSession, root: str) -> DataFrame:
    """customer with its zone (nation) and region names.

    nation and region are TPC-H dimensions of 25 and 5 rows at every scale
    factor; Spark sees their file sizes and broadcasts them.
    """
    n = scan(spark, "nation", ["n_nationkey", "n_name", "n_regionkey"], root)
    r = scan(spark, "region", ["r_regionkey", "r_name"], root)
    geo = n.join(r, F.expr("n_regionkey = r_regionkey")).select("n_nationkey", "n_name", "r_name")
    c = scan(spark, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"], root)
    return c.join(geo, F.expr("c_nationkey = n_nationkey")).drop("n_nationkey")


def entities(spark: SparkSession, root: str, null_keys: bool = False) -> DataFrame:
    """E: entity_id, region, zone, district (E0 when ``null_keys``: some NULL districts/regions)."""
    g = geography(spark, root)
    region, district = "r_name", "c_mktsegment"
    if null_keys:
        region = f"CASE WHEN r_name <> '{E0_NULL_REGION}' THEN r_name END"
        district = f"CASE WHEN c_mktsegment <> '{E0_NULL_DISTRICT}' THEN c_mktsegment END"
    return g.selectExpr("c_custkey AS custkey", f"{NAME_CODE} AS entity_id", f"{region} AS region",
                        "n_name AS zone", f"{district} AS district")


def history(spark: SparkSession, root: str) -> HistorySource:
    """One record per order (four columns), with the customer's names joined to those that are left after ranking."""
    records = scan(spark, "orders", ["o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"], root).selectExpr(
        "o_custkey", "to_date(o_orderdate) AS period", "o_orderpriority <> '5-LOW' AS has_dba",
        "CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS open_flag")

    def complete(df: DataFrame) -> DataFrame:
        g = geography(spark, root)
        more = [c for c in df.columns if c not in ("o_custkey", "has_dba", "period", "open_flag")]
        return df.join(g, F.expr("o_custkey = c_custkey")).selectExpr(
            "c_name AS entity_code",
            "CASE WHEN has_dba THEN concat('Store ', right(c_name, 6)) END AS dba_name",
            "c_name AS legal_name",
            f"concat(r_name, '{REGION_SUFFIX}') AS region_name",
            "n_name AS zone",
            "c_mktsegment AS district",
            "concat('Manager ', n_name, ' ', c_mktsegment) AS manager",
            "n_name AS svc_zone",
            "c_mktsegment AS svc_district",
            "concat('Service ', n_name) AS svc_manager",
            "period", "open_flag", *more,
        )

    return HistorySource(records, "o_custkey", complete)


def current(spark: SparkSession, root: str) -> DataFrame:
    c = scan(spark, "customer", ["c_name", "c_mktsegment", "c_acctbal"], root)
    return c.where("c_acctbal >= 0").selectExpr("c_name AS entity_code", "c_mktsegment AS lines")


def regions(spark: SparkSession, root: str) -> DataFrame:
    r = scan(spark, "region", ["r_name"], root)
    return r.selectExpr(f"concat(r_name, '{REGION_SUFFIX}') AS region_name", "substring(r_name, 1, 3) AS region_short")


def line_orders_frame(spark: SparkSession, root: str, where: str = "TRUE") -> DataFrame:
    """Line items that satisfy ``where``, joined to their order's customer."""
    li = scan(spark, "lineitem", ["l_orderkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate"], root).where(where)
    o = scan(spark, "orders", ["o_orderkey", "o_custkey"], root)
    return li.join(o, F.expr("l_orderkey = o_orderkey")).selectExpr(
        f"{code_sql('o_custkey')} AS entity_id",
        f"{year_sql('l_shipdate')} AS period",
        "concat('Vendor ', CAST(l_suppkey AS STRING)) AS vendor",
        "CAST(l_quantity AS BIGINT) AS quantity",
        "l_returnflag AS return_flag",
        # one retail figure per customer: (last digit of the key + 1) * 100
        "(CAST(right(CAST(o_custkey AS STRING), 1) AS INT) + 1) * 100 AS retail_sales",
    )


def line_orders(spark: SparkSession, root: str, work: Workspace) -> StagedPeriods:
    """lineitem x orders by ship year; a year that is asked for is joined once and written to the shared folder.

    The year is a range of ``l_shipdate`` below the join, so no other year is shuffled or written.
    """
    shipped = DateColumn(scan(spark, "lineitem", ["l_shipdate"], root), "l_shipdate", "year")
    # a line without its order has no row: the latest ship year counts only if the join has rows
    source = PeriodSource(lambda where: line_orders_frame(spark, root, where), "l_shipdate", "year", shipped, complete=False)
    return StagedPeriods(source, "line-orders", work)


def usage(lines: DataFrame) -> DataFrame:
    return lines.selectExpr("entity_id", "period", "vendor", "quantity AS attributed_sales", "retail_sales")


def inspections(lines: DataFrame) -> DataFrame:
    return lines.groupBy("entity_id", "period").agg(
        F.expr("count(CASE WHEN return_flag = 'R' THEN 1 END) AS inspections_done"),
        F.expr("count(1) AS menus_presented"),
    )


def loyalty_src(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(
        "entity_id", "period", "CASE WHEN return_flag = 'N' THEN 1 ELSE 0 END AS loyal_returns",
        "1 AS market_returns",
    )


def _events(spark, root, where):
    return scan(spark, "events", ["user_id", "ts", "event_type"], root).where(where)


def opportunity_src(spark, root, where="TRUE"):
    e = _events(spark, root, where).selectExpr(f"{code_sql('user_id')} AS entity_id", f"{month_sql('ts')} AS period",
                                               "event_type")
    cnt = lambda t, name: F.expr(f"count(CASE WHEN event_type = '{t}' THEN 1 END) AS {name}")
    return e.groupBy("entity_id", "period").agg(
        cnt("purchase", "favour_brand"), cnt("click", "favour_undecided"), cnt("view", "count_new"),
        cnt("signup", "count_mine"), cnt("error", "count_old"), F.expr("count(1) AS count_any"),
    )


def advocates_src(spark, root, where="TRUE"):
    return _events(spark, root, where).selectExpr(f"{code_sql('user_id')} AS entity_id", f"{month_sql('ts')} AS period",
                                                  "concat('Advocate ', upper(event_type)) AS advocate_name")


def _orders(spark, root, where):
    return scan(spark, "orders", ["o_custkey", "o_orderstatus", "o_orderdate"], root).where(where)


def campaigns_src(spark, root, where="TRUE"):
    return _orders(spark, root, where).selectExpr(
        f"{code_sql('o_custkey')} AS entity_id", f"{year_sql('o_orderdate')} AS period",
        "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS units_sold", "1 AS customers_contacted",
        "to_date(o_orderdate) AS end_date",
    )


def service_orders(spark, root, where="TRUE"):
    o = _orders(spark, root, where).selectExpr(f"{code_sql('o_custkey')} AS entity_id",
                                               f"{year_sql('o_orderdate')} AS period")
    return o.groupBy("entity_id", "period").agg(F.expr("count(1) AS repair_orders"))


def service_entities(spark, root, where="TRUE"):
    return service_orders(spark, root, where).select("entity_id", "period")


def visits_src(spark, root, where="TRUE"):
    o = _orders(spark, root, where).selectExpr(f"{long_code_sql('o_custkey')} AS entity_code",
                                               f"{year_sql('o_orderdate')} AS period", "o_orderstatus")
    return o.groupBy("entity_code", "period").agg(
        F.expr("count(1) AS visit_households"),
        F.expr("count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS visit_sales"),
    )


def employees(spark, root):
    # the name of each segment's smallest key: a hash aggregate on a long
    c = scan(spark, "customer", ["c_custkey", "c_mktsegment"], root)
    return c.groupBy("c_mktsegment").agg(F.expr(f"{long_code_sql('min(c_custkey)')} AS name_last")).selectExpr(
        "CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'Agent' END AS name_first",
        "name_last",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Field Analyst' ELSE 'Area Success Manager' END AS job",
        "c_mktsegment AS district",
    )


def enrollment_src(spark, root):
    c = scan(spark, "customer", ["c_name", "c_acctbal"], root)
    return c.selectExpr(
        f"{NAME_CODE} AS entity_id",
        f"DATE '{ENROLLMENT_PERIOD.isoformat()}' AS period",
        "CASE WHEN c_acctbal > 5000 THEN concat('EN-', right(c_name, 6)) END AS enrolled_ref",
    )


def metric_names(spark):
    """Config: one row per KPI id and per id the resource map names (generated names)."""
    ids = sorted(set(standard_catalogue().ids) | {m for _, m in RESOURCE_METRIC_MAP})
    return constants(spark, [(i, f"Metric {i}", None) for i in ids], "metric_id int, metric_name string, tooltip string")


def resource_map(spark):
    return constants(spark, list(RESOURCE_METRIC_MAP), "resource_id int, metric_id int")


def resource_links(spark):
    return constants(spark, [(i, f'<a href="#resource-{i}">Resource {i}</a>') for i in range(1, 16)],
                     "resource_id int, resource_html string")


def tooltip_table(spark):
    return constants(spark, [(k.metric_id, f"Metric {k.metric_id}", f"{k.name} as of")
                             for k in standard_catalogue().kpis],
                     "metric_id int, metric_name string, tooltip string")


def sources(spark: SparkSession, root: str) -> ReportSources:
    work = Workspace()
    lines = line_orders(spark, root, work)
    ordered = DateColumn(scan(spark, "orders", ["o_orderdate"], root), "o_orderdate", "year")
    seen = DateColumn(scan(spark, "events", ["ts"], root), "ts", "month")

    def dated(make, column: DateColumn) -> PeriodSource:
        return PeriodSource(lambda where: make(spark, root, where), column.date, column.grain, column)

    return ReportSources(
        history=history(spark, root), current=current(spark, root), regions=regions(spark, root),
        usage=DerivedPeriods(lines, usage), opportunity=dated(opportunity_src, seen),
        campaigns=dated(campaigns_src, ordered),
        service_entities=dated(service_entities, ordered),
        service_orders=dated(service_orders, ordered),
        inspections=DerivedPeriods(lines, inspections), visits=dated(visits_src, ordered),
        advocates=dated(advocates_src, seen),
        employees=employees(spark, root), loyalty=DerivedPeriods(lines, loyalty_src), enrollment=enrollment_src(spark, root),
        metric_names=metric_names(spark), resource_map=resource_map(spark), resource_links=resource_links(spark),
        tooltips=tooltip_table(spark), work=work,
    )


def config(**overrides) -> ReportConfig:
    base = dict(
        report_date=REPORT_DATE, total_label=TOTAL_LABEL, manager_title_prefix=MANAGER_PREFIX,
        keep=F.col("open_flag") == "N", region_suffix=REGION_SUFFIX, short_code_len=SHORT_CODE_LEN,
        source_labels=SOURCE_LABELS, tooltip_sources=TOOLTIP_SOURCES,
    )
    base.update(overrides)
    return ReportConfig(**base)
