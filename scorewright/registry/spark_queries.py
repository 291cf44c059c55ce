"""Spark side of the registry: each entry is (spark, sf_dir) -> DataFrame over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scorewright.plans import report, testbed
from scorewright.registry.present import present

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

_reports: dict[tuple[str, str], report.Report] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = lambda spark, root: present(fn(spark, root))
        QUERIES[name].__name__ = name
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


_sources: dict = {}
_e0: dict = {}


def state_key(spark: SparkSession, root: str) -> tuple:
    """Session, folder and the sizes and times of its tables: changed tables are read again."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    tables = tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))
    return app_id(spark), root, tables


def forget_old(key: tuple) -> None:
    """Release what is held for an earlier state of the folder that ``key`` describes (or for an ended session)."""
    for held, work in ((_reports, lambda r: r.work), (_sources, lambda s: s.work), (_e0, lambda e: e[2])):
        for old in [k for k in held if k != key and (k[1] == key[1] or k[0] != key[0])]:
            gone = held.pop(old)
            if old[0] == key[0]:
                work(gone).release()


def rep_sources(spark: SparkSession, root: str) -> report.ReportSources:
    key = state_key(spark, root)
    if key not in _sources:
        forget_old(key)
        _sources[key] = testbed.sources(spark, root)
    return _sources[key]


def full_report(spark: SparkSession, root: str) -> report.Report:
    """The whole report over the driver tables, built once per session and state of the folder."""
    key = state_key(spark, root)
    if key not in _reports:
        _reports[key] = report.build(spark, rep_sources(spark, root), testbed.config())
    return _reports[key]


@register("job_scorecard")
def job_scorecard(spark, root):
    """JOB-6 (flagship): every entity KPI against its district, zone, region and total benchmark."""
    return full_report(spark, root).scorecard


# ---------------------------------------------------------------------------
# shared pieces over the driver tables
# ---------------------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from scorewright import functions as fn  # noqa: E402
from scorewright.functions import sql as S  # noqa: E402
from scorewright.operators import aggregate as agg  # noqa: E402
from scorewright.operators import joins as jn  # noqa: E402
from scorewright.operators import mutate as mu  # noqa: E402
from scorewright.operators import reshape as rs  # noqa: E402
from scorewright.operators import windows as wn  # noqa: E402
from scorewright.plans import catalogue as cat  # noqa: E402
from scorewright.plans import compare as cmp  # noqa: E402
from scorewright.plans import facts as fx  # noqa: E402
from scorewright.plans import metrics as mt  # noqa: E402
from scorewright.plans import recommend as rc  # noqa: E402
from scorewright.session import app_id, scratch_path  # noqa: E402
from scorewright.sources import sinks, snapshot, tables  # noqa: E402


def E(spark, root, null_keys=False):
    return testbed.entities(spark, root, null_keys)


def O(spark, root):
    """Latest order year per customer: n_orders, n_filled (customers without one are absent)."""
    o = tables.scan(spark, "orders", ["o_custkey", "o_orderstatus", "o_orderdate"], root)
    latest = snapshot.latest_in_grain(o, "o_orderdate", "year")
    return latest.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("n_filled"),
    )


def V(spark, root):
    """Event counts per user (150 users at sf0.01: NULLs for everyone else after a left join)."""
    e = tables.scan(spark, "events", ["user_id", "event_type"], root)
    cnt = lambda t: F.count(F.when(F.col("event_type") == t, 1))
    return e.groupBy(F.col("user_id").alias("custkey")).agg(
        cnt("purchase").alias("purchases"), cnt("click").alias("clicks"),
        cnt("view").alias("views"), cnt("signup").alias("signups"),
    )


def K(spark):
    """The KPI catalogue as an inline relation."""
    c = cat.standard_catalogue()
    return tables.constants(spark, [(k.metric_id, k.name, k.entity_display, k.colour) for k in c.kpis],
                            "metric_id int, kpi_name string, display string, colour_rule string")


def e0_report(spark, root):
    """Entity metrics and benchmarks over the E0 hierarchy (NULL districts and regions)."""
    key = state_key(spark, root)
    if key not in _e0:
        wide = full_report(spark, root).wide
        w0 = wide.withColumn("region", F.when(F.col("region") != testbed.E0_NULL_REGION, F.col("region"))) \
            .withColumn("district", F.when(F.col("district") != testbed.E0_NULL_DISTRICT, F.col("district")))
        c, work = cat.standard_catalogue(), sinks.Workspace()
        em = sinks.materialise(mt.entity_metrics(w0, c), "table", "e0-entity-metrics", work)
        bench = sinks.materialise(mt.benchmark_metrics(w0, c, testbed.TOTAL_LABEL), "table", "e0-benchmarks", work)
        _e0[key] = (em, bench, work)
    return _e0[key][:2]


# ---------------------------------------------------------------------------
# A. sources, sinks, table mutation
# ---------------------------------------------------------------------------

@register("scan_project")
def scan_project(spark, root):
    """OP-01: scan a table, three of its columns (pruned ReadSchema)."""
    return tables.scan(spark, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"], root)


@register("latest_snapshot")
def latest_snapshot_q(spark, root):
    """OP-02: order rows of the table's own latest year (a bound on the date column that reaches the scan)."""
    o = tables.scan(spark, "orders", ["o_orderkey", "o_custkey", "o_orderdate"], root)
    return snapshot.latest_in_grain(o, "o_orderdate", "year").select(
        "o_orderkey", "o_custkey", testbed.year_of("o_orderdate").alias("period"))


@register("as_of_filter")
def as_of_filter(spark, root):
    """OP-03: campaign rows that ended on or before the report date (inclusive)."""
    src = testbed.campaigns_src(spark, root)
    return snapshot.as_of(src, "end_date", testbed.REPORT_DATE).select("entity_id", "period", "end_date", "units_sold")


@register("inline_mapping")
def inline_mapping(spark, root):
    """OP-04: the KPI catalogue as an inline relation joined to the entity KPI rows."""
    em = full_report(spark, root).entity_metrics
    k = K(spark)
    j = em.join(k, on="metric_id", how="inner")
    return j.groupBy("display").agg(F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values"))


@register("source_catalog")
def source_catalogue_q(spark, root):
    """OP-05: typed source catalogue: six one-row global aggregates appended."""
    return full_report(spark, root).source_catalogue


@register("overwrite_roundtrip")
def overwrite_roundtrip(spark, root):
    """OP-06: full-refresh sink: write the header table twice (overwrite), read it back."""
    path = scratch_path(spark, "header-sink")
    hdr = full_report(spark, root).header
    sinks.overwrite(hdr, path)
    sinks.overwrite(hdr, path)
    return sinks.read_back(spark, path)


@register("append_levels")
def append_levels(spark, root):
    """OP-07: the four level comparisons appended with one column list, counted per level and KPI."""
    rep = full_report(spark, root)
    parts = [cmp.level_matches(rep.entity_metrics, rep.benchmarks, lv, testbed.TOTAL_LABEL) for lv in cmp.LEVELS]
    allv = sinks.append_all(parts, ["entity_id", "metric_id", "level_id"])
    return allv.groupBy("level_id", "metric_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("materialised_reuse")
def materialised_reuse(spark, root):
    """OP-08: one materialised intermediate read by two consumers."""
    em = full_report(spark, root).entity_metrics  # cached
    filled = em.where(F.col("value").isNotNull()).groupBy("metric_id").agg(F.count(F.lit(1)).alias("n_values"))
    empty = em.where(F.col("value").isNull()).groupBy("metric_id").agg(F.count(F.lit(1)).alias("n_nulls"))
    return filled.join(empty, on="metric_id", how="full")


@register("delete_where")
def delete_where_q(spark, root):
    """OP-09: DELETE WHERE n_events < 60 keeps customers whose predicate is UNKNOWN (no events)."""
    c = tables.scan(spark, "customer", ["c_custkey"], root)
    ev = tables.scan(spark, "events", ["user_id"], root).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    j = c.join(ev, c["c_custkey"] == ev["user_id"], "left").select("c_custkey", "n_events")
    return mu.delete_where(j, F.col("n_events") < 60)


@register("fill_if_exists")
def fill_if_exists_q(spark, root):
    """OP-10: active = 0 where unknown and the customer has a purchase event."""
    c = tables.scan(spark, "customer", ["c_custkey", "c_acctbal"], root) \
        .select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.lit(1)).alias("active"))
    ev = tables.scan(spark, "events", ["user_id", "event_type"], root).where(F.col("event_type") == "purchase")
    return mu.fill_if_exists(c, "active", 0, ev, "c_custkey", "user_id")


@register("with_sequence")
def with_sequence_q(spark, root):
    """OP-11: 1..n per order by supplier then line number, written as a column (no second pass)."""
    li = tables.scan(spark, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"], root)
    return wn.with_sequence(li, ["l_orderkey"], [F.col("l_suppkey").asc(), F.col("l_linenumber").asc()], "seq") \
        .select("l_orderkey", "l_linenumber", "seq")


@register("keyed_update")
def keyed_update_q(spark, root):
    """OP-12: customer label replaced from a keyed patch; a matched NULL patch value sets NULL."""
    c = tables.scan(spark, "customer", ["c_custkey", "c_mktsegment"], root) \
        .select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("label"))
    ev = tables.scan(spark, "events", ["user_id", "event_type"], root)
    # distinct (user, type) pairs first (hash aggregate), then the string max per user
    pairs = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("_n"))
    patch = pairs.groupBy(F.col("user_id").alias("custkey")).agg(F.max("event_type").alias("_m")) \
        .select("custkey", F.when(F.col("_m") != "view", F.col("_m")).alias("new_value"))
    return mu.keyed_update(c, patch, "custkey", "label")


@register("join_self")
def join_self(spark, root):
    """OP-31: the self-join on a row key replaced by a window column, joined back on the unique key."""
    o = tables.scan(spark, "orders", ["o_orderkey", "o_custkey"], root)
    seq = wn.with_sequence(o, ["o_custkey"], [F.col("o_orderkey").asc()], "seq").select("o_orderkey", "seq")
    return o.join(seq, on="o_orderkey", how="inner")


# ---------------------------------------------------------------------------
# B. projection, filter, predicates
# ---------------------------------------------------------------------------

@register("project_constants")
def project_constants(spark, root):
    """OP-13: rename, constant columns and typed NULL placeholders."""
    o = tables.scan(spark, "orders", ["o_orderkey", "o_orderstatus"], root)
    return o.select(F.col("o_orderkey").alias("order_id"), F.lit("Footer").alias("kind"),
                    F.lit(None).cast("string").alias("note"), F.col("o_orderstatus").alias("status"),
                    F.lit(1).alias("one"))


@register("case_searched")
def case_searched(spark, root):
    """OP-14: searched CASE, first match wins, no ELSE -> NULL."""
    li = tables.scan(spark, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"], root)
    bucket = (F.when(F.col("l_quantity") >= 40, F.lit("large"))
              .when(F.col("l_quantity") >= 20, F.lit("medium"))
              .when(F.col("l_returnflag") == "R", F.lit("small returned")))
    return li.select("l_orderkey", "l_linenumber", bucket.alias("bucket"))


@register("case_simple")
def case_simple(spark, root):
    """OP-15: simple CASE as a name -> id dispatch (literal map, folded into codegen)."""
    o = tables.scan(spark, "orders", ["o_orderstatus"], root)
    ids = F.create_map(F.lit("F"), F.lit(1), F.lit("O"), F.lit(2), F.lit("P"), F.lit(3))
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")) \
        .select("o_orderstatus", F.element_at(ids, F.col("o_orderstatus")).alias("status_id"), "n")


@register("filter_col_eq_col")
def filter_col_eq_col(spark, root):
    """OP-16: column = column after the order-key join."""
    li = tables.scan(spark, "lineitem", ["l_orderkey", "l_linenumber", "l_linestatus"], root)
    o = tables.scan(spark, "orders", ["o_orderkey", "o_orderstatus"], root)
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.where(F.col("l_linestatus") == F.col("o_orderstatus")).select("l_orderkey", "l_linenumber")


@register("filter_range")
def filter_range(spark, root):
    """OP-17: <, <=, >=, > and <> (pushed to the parquet scan)."""
    li = tables.scan(spark, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"],
                     root)
    return li.where((F.col("l_quantity") >= 10) & (F.col("l_quantity") < 20) & (F.col("l_returnflag") != "N")
                    & (F.col("l_shipdate") <= F.lit("1998-12-31").cast("timestamp_ntz"))
                    & (F.col("l_linenumber") > 1)) \
        .select("l_orderkey", "l_linenumber", "l_quantity")


@register("filter_in")
def filter_in(spark, root):
    """OP-18: IN list; a NULL district is not in the list."""
    return E(spark, root, null_keys=True).where(F.col("district").isin("BUILDING", "MACHINERY")) \
        .select("entity_id", "district")


@register("filter_like_prefix")
def filter_like_prefix(spark, root):
    """OP-19: LIKE 'prefix%'."""
    p = tables.scan(spark, "part", ["p_partkey", "p_type"], root)
    return p.where(F.col("p_type").like("S%")).select("p_partkey", "p_type")


@register("filter_nulls")
def filter_nulls(spark, root):
    """OP-20: IS NULL / IS NOT NULL over the E0 hierarchy."""
    e = E(spark, root, null_keys=True)
    return e.where(F.col("district").isNull() | F.col("region").isNull()).select("entity_id", "region", "district")


@register("predicate_3vl")
def predicate_3vl(spark, root):
    """OP-21: (a AND b) OR c under three-valued logic, parenthesised as SQL parses it."""
    e = E(spark, root, null_keys=True)
    p = ((F.col("district") == "BUILDING") & (F.col("region") != "AFRICA")) | F.col("district").isNull()
    return e.select("entity_id", F.when(p, F.lit("N")).otherwise(F.lit("-")).alias("flag"),
                    (~p).alias("negated"))


# ---------------------------------------------------------------------------
# C. joins
# ---------------------------------------------------------------------------

@register("join_left")
def join_left(spark, root):
    """OP-22: entities LEFT JOIN their latest-year order counts (NULL where absent)."""
    return jn.left_join(E(spark, root), O(spark, root), "custkey").select("entity_id", "n_orders", "n_filled")


@register("join_left_composite")
def join_left_composite(spark, root):
    """OP-23: service entities LEFT JOIN orders and inspections on (entity, period), missing -> 0."""
    return full_report(spark, root).facts.service


@register("join_widen")
def join_widen(spark, root):
    """OP-24: three pre-aggregated facts left-joined onto the entity spine on one key."""
    li = testbed.line_orders_frame(spark, root)
    L = li.groupBy(F.col("entity_id")).agg(F.sum("quantity").alias("quantity"),
                                           F.count(F.when(F.col("return_flag") == "R", 1)).alias("returned"))
    e = E(spark, root)
    o = O(spark, root).withColumn("entity_id", testbed.code("custkey")).drop("custkey")
    v = V(spark, root).withColumn("entity_id", testbed.code("custkey")).drop("custkey")
    return jn.widen(e.select("entity_id", "region"), [o, v, L], "entity_id")


@register("join_inner_chain")
def join_inner_chain(spark, root):
    """OP-25: orders JOIN customer JOIN nation (inner chain), counted per nation."""
    o = tables.scan(spark, "orders", ["o_custkey"], root)
    c = tables.scan(spark, "customer", ["c_custkey", "c_nationkey"], root)
    n = tables.scan(spark, "nation", ["n_nationkey", "n_name"], root)
    j = jn.inner_join_chain(o, c, n, o["o_custkey"] == c["c_custkey"], c["c_nationkey"] == n["n_nationkey"])
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_orders"))


@register("join_left_null_rejected")
def join_left_null_rejected(spark, root):
    """OP-26: LEFT JOIN employees WHERE job LIKE prefix -- planned as an inner join."""
    return full_report(spark, root).facts.digital_managers


@register("join_cross")
def join_cross(spark, root):
    """OP-27: every entity paired with each KPI id of the catalogue (one Generate, no join)."""
    ids = [(k,) for k in cat.standard_catalogue().ids]
    return jn.cross_with_constants(E(spark, root).select("entity_id"), ids, ["metric_id"])


@register("join_semi")
def join_semi(spark, root):
    """OP-28: customers with at least one purchase event (EXISTS)."""
    c = tables.scan(spark, "customer", ["c_custkey", "c_name"], root)
    ev = tables.scan(spark, "events", ["user_id", "event_type"], root).where(F.col("event_type") == "purchase")
    return jn.semi_join(c, ev, c["c_custkey"] == ev["user_id"])


@register("subquery_scalar")
def subquery_scalar(spark, root):
    """OP-29: rows at the table's maximum ship date, and an empty-input scalar (NULL) selecting nothing."""
    li = tables.scan(spark, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"], root)
    top = li.where(F.col("l_shipdate") == snapshot.scalar_value(li, F.max("l_shipdate")))
    none = li.where(F.col("l_shipdate") == snapshot.scalar_value(li.where(F.col("l_quantity") > 1000),
                                                                 F.max("l_shipdate")))
    return top.unionByName(none).select("l_orderkey", "l_linenumber")


@register("subquery_correlated")
def subquery_correlated(spark, root):
    """OP-30: the vendor of each grouped row by a correlated scalar subquery over the top-1 table."""
    usage = rep_sources(spark, root).usage
    return fx.participation_by_lookup(usage, usage.latest())


def _level_query(level):
    def q(spark, root):
        em, bench = e0_report(spark, root)
        return cmp.level_matches(em, bench, level, testbed.TOTAL_LABEL) \
            .select("entity_id", "metric_id", "value", "level_id", F.col("b_value").alias("bench_value"))
    q.__doc__ = f"OP-32..34: {level}-level benchmark comparison over the E0 hierarchy (NULL keys)."
    return q


for _lv in cmp.LEVELS:
    register(f"compare_{_lv}")(_level_query(_lv))


@register("join_theta_residual")
def join_theta_residual(spark, root):
    """OP-35: zone comparison with an OR-ed theta residual across the outer join (E0 hierarchy)."""
    em, bench = e0_report(spark, root)
    src = rep_sources(spark, root)
    res = rc.resource_catalogue(src.metric_names, src.resource_map, src.resource_links)
    return rc.recommendations(em, bench, res, testbed.TOTAL_LABEL, levels=("zone",))


# ---------------------------------------------------------------------------
# D. aggregation
# ---------------------------------------------------------------------------

@register("agg_sum")
def agg_sum(spark, root):
    """OP-36: grouped SUMs (loyalty fact)."""
    return full_report(spark, root).facts.loyalty


@register("agg_max_string")
def agg_max_string(spark, root):
    """OP-37: MAX of a string per entity (advocate fact)."""
    return full_report(spark, root).facts.advocates


@register("agg_global_max")
def agg_global_max(spark, root):
    """OP-38: global MAX: one row even on empty input."""
    li = tables.scan(spark, "lineitem", ["l_shipdate", "l_quantity"], root)
    full = li.agg(F.max("l_shipdate").alias("max_ship")).select(F.lit("all").alias("which"), "max_ship")
    empty = li.where(F.col("l_quantity") > 1000).agg(F.max("l_shipdate").alias("max_ship")) \
        .select(F.lit("none").alias("which"), "max_ship")
    return full.unionByName(empty)


@register("agg_by_measure")
def agg_by_measure(spark, root):
    """OP-39: GROUP BY that includes a measure: several rows per customer."""
    o = tables.scan(spark, "orders", ["o_custkey", "o_orderpriority", "o_orderdate", "o_orderstatus"], root)
    o = snapshot.latest_in_grain(o, "o_orderdate", "year")
    src = o.select(testbed.code("o_custkey").alias("entity_id"),
                   (F.substring("o_orderpriority", 1, 1).cast("int") * 100).alias("retail_sales"),
                   testbed.year_of("o_orderdate").alias("period"),
                   F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0)).alias("filled"))
    return src.groupBy("entity_id", "retail_sales", "period").agg(
        F.sum("filled").alias("filled"), F.max("retail_sales").alias("retail_max"))


@register("agg_conditional_share")
def agg_conditional_share(spark, root):
    """OP-40: share of (non-distinct) entities whose flag is '1', per region."""
    e = E(spark, root)
    v = V(spark, root).select("custkey", F.when(F.col("purchases") > 0, F.lit(1)).alias("flag"))
    j = e.join(v, "custkey", "left")
    return j.groupBy("region").agg(agg.share("flag", "1", "entity_id").alias("share"))


@register("agg_avg_expr")
def agg_avg_expr(spark, root):
    """OP-41: AVG of a sum of columns, integer (truncating) and decimal, per region."""
    j = E(spark, root).join(V(spark, root), "custkey", "left")
    return j.groupBy("region").agg(
        agg.avg_expr(["purchases", "clicks"], integer=True).alias("avg_int"),
        agg.avg_expr(["CAST(purchases AS DECIMAL(20,0))", "CAST(clicks AS DECIMAL(20,0))"],
                     integer=False).cast("decimal(20,10)").alias("avg_dec"),
    )


@register("agg_avg_decimal")
def agg_avg_decimal(spark, root):
    """OP-42: average after widening to decimal(20,13), rounded to 0 places, per zone."""
    j = E(spark, root).join(O(spark, root), "custkey", "left")
    return j.groupBy("zone").agg(agg.avg_decimal("n_filled", 0).cast("decimal(20,10)").alias("avg_filled"))


@register("agg_ratio_of_sums")
def agg_ratio_of_sums(spark, root):
    """OP-43: ratio of sums (not mean of ratios), per zone; integers, and decimals with fractions."""
    j = E(spark, root).join(O(spark, root), "custkey", "left")
    return j.groupBy("zone").agg(
        agg.ratio_of_sums("n_filled", "n_orders").alias("filled_rate"),
        agg.ratio_of_sums("CAST(n_filled AS DECIMAL(10,1)) + 0.5", "CAST(n_orders AS DECIMAL(10,2)) + 0.25").alias("frac_rate"))


def _rollup(spark, root):
    j = E(spark, root, null_keys=True).join(O(spark, root), "custkey", "left")
    return agg.rollup_levels(j, list(cat.HIERARCHY), {"n_entities": S.plain_agg("count(entity_id)"),
                                                      "n_orders": S.plain_agg("sum(n_orders)")})


@register("grouping_sets")
def grouping_sets(spark, root):
    """OP-44: GROUPING SETS (region, zone, district), (region, zone), (region), () as one ROLLUP."""
    return _rollup(spark, root)


@register("level_label")
def level_label_q(spark, root):
    """OP-45: level id read from NULL group keys (real NULL keys included), total renamed."""
    r = _rollup(spark, root)
    return r.select(F.coalesce("region", F.lit(testbed.TOTAL_LABEL)).alias("region"), "zone", "district",
                    agg.level_label(cat.HIERARCHY).alias("level_id"), "n_entities")


# ---------------------------------------------------------------------------
# E. windows
# ---------------------------------------------------------------------------

@register("window_top1")
def window_top1(spark, root):
    """OP-46: most frequent event type per user, ties broken by name."""
    e = tables.scan(spark, "events", ["user_id", "event_type"], root)
    c = e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return wn.top1(c, "user_id", [F.col("n").desc(), F.col("event_type").asc()])


@register("window_rank_latest")
def window_rank_latest(spark, root):
    """OP-47: each customer's latest order day, ties kept."""
    o = tables.scan(spark, "orders", ["o_orderkey", "o_custkey", "o_orderdate"], root)
    r = wn.latest_per_key(o, "o_custkey", [F.col("o_orderdate").desc()], "rnk")
    return mu.delete_where(r, F.col("rnk") != 1).select("o_custkey", "o_orderkey", "o_orderdate")


@register("window_sequence")
def window_sequence(spark, root):
    """OP-48: 1..n per (customer, status) by order key."""
    o = tables.scan(spark, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"], root)
    return wn.with_sequence(o, ["o_custkey", "o_orderstatus"], [F.col("o_orderkey").asc()], "seq")


# ---------------------------------------------------------------------------
# F. set operations and reshaping
# ---------------------------------------------------------------------------

@register("union_distinct")
def union_distinct_q(spark, root):
    """OP-49: UNION of entity ids seen in events and of customers with a negative balance."""
    ev = tables.scan(spark, "events", ["user_id"], root).select(testbed.code("user_id").alias("entity_id"))
    neg = tables.scan(spark, "customer", ["c_name", "c_acctbal"], root).where(F.col("c_acctbal") < 0) \
        .select(F.expr(testbed.NAME_CODE).alias("entity_id"))
    return rs.union_distinct([ev, neg])


def _narrow_wide(spark, root):
    j = E(spark, root).join(O(spark, root), "custkey", "left").join(V(spark, root), "custkey", "left")
    return j, {1: F.col("n_orders").cast("bigint"), 2: F.col("n_filled").cast("bigint"),
               3: F.col("purchases").cast("bigint")}


@register("unpivot_keep_nulls")
def unpivot_keep_nulls(spark, root):
    """OP-50: unpivot keeping NULLs: exactly three rows per entity."""
    j, vals = _narrow_wide(spark, root)
    return rs.to_long(j, ["entity_id"], vals, "measure_id", "value", keep_nulls=True)


@register("unpivot_drop_nulls")
def unpivot_drop_nulls(spark, root):
    """OP-51: unpivot dropping NULLs."""
    j, vals = _narrow_wide(spark, root)
    return rs.to_long(j, ["entity_id"], vals, "measure_id", "value", keep_nulls=False)


# ---------------------------------------------------------------------------
# G. scalar functions, H. the safe-divide function
# ---------------------------------------------------------------------------

def _customers(spark, root):
    return tables.scan(spark, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"], root)


@register("fn_right")
def fn_right(spark, root):
    """OP-52: last n characters; a shorter string comes back unchanged."""
    c = _customers(spark, root)
    return c.select("c_custkey", fn.right("c_name", 6).alias("short_code"),
                    fn.right("c_mktsegment", 20).alias("whole_segment"))


@register("fn_replace")
def fn_replace(spark, root):
    """OP-53: replace every occurrence of a substring."""
    c = _customers(spark, root)
    return c.select("c_custkey", fn.replace("concat(c_mktsegment, ' REGION')", " REGION", "").alias("cleaned"),
                    fn.replace("c_name", "0", "o").alias("swapped"))


@register("fn_coalesce")
def fn_coalesce(spark, root):
    """OP-54: two-argument NULL default over the E0 hierarchy."""
    e = E(spark, root, null_keys=True)
    return e.select("entity_id", fn.if_null("district", S.lit("UNKNOWN")).alias("district"),
                    fn.if_null("region", S.lit(testbed.TOTAL_LABEL)).alias("region"))


@register("fn_concat_null")
def fn_concat_null(spark, root):
    """OP-55: NULL-propagating concatenation (a NULL part makes the result NULL)."""
    e = E(spark, root, null_keys=True)
    return e.select("entity_id", fn.concat_null("district", S.lit(" / "), "zone").alias("label"))


@register("fn_month_label")
def fn_month_label(spark, root):
    """OP-56: 'Month yyyy' from a date."""
    o = tables.scan(spark, "orders", ["o_orderkey", "o_orderdate"], root)
    return o.select("o_orderkey", fn.month_label("to_date(o_orderdate)").alias("month_label"))


@register("fn_format_thousands")
def fn_format_thousands(spark, root):
    """OP-57: truncated integer with thousands separators; NULL -> '-'."""
    li = tables.scan(spark, "lineitem", ["l_suppkey", "l_quantity"], root)
    per_supp = li.groupBy("l_suppkey").agg((F.sum(F.col("l_quantity").cast("bigint")) * 1000).alias("q"))
    c = _customers(spark, root).select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("x"))
    e = E(spark, root).join(O(spark, root), "custkey", "left").select(F.col("custkey").alias("k"),
                                                                       F.col("n_orders").alias("x"))
    return sinks.append_all([
        per_supp.select(F.lit("supplier").alias("src"), F.col("l_suppkey").alias("k"), fn.format_thousands("q").alias("text")),
        c.select(F.lit("balance").alias("src"), "k", fn.format_thousands("x").alias("text")),
        e.select(F.lit("orders").alias("src"), "k", fn.format_thousands("x").alias("text")),
    ])


@register("fn_format_percent")
def fn_format_percent(spark, root):
    """OP-58: percent with one decimal; NULL -> '-'."""
    j = E(spark, root).join(O(spark, root), "custkey", "left")
    return j.select("entity_id", fn.format_percent(S.percent_of("n_filled", "n_orders")).alias("filled_pct"))


@register("fn_trunc_int")
def fn_trunc_int(spark, root):
    """OP-59: decimal/double to int truncating toward zero (negative balances included)."""
    c = _customers(spark, root)
    return c.select("c_custkey", fn.trunc_int("c_acctbal").alias("whole"),
                    fn.trunc_int("CAST(c_custkey AS DECIMAL(20,0)) / 3").alias("third"))


@register("fn_cast_decimal")
def fn_cast_decimal(spark, root):
    """OP-60: decimal(20,10), (20,13) and (10,1) casts; the last rounds half away from zero."""
    li = tables.scan(spark, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"], root)
    q = "CAST(l_quantity AS BIGINT)"
    quarter = f"{S.to_decimal(q, 20, 10)} * 0.25"
    return li.select("l_orderkey", "l_linenumber", fn.to_decimal(q, 20, 10).alias("d20_10"),
                     fn.to_decimal(q, 20, 13).alias("d20_13"), fn.to_decimal(quarter, 10, 1).alias("d10_1"))


@register("fn_round")
def fn_round(spark, root):
    """OP-61: ROUND half away from zero on decimals."""
    li = tables.scan(spark, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"], root)
    quarter = f"{S.to_decimal('CAST(l_quantity AS BIGINT)', 20, 10)} * 0.25"
    return li.select("l_orderkey", "l_linenumber", fn.round_half_away(quarter, 1).alias("r1"),
                     fn.round_half_away(f"-({quarter})", 0).alias("r0_negative"))


@register("fn_arith_null")
def fn_arith_null(spark, root):
    """OP-62: + and *100 with NULL propagation."""
    j = E(spark, root).join(O(spark, root), "custkey", "left")
    return j.select("entity_id", (F.col("n_orders") + F.col("n_filled")).alias("total"),
                    (F.col("n_filled") * 100).alias("scaled"))


@register("fn_to_string")
def fn_to_string(spark, root):
    """OP-63: number -> text (the default formatter)."""
    li = tables.scan(spark, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"], root)
    return li.select("l_orderkey", "l_linenumber",
                     fn.to_text(S.to_decimal("CAST(l_quantity AS BIGINT)", 20, 10)).alias("text"))


@register("safe_divide")
def safe_divide_q(spark, root):
    """OP-64: decimal division, NULL on a NULL side or a zero divisor (no Python UDF)."""
    j = E(spark, root).join(O(spark, root), "custkey", "left").join(V(spark, root), "custkey", "left")
    return j.select("entity_id",
                    fn.safe_divide("n_filled", "n_orders").cast("decimal(20,10)").alias("filled_share"),
                    fn.safe_divide("CAST(n_filled AS DECIMAL(10,1)) + 0.5", "CAST(n_orders AS DECIMAL(10,2)) + 0.25")
                    .cast("decimal(20,10)").alias("frac_share"),
                    fn.safe_divide("purchases", "purchases - purchases").alias("by_zero"))


# ---------------------------------------------------------------------------
# I. user-level jobs
# ---------------------------------------------------------------------------

@register("job_entity_dimension")
def job_entity_dimension(spark, root):
    """JOB-1: latest open record per long code (ties kept), short code, cleaned region, activity flag."""
    src = rep_sources(spark, root)
    cfg = testbed.config()
    from scorewright.plans.dimension import entity_dimension
    return entity_dimension(src.history, src.current, src.regions, keep=cfg.keep, short_len=cfg.short_code_len,
                            region_suffix=cfg.region_suffix)


@register("job_infer_activity")
def job_infer_activity(spark, root):
    """JOB-2: unknown activity -> 0 on service evidence (rows still unknown drop out of the wide table)."""
    return full_report(spark, root).dimension


@register("job_wide")
def job_wide(spark, root):
    """JOB-3: the 34-column wide table."""
    return full_report(spark, root).wide


@register("job_entity_metrics")
def job_entity_metrics(spark, root):
    """JOB-4: nine KPIs per wide row, long form, NULLs kept."""
    return full_report(spark, root).entity_metrics


@register("job_benchmark_metrics")
def job_benchmark_metrics(spark, root):
    """JOB-5: the KPIs at district, zone, region and total level, NULLs dropped."""
    return full_report(spark, root).benchmarks


@register("job_rag_colour")
def job_rag_colour(spark, root):
    """JOB-7: colour counts per KPI and level."""
    card = full_report(spark, root).scorecard
    return card.groupBy("metric_id", "level_id", "value_rgb").agg(F.count(F.lit(1)).alias("n_rows"))


@register("job_recommendations")
def job_recommendations(spark, root):
    """JOB-8: recommended resources per entity and level, ordered 1..n."""
    return full_report(spark, root).recommendations


@register("job_footnotes")
def job_footnotes(spark, root):
    """JOB-9: one footnote per source."""
    return full_report(spark, root).footnotes


@register("job_tooltips")
def job_tooltips(spark, root):
    """JOB-10: tooltips of eight KPIs stamped with their source's month."""
    return full_report(spark, root).metric_names


@register("job_header")
def job_header(spark, root):
    """JOB-11: 19-column header per wide row."""
    return full_report(spark, root).header


@register("job_facts")
def job_facts(spark, root):
    """JOB-12: the nine fact builders, each summarised by row count and latest period."""
    f = full_report(spark, root).facts
    parts = []
    for name in ("participation", "service", "visit_sales", "loyalty", "enrollment", "opportunity", "campaigns",
                 "advocates"):
        df = getattr(f, name)
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"), F.max("period").alias("period"))
                     .select(F.lit(name).alias("fact"), "n_rows", "period"))
    dm = f.digital_managers.agg(F.count(F.lit(1)).alias("n_rows")) \
        .select(F.lit("digital_managers").alias("fact"), "n_rows", F.lit(None).cast("date").alias("period"))
    return sinks.append_all(parts + [dm])
