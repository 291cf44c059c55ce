"""The whole scorecard refresh: sources -> dimension -> facts -> wide -> KPIs ->
benchmarks -> scorecard / recommendations / header / footnotes / tooltips.

``build`` returns lazily planned DataFrames (with the multi-consumer
intermediates materialised); ``refresh`` writes every report table once, into
the folder of a new version, makes that version current with one log entry
after all of them exist, and releases what the build has held.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from scorewright.plans import facts as fx
from scorewright.plans.annotate import SourceSpec, footnotes, source_catalogue, tooltips
from scorewright.plans.catalogue import Catalogue, standard_catalogue
from scorewright.plans.compare import keyed_bench, scorecard
from scorewright.plans.dimension import HistorySource, entity_dimension, infer_activity
from scorewright.plans.header import header
from scorewright.plans.metrics import benchmark_metrics, entity_metrics
from scorewright.plans.recommend import recommendations, resource_catalogue
from scorewright.plans.wide import Facts, wide_table
from scorewright.fixed import SHORT_CODE_LEN
from scorewright.sources.sinks import VersionLog, Workspace, materialise, overwrite, run_concurrently
from scorewright.sources.snapshot import SUBQUERY, Periodic, latest_periods


Snapshot = DataFrame | Periodic


@dataclass(frozen=True)
class ReportSources:
    """The source tables; those read at their latest period may be ``Periodic``.

    ``work`` holds tables that were staged to make them; ``refresh`` releases it.
    """

    history: DataFrame | HistorySource
    current: DataFrame
    regions: DataFrame
    usage: Snapshot
    opportunity: Snapshot
    campaigns: Snapshot
    service_entities: Snapshot
    service_orders: Snapshot
    inspections: Snapshot
    visits: Snapshot
    advocates: Snapshot
    employees: DataFrame
    loyalty: Snapshot
    enrollment: Snapshot
    metric_names: DataFrame
    resource_map: DataFrame
    resource_links: DataFrame
    tooltips: DataFrame
    work: Workspace = field(default_factory=Workspace)


@dataclass(frozen=True)
class ReportConfig:
    report_date: str
    total_label: str
    manager_title_prefix: str
    keep: Column | None = None
    order: Sequence[Column] | None = None
    region_suffix: str | None = None
    short_code_len: int = SHORT_CODE_LEN    # characters of the long code that make the entity key
    # (label, data source, fact name, display order)
    source_labels: Sequence[tuple[str, str, str, int]] = ()
    tooltip_sources: Mapping[int, str] = field(default_factory=dict)
    catalogue: Catalogue = field(default_factory=standard_catalogue)
    wide_mode: str = "table"        # written to the shared checkpoint folder: cuts the lineage
    facts_mode: str = "cache"
    metrics_mode: str = "table"     # entity KPIs and benchmarks: read by eight comparison branches
    snapshot_mode: str = "batch"    # "batch": all latest periods in one job; "subquery": one scalar subquery each


@dataclass
class Report:
    dimension: DataFrame
    facts: Facts
    wide: DataFrame
    entity_metrics: DataFrame
    benchmarks: DataFrame
    header: DataFrame
    scorecard: DataFrame
    recommendations: DataFrame
    source_catalogue: DataFrame
    footnotes: DataFrame
    metric_names: DataFrame
    work: Workspace

    def release(self) -> None:
        """Unpersist and delete what the build holds; its DataFrames can't be read afterwards."""
        self.work.release()


def snapshot_periods(src: ReportSources, cfg: ReportConfig) -> dict:
    """Each snapshot source's own latest period.

    ``batch``: every maximum up front (from statistics or one small global
    aggregate, submitted side by side), then literal filters, statically pruned
    and pushed down.
    ``subquery``: every fact filters with its own scalar subquery.
    """
    sources = {
        "usage": (src.usage, "period"), "opportunity": (src.opportunity, "period"),
        "campaigns": (src.campaigns, "period"), "service": (src.service_entities, "period"),
        "visits": (src.visits, "period"), "advocates": (src.advocates, "period"),
        "loyalty": (src.loyalty, "period"), "enrollment": (src.enrollment, "period"),
    }
    if cfg.snapshot_mode == "subquery":
        return {name: SUBQUERY for name in sources}
    return latest_periods(sources)


def build_facts(src: ReportSources, dim: DataFrame, cfg: ReportConfig, work: Workspace) -> Facts:
    m = lambda df, name: materialise(df, cfg.facts_mode, name, work)
    p = snapshot_periods(src, cfg)
    return Facts(
        participation=m(fx.participation(src.usage, p["usage"]), "participation"),
        service=m(fx.service(src.service_entities, src.service_orders, src.inspections, p["service"]), "service"),
        visit_sales=m(fx.visit_sales(src.visits, cfg.short_code_len, p["visits"]), "visit_sales"),
        loyalty=m(fx.loyalty(src.loyalty, p["loyalty"]), "loyalty"),
        enrollment=m(fx.enrollment(src.enrollment, p["enrollment"]), "enrollment"),
        opportunity=fx.opportunity(src.opportunity, p["opportunity"]),
        campaigns=m(fx.campaigns(src.campaigns, cfg.report_date, p["campaigns"]), "campaigns"),
        advocates=fx.advocates(src.advocates, p["advocates"]),
        digital_managers=fx.digital_managers(dim, src.employees, cfg.manager_title_prefix),
    )


def build(spark: SparkSession, src: ReportSources, cfg: ReportConfig) -> Report:
    """Plan the whole report; materialise only the multi-consumer intermediates.

    Order: dimension -> facts (snapshot periods first) -> activity repair ->
    wide table (written) -> entity KPIs and benchmarks (written side by side,
    the latter also keyed for the comparisons) -> comparisons, recommendations,
    footnotes, tooltips, header (lazy DataFrames; ``refresh`` writes them).
    """
    work = Workspace()
    dim0 = entity_dimension(src.history, src.current, src.regions, keep=cfg.keep, order=cfg.order,
                            short_len=cfg.short_code_len, region_suffix=cfg.region_suffix)
    facts = build_facts(src, dim0, cfg, work)
    dim = infer_activity(dim0, facts.service)
    wide = materialise(wide_table(dim, facts), cfg.wide_mode, "wide", work)

    def benchmarks():
        b = materialise(benchmark_metrics(wide, cfg.catalogue, cfg.total_label), cfg.metrics_mode, "benchmarks", work)
        k = keyed_bench(b, cfg.total_label)
        return b, k._replace(frame=materialise(k.frame, cfg.metrics_mode, "keyed-benchmarks", work))

    # independent jobs: written side by side
    em, (bench, keyed) = run_concurrently([
        lambda: materialise(entity_metrics(wide, cfg.catalogue), cfg.metrics_mode, "entity-metrics", work),
        benchmarks,
    ])
    card = scorecard(em, keyed, cfg.catalogue, cfg.report_date, cfg.total_label)
    res = resource_catalogue(src.metric_names, src.resource_map, src.resource_links)
    recs = recommendations(em, keyed, res, cfg.total_label)
    by_name = {
        "participation": facts.participation, "service": facts.service, "visit_sales": facts.visit_sales,
        "loyalty": facts.loyalty, "enrollment": facts.enrollment, "campaigns": facts.campaigns,
    }
    specs = [SourceSpec(label, origin, by_name[fact], "period", order) for label, origin, fact, order in cfg.source_labels]
    catalog = source_catalogue(specs) if specs else None
    notes = footnotes(catalog) if catalog is not None else None
    names = tooltips(spark, src.metric_names, src.tooltips, notes, cfg.tooltip_sources) if notes is not None \
        else src.metric_names
    return Report(
        dimension=dim, facts=facts, wide=wide, entity_metrics=em, benchmarks=bench,
        header=header(wide), scorecard=card, recommendations=recs,
        source_catalogue=catalog, footnotes=notes, metric_names=names, work=work,
    )


def refresh(spark: SparkSession, src: ReportSources, cfg: ReportConfig, out_root: str,
            lease_seconds: int = 86_400) -> dict[str, str]:
    """Write all report tables as a new version of ``out_root`` and make it current (compute first, commit last).

    Every table is written once, to ``out_root/v-<id>/<name>``; one log entry
    makes the version current when all of them exist (``sinks.VersionLog``), so
    a reader (``current_tables``) sees the old report or the new one, never a
    mixture.  Refreshes may overlap: each has its own leased version, and both
    are readable afterwards, the later commit as the current one.  The version
    before stays for readers in flight; older ones go, and those of failed
    refreshes when their lease (``lease_seconds``) has ended.  Returns the paths
    of the new tables.  The build's own tables are released.
    """
    log = VersionLog(spark, out_root, lease_seconds)
    version, committed = log.begin(), False
    try:
        report = build(spark, src, cfg)
        try:
            outputs = {name: df for name, df in (
                ("header", report.header), ("scorecard", report.scorecard), ("recommendations", report.recommendations),
                ("footnotes", report.footnotes), ("metric_names", report.metric_names)) if df is not None}
            written = run_concurrently([lambda n=n: overwrite(outputs[n], os.path.join(out_root, version, n)) for n in outputs])
            log.commit(version)
            committed = True
        finally:
            report.release()
            src.work.release()
    except BaseException:
        if not committed:
            log.abandon(version)
        raise
    log.release(version)
    log.clean()
    return dict(zip(outputs, written))


def current_tables(spark: SparkSession, out_root: str) -> dict[str, DataFrame]:
    """The report tables of the current version of ``out_root``."""
    version = VersionLog(spark, out_root).current()
    if version is None:
        raise FileNotFoundError(f"no report has been published in {out_root}")
    names = ("header", "scorecard", "recommendations", "footnotes", "metric_names")
    return {n: spark.read.parquet(os.path.join(out_root, version, n)) for n in names}
