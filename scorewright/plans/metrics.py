"""Entity KPIs in long form (JOB-4) and the benchmark rollup (JOB-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorewright.functions import sql as S
from scorewright.operators.aggregate import rollup_levels
from scorewright.operators.reshape import to_long
from scorewright.plans.catalogue import HIERARCHY, Catalogue

ENTITY_METRIC_COLUMNS = ("entity_id", "region", "zone", "district", "metric_id", "value")
BENCH_COLUMNS = ("region", "zone", "district", "level_id", "metric_id", "value")


def entity_metrics(wide: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Every KPI for every wide row, NULL values kept: exactly len(catalogue) rows per wide row."""
    return to_long(wide, ["entity_id", *HIERARCHY], catalogue.entity_values(), keep_nulls=True)


def benchmark_metrics(wide: DataFrame, catalogue: Catalogue, total_label: str) -> DataFrame:
    """The KPIs per district, zone, region and in total, NULL values dropped.

    One rollup over region > zone > district, merged from the states of the
    districts.  The level id is read from which
    keys are NULL and the total's region is renamed to ``total_label``.
    Rounding happens per level inside the aggregate expressions.
    """
    values = catalogue.bench_values(wide.schema)
    agg = rollup_levels(wide, HIERARCHY, {f"_b{k}": v for k, v in values.items()})
    labelled = agg.selectExpr(
        f"coalesce(region, {S.lit(total_label)}) AS region", "zone", "district",
        f"{S.level_label(HIERARCHY)} AS level_id",
        *[f"_b{k}" for k in values],
    )
    return to_long(
        labelled, ["region", "zone", "district", "level_id"],
        {k: f"_b{k}" for k in values}, keep_nulls=False,
    ).select(*BENCH_COLUMNS)
