"""Source catalogue, footnotes (JOB-9) and tooltips (JOB-10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from scorewright.functions import sql as S
from scorewright.operators.mutate import keyed_update
from scorewright.sources.tables import constants

from scorewright.fixed import FOOTNOTE_TAIL, FOOTNOTE_TYPE, SOURCE_SEPARATOR, TOOLTIP_SEPARATOR  # noqa: E402

CATALOG_COLUMNS = ("metric", "data_source", "period", "order_id")
FOOTNOTE_COLUMNS = ("footnote_type", "footnote_name", "footnote_text", "footnote_date")


@dataclass(frozen=True)
class SourceSpec:
    label: str
    data_source: str
    frame: DataFrame
    period_col: str
    order_id: int


def source_catalogue(specs: Sequence[SourceSpec]) -> DataFrame:
    """One row per source: label, origin, its latest period (NULL when empty), display order.

    Each row is a global aggregate (one row even on empty input), cast to the
    declared types, and the rows are appended into one relation.
    """
    rows = [
        s.frame.selectExpr(
            f"CAST({S.lit(s.label)} AS STRING) AS metric",
            f"CAST({S.lit(s.data_source)} AS STRING) AS data_source",
            f"CAST(max({s.period_col}) AS DATE) AS period",
            f"CAST({int(s.order_id)} AS INT) AS order_id",
        )
        for s in specs
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


def footnotes(catalog: DataFrame) -> DataFrame:
    """'<label> Data Source: <origin>  ' and a 'Month yyyy' date per catalogue row."""
    return catalog.selectExpr(
        f"{S.lit(FOOTNOTE_TYPE)} AS footnote_type",
        "metric AS footnote_name",
        f"{S.concat_null('metric', S.lit(SOURCE_SEPARATOR), 'data_source', S.lit(FOOTNOTE_TAIL))} AS footnote_text",
        f"{S.month_label('period')} AS footnote_date",
    )


def tooltip_base(tooltips: DataFrame, metric_names: DataFrame) -> DataFrame:
    """tooltips(metric_id, metric_name, tooltip) restricted to ids present in metric_names."""
    return tooltips.join(metric_names.select("metric_id"), on="metric_id", how="inner") \
        .select("metric_id", "metric_name", "tooltip")


def tooltip_patch(spark: SparkSession, base: DataFrame, notes: DataFrame, id_to_source: Mapping[int, str]) -> DataFrame:
    """New tooltip text per listed id: base text + ' ' + the source's footnote date (NULL if either is missing)."""
    ids = constants(spark, sorted(id_to_source.items()), "metric_id int, source_label string")
    n = notes.selectExpr("footnote_name AS source_label", "footnote_date")
    patch = ids.join(base.select("metric_id", "tooltip"), on="metric_id", how="left") \
        .join(n, on="source_label", how="left")
    return patch.selectExpr(
        "metric_id",
        f"{S.concat_null('tooltip', S.lit(TOOLTIP_SEPARATOR), 'footnote_date')} AS new_value",
    )


def tooltips(spark: SparkSession, metric_names: DataFrame, tooltip_table: DataFrame, notes: DataFrame,
             id_to_source: Mapping[int, str]) -> DataFrame:
    """metric_names with the tooltip of the listed ids replaced; other rows untouched."""
    base = tooltip_base(tooltip_table, metric_names)
    patch = tooltip_patch(spark, base, notes, id_to_source)
    return keyed_update(metric_names, patch, "metric_id", "tooltip")
