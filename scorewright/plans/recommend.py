"""Recommendations (JOB-8): follow-up resources where a KPI falls short, per level, ordered 1..n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewright.functions import sql as S
from scorewright.operators.joins import spread_join
from scorewright.plans.catalogue import RECOMMENDATION_RULES, RULE_BELOW_BENCH, RULE_NOT_ONE
from scorewright.plans.compare import LEVELS, all_levels

CHUNK = 10_000      # rows that one task expands at once

RECOMMENDATION_COLUMNS = ("resource_id", "level_id", "entity_id", "order_id")


def resource_catalogue(metric_names: DataFrame, resource_map: DataFrame, resource_links: DataFrame) -> DataFrame:
    """metric_names(metric_id, metric_name, ...) JOIN map(resource_id, metric_id) JOIN links(resource_id, resource_html)."""
    return (
        metric_names.select("metric_id", "metric_name")
        .join(resource_map.select("resource_id", "metric_id"), on="metric_id", how="inner")
        .join(resource_links.select("resource_id", "resource_html"), on="resource_id", how="inner")
        .select("metric_id", "metric_name", "resource_id", "resource_html")
    )


def _rule_condition(kind: str) -> str:
    if kind == RULE_BELOW_BENCH:
        return "value < b_value"
    if kind == RULE_NOT_ONE:
        return "value <> 1"
    raise ValueError(f"unknown rule {kind!r}")


def rule_predicate(rules: Sequence[tuple[int, str]]) -> str:
    """OR over rules of (resource = id AND condition), SQL; UNKNOWN rows are not recommended."""
    return " OR ".join(f"(resource_id = {int(rid)} AND {_rule_condition(kind)})" for rid, kind in rules)


def rule_resource(rules: Sequence[tuple[int, str]]) -> str:
    """CASE WHEN <rule 1> THEN resource_id WHEN <rule 2> THEN resource_id END (SQL)."""
    return S.case([(f"resource_id = {int(rid)} AND {_rule_condition(kind)}", "resource_id") for rid, kind in rules])


def recommendations(
    em: DataFrame,
    bench: DataFrame,
    resources: DataFrame,
    total_label: str,
    rules: Sequence[tuple[int, str]] = RECOMMENDATION_RULES,
    levels=LEVELS,
) -> DataFrame:
    """Resources whose rule fires for an entity KPI at a benchmark level, numbered per (entity, level).

    The resources of the rules are joined by KPI, a key with few values
    (``spread_join``), then all levels are compared in one join.  ``bench`` is
    the benchmark table or a keyed one (``compare.keyed_bench``).
    """
    ids = [rid for rid, _ in rules]
    res = resources.where(S.isin("resource_id", ids)).selectExpr("resource_id", "metric_id AS _res_metric")
    with_res = spread_join(em, res, "metric_id = _res_metric", "entity_id", "inner")
    matched = all_levels(with_res, bench, total_label, levels, extra=("resource_id",))
    fired = matched.where(rule_predicate(rules)).selectExpr(
        f"{rule_resource(rules)} AS resource_id", "level_id", "entity_id",
    )
    return number_duplicates(fired)


def number_duplicates(fired: DataFrame) -> DataFrame:
    """row_number() OVER (PARTITION BY entity, level ORDER BY resource) without a hot-key window.

    Rows of one (entity, level, resource) are identical, so the result is
    fixed by their count: rows are pre-aggregated to counts (map-side
    combine), the window numbers at most one row per distinct resource, and
    each count expands back into its rows with consecutive order ids.  A count
    is cut into chunks of ``CHUNK`` first and the chunks are dealt over tasks,
    so a huge fan-out is neither one array nor one task's work.
    """
    counts = fired.groupBy("entity_id", "level_id", "resource_id").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("entity_id", "level_id").orderBy(F.col("resource_id").asc_nulls_first())
    start = counts.withColumn("_end", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    key = ("resource_id", "level_id", "entity_id")
    chunks = start.selectExpr(*key, "_end", f"explode(sequence(_end - _n + 1, _end, {CHUNK}L)) AS _from")
    return chunks.repartition(*key, "_from").selectExpr(
        *key, f"explode(sequence(CAST(_from AS INT), CAST(least(_end, _from + {CHUNK - 1}) AS INT))) AS order_id")
