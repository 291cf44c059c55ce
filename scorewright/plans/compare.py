"""Benchmark comparisons (OP-32..35), value formatting and colours (JOB-6, JOB-7).

Each entity KPI row is compared with four benchmark levels in one join: a row
is expanded into its four level keys (one Generate, the KPI table is read
once), and the benchmark table is keyed the same way, by level, key columns
and KPI (``keyed_bench``).  The keyed table is bounded by the hierarchy, not by
the entity count, and carries no hint: Spark broadcasts it while its size in
bytes allows and shuffles it beyond that.  A level with few keys (the total has
one, there are few regions) would then put all entity rows into few tasks: its
benchmark rows are repeated over as many parts as bring the keys to ``SALTS``,
and the entity rows are dealt over the parts (``level_parts``).

Zone and region comparisons follow the source's outer-join-then-filter
semantics exactly, without its fan-out: an entity row joins the benchmark
rows of its key prefix whose deeper keys are NULL, and a row with no such
match survives (with NULLs) only when no benchmark row at all shares its key
prefix.  That equals "LEFT JOIN on the prefix, then WHERE deeper IS NULL"
without first producing one row per deeper benchmark row: a prefix that has
deeper rows only is one blocking row of the keyed table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.functions import sql as S
from scorewright.operators.joins import SALTS
from scorewright.plans.catalogue import COUNT, FLAG, GREEN, OWN, PERCENT, RED, VS_BENCH, WHITE, Catalogue

LEVELS = ("district", "zone", "region", "nation")
MATCH_COLUMNS = ("entity_id", "metric_id", "value", "level_id", "b_metric", "b_value")
SCORECARD_COLUMNS = ("entity_id", "metric_id", "level_id", "value_text", "value_rgb", "bench_text", "period")

#: key columns of a level; the keyed table and the expanded rows fill the others with ''
_KEYS = {"district": ("region", "zone", "district"), "zone": ("region", "zone"), "region": ("region",), "nation": ()}


class KeyedBench(NamedTuple):
    """The benchmark table keyed for the comparisons, and the parts its levels are dealt over."""

    frame: DataFrame
    parts: Mapping[str, int]


def _keys(level: str, prefix: str = "") -> list[str]:
    names = [f"{prefix}{k}" for k in _KEYS[level]]
    return [f"{n} AS k{i}" for i, n in enumerate(names + ["''"] * (3 - len(names)), 1)]


def level_parts(bench: DataFrame, salts: int = SALTS) -> dict[str, int]:
    """Parts per level: as many as bring its number of distinct keys to ``salts`` (four numbers reach the driver)."""
    counts = bench.selectExpr(*[f"count(DISTINCT {', '.join(_KEYS[lv])}) AS {lv}" for lv in LEVELS if _KEYS[lv]]).first()
    return {lv: max(1, math.ceil(salts / max(1, counts[lv] if _KEYS[lv] else 1))) for lv in LEVELS}


def keyed_bench(bench: DataFrame, total_label: str, parts: Mapping[str, int] | None = None) -> KeyedBench:
    """(lv, k1, k2, k3, part, b_metric, level_id, b_value, at_level) for all four comparisons.

    ``at_level`` is false on blocking rows (see above).  Rows with a NULL key
    could never match an equality and are left out.
    """
    parts = parts or level_parts(bench)
    b = bench.selectExpr("region AS b_region", "zone AS b_zone", "district AS b_district", "level_id",
                         "metric_id AS b_metric", "value AS b_value")

    def keyed(df: DataFrame, level: str, *columns: str) -> DataFrame:
        return df.selectExpr(f"'{level}' AS lv", *_keys(level, "b_"), f"explode(sequence(0, {parts[level] - 1})) AS part",
                             "b_metric", *columns)

    value = ("level_id", "b_value", "TRUE AS at_level")
    out = [keyed(b.where("b_region IS NOT NULL AND b_zone IS NOT NULL AND b_district IS NOT NULL"), "district", *value)]
    for level, deeper in (("zone", "b_district"), ("region", "coalesce(b_zone, b_district)")):
        known = b.where(" AND ".join(f"b_{k} IS NOT NULL" for k in _KEYS[level]))
        out.append(keyed(known.where(f"{deeper} IS NULL"), level, *value))
        blocked = known.groupBy(*[f"b_{k}" for k in _KEYS[level]], "b_metric").agg(
            F.expr(f"max(CASE WHEN {deeper} IS NULL THEN 1 ELSE 0 END) AS _at")).where("_at = 0")
        out.append(keyed(blocked, level, "CAST(NULL AS STRING) AS level_id",
                         f"CAST(NULL AS {bench.schema['value'].dataType.simpleString()}) AS b_value", "FALSE AS at_level"))
    out.append(keyed(b.where(f"b_region = {S.lit(total_label)}"), "nation", *value))
    return KeyedBench(reduce(DataFrame.unionByName, out), dict(parts))


def _level_keys(level: str, parts: int) -> str:
    fields = ", ".join(f"'{name}', {value}" for value, name in (k.rsplit(" AS ", 1) for k in _keys(level)))
    part = f"CAST(pmod(xxhash64(entity_id), {int(parts)}) AS INT)" if parts > 1 else "0"
    return f"named_struct('lv', '{level}', {fields}, 'part', {part})"


def all_levels(em: DataFrame, bench: DataFrame | KeyedBench, total_label: str, levels=LEVELS,
               extra: tuple[str, ...] = ()) -> DataFrame:
    """The level comparisons of every entity KPI row (MATCH_COLUMNS), all levels from one read of ``em``.

    ``extra`` columns of ``em`` are carried along.  ``bench`` is the benchmark table or an already keyed one (``keyed_bench``).
    Join conditions are equalities, so a NULL key never matches.
    """
    if unknown := set(levels) - set(LEVELS):
        raise ValueError(f"unknown levels {sorted(unknown)}")
    keyed = bench if isinstance(bench, KeyedBench) else keyed_bench(bench, total_label)
    b = keyed.frame.selectExpr("lv AS _lv", "k1 AS _k1", "k2 AS _k2", "k3 AS _k3", "part AS _part", "b_metric", "level_id",
                               "b_value", "at_level")
    rows = em.selectExpr("entity_id", "metric_id", "value", *extra,
                         f"inline(array({', '.join(_level_keys(lv, keyed.parts[lv]) for lv in levels)}))")
    on = F.expr("lv = _lv AND metric_id = b_metric AND k1 = _k1 AND k2 = _k2 AND k3 = _k3 AND part = _part")
    # unmatched rows stay, except at the total; matches of a blocking row go
    kept = "CASE WHEN lv = 'nation' THEN at_level IS NOT NULL ELSE coalesce(at_level, TRUE) END"
    return rows.join(b, on, "left").where(kept).select(*MATCH_COLUMNS, *extra)


def level_matches(em: DataFrame, bench: DataFrame, level: str, total_label: str) -> DataFrame:
    """Entity KPI rows with the benchmark columns of one level (b_* NULL when unmatched)."""
    return all_levels(em, bench, total_label, (level,))


def level_matches_literal(em: DataFrame, bench: DataFrame, level: str, total_label: str) -> DataFrame:
    """The source's literal form (left join on the prefix, then filter); used to test the rewrite."""
    b = bench.selectExpr("region AS b_region", "zone AS b_zone", "district AS b_district", "level_id",
                         "metric_id AS b_metric", "value AS b_value")
    eq = " AND ".join(["metric_id = b_metric", *[f"{k} = b_{k}" for k in _KEYS[level]]])
    out = em.join(b, F.expr(eq), "left")
    if level == "nation":
        return out.where(f"b_region = {S.lit(total_label)}")
    if level == "district":
        return out
    out = out.where("b_district IS NULL")
    return out if level == "zone" else out.where("b_zone IS NULL")


def value_text(catalogue: Catalogue, metric: str = "metric_id", value: str = "value") -> str:
    """Entity value as text (SQL).  The second branch parses as (flag AND value <> 1) OR value IS NULL,
    so every KPI with a NULL value shows 'N'."""
    flags = catalogue.ids_where(lambda k: k.entity_display == FLAG)
    counts = catalogue.ids_where(lambda k: k.entity_display == COUNT)
    pcts = catalogue.ids_where(lambda k: k.entity_display == PERCENT)
    return S.case([
        (f"{S.isin(metric, flags)} AND {value} = 1", "'Y'"),
        (f"{S.isin(metric, flags)} AND {value} <> 1 OR {value} IS NULL", "'N'"),
        (S.isin(metric, counts), S.format_thousands(value)),
        (S.isin(metric, pcts), S.format_percent(value)),
    ], S.to_text(value))


def bench_text(catalogue: Catalogue, bench_metric: str = "b_metric", bench_value: str = "b_value") -> str:
    """Benchmark value as text (SQL); NULL when there is no matched benchmark row."""
    counts = catalogue.ids_where(lambda k: k.bench_display == COUNT)
    pcts = catalogue.ids_where(lambda k: k.bench_display == PERCENT)
    return S.case([
        (S.isin(bench_metric, counts), S.format_thousands(bench_value)),
        (S.isin(bench_metric, pcts), S.format_percent(bench_value)),
    ], S.to_text(bench_value))


def rag_colour(catalogue: Catalogue, metric: str = "metric_id", value: str = "value", bench_value: str = "b_value") -> str:
    """Green / red / white (SQL): own-value KPIs by their value, vs-benchmark KPIs against it (>= is green)."""
    own = catalogue.ids_where(lambda k: k.colour == OWN)
    vs = catalogue.ids_where(lambda k: k.colour == VS_BENCH)
    return S.case([
        (f"{S.isin(metric, own)} AND {value} > 0", S.lit(GREEN)),
        (f"{S.isin(metric, own)} AND {value} = 0", S.lit(RED)),
        (f"{S.isin(metric, vs)} AND {value} < {bench_value}", S.lit(RED)),
        (f"{S.isin(metric, vs)} AND {value} >= {bench_value}", S.lit(GREEN)),
    ], S.lit(WHITE))


def format_scorecard(matched: DataFrame, catalogue: Catalogue, report_date) -> DataFrame:
    return matched.selectExpr(
        "entity_id", "metric_id", "level_id",
        f"{value_text(catalogue)} AS value_text",
        f"{rag_colour(catalogue)} AS value_rgb",
        f"{bench_text(catalogue)} AS bench_text",
        f"to_date({S.lit(str(report_date))}) AS period",
    )


def scorecard(em: DataFrame, bench: DataFrame, catalogue: Catalogue, report_date, total_label: str,
              levels=LEVELS) -> DataFrame:
    """All levels' comparisons, formatted once: one row per entity KPI and level."""
    return format_scorecard(all_levels(em, bench, total_label, levels), catalogue, report_date)
