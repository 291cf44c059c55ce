"""KPI catalogue: configuration, not code.

Each KPI has a fixed id, an entity-level expression over the wide table, a
benchmark aggregate for the rollup, a display kind for the entity value and
for the benchmark value, and a colour rule.  The default catalogue below
reproduces the nine KPIs of the scorecard; callers may pass their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql.types import IntegralType, StructType

from scorewright.functions import sql as S

from scorewright.fixed import (  # noqa: E402,F401  (re-exported for callers)
    FLAG_ON, GREEN, LEVEL_DISTRICT, LEVEL_NATION, LEVEL_REGION, LEVEL_ZONE, RECOMMENDATION_RULES, RED,
    RESOURCE_METRIC_MAP, RULE_BELOW_BENCH, RULE_NOT_ONE, WHITE,
)

LEVEL_IDS = (LEVEL_NATION, LEVEL_REGION, LEVEL_ZONE, LEVEL_DISTRICT)

# display kinds
FLAG = "flag"
COUNT = "count"
PERCENT = "percent"
TEXT = "text"
# colour rules
OWN = "own"
VS_BENCH = "vs_bench"
NONE = "none"

HIERARCHY = ("region", "zone", "district")


@dataclass(frozen=True)
class Kpi:
    metric_id: int
    name: str
    entity: str       # SQL expression over one wide row
    bench: S.Agg | Callable[[StructType], S.Agg]    # mergeable aggregate over wide rows, or made from their schema
    entity_display: str
    bench_display: str
    colour: str = NONE
    sources: tuple[str, ...] = field(default=())

    def __post_init__(self):
        if self.entity_display not in (FLAG, COUNT, PERCENT, TEXT):
            raise ValueError(f"KPI {self.metric_id}: unknown display {self.entity_display}")
        if self.bench_display not in (COUNT, PERCENT, TEXT):
            raise ValueError(f"KPI {self.metric_id}: unknown benchmark display {self.bench_display}")
        if self.colour not in (OWN, VS_BENCH, NONE):
            raise ValueError(f"KPI {self.metric_id}: unknown colour rule {self.colour}")


@dataclass(frozen=True)
class Catalogue:
    kpis: tuple[Kpi, ...]

    def __post_init__(self):
        ids = [k.metric_id for k in self.kpis]
        if len(set(ids)) != len(ids):
            raise ValueError("duplicate KPI ids")

    @property
    def ids(self) -> list[int]:
        return [k.metric_id for k in self.kpis]

    def ids_where(self, pred: Callable[[Kpi], bool]) -> list[int]:
        return [k.metric_id for k in self.kpis if pred(k)]

    def entity_values(self) -> dict[int, str]:
        """KPI id -> SQL expression, every value decimal(20,10)."""
        return {k.metric_id: S.to_decimal(k.entity) for k in self.kpis}

    def bench_values(self, wide: StructType) -> dict[int, S.Agg]:
        """KPI id -> mergeable aggregate over wide rows of this schema, every value decimal(20,10)."""
        return {k.metric_id: (k.bench if isinstance(k.bench, S.Agg) else k.bench(wide)).then(S.to_decimal) for k in self.kpis}


def average_of(cols: list[str]) -> Callable[[StructType], S.Agg]:
    """Average of a sum of columns: truncated for integer columns, plain for others, as their types say."""
    return lambda wide: S.avg_expr_agg(cols, integer=all(isinstance(wide[c].dataType, IntegralType) for c in cols))


def standard_catalogue() -> Catalogue:
    """The nine KPIs over the neutral wide-table columns (see plans.wide.WIDE_COLUMNS)."""
    opp2 = ["favour_brand", "favour_undecided"]
    opp4 = ["count_new", "count_mine", "count_old", "count_any"]
    return Catalogue((
        Kpi(8, "participation", S.to_decimal("participation"),
            S.share_agg("participation", FLAG_ON, "entity_id"), FLAG, PERCENT, OWN),
        Kpi(9, "opportunity_sales", S.to_decimal(S.add_all(opp2)),
            average_of(opp2), COUNT, COUNT, NONE),
        Kpi(14, "opportunity_service", S.to_decimal(S.add_all(opp4)),
            average_of(opp4), COUNT, COUNT, NONE),
        Kpi(15, "inspection_rate", S.percent_of("inspections_done", "repair_orders"),
            S.ratio_of_sums_agg("inspections_done", "repair_orders"), PERCENT, PERCENT, NONE),
        Kpi(25, "visit_close_rate", S.percent_of("visit_sales", "visit_households"),
            S.ratio_of_sums_agg("visit_sales", "visit_households"), PERCENT, PERCENT, VS_BENCH),
        Kpi(26, "loyalty_rate", S.percent_of("loyal_returns", "market_returns"),
            S.ratio_of_sums_agg("loyal_returns", "market_returns"), PERCENT, PERCENT, VS_BENCH),
        Kpi(27, "attributed_share", S.percent_of("attributed_sales", "retail_sales"),
            S.ratio_of_sums_agg("attributed_sales", "retail_sales"), PERCENT, PERCENT, NONE),
        Kpi(28, "campaign_buy_rate", S.percent_of("units_sold", "customers_contacted"),
            S.ratio_of_sums_agg("units_sold", "customers_contacted"), PERCENT, PERCENT, VS_BENCH),
        Kpi(34, "visit_sales", S.to_decimal("visit_sales"),
            S.avg_decimal_agg("visit_sales", 0), COUNT, COUNT, NONE),
    ))
