"""Wide table (JOB-3): one row per entity (more where facts fan out), 34 columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from scorewright.operators.joins import widen

WIDE_COLUMNS = (
    "entity_id", "active", "entity_name", "region", "zone", "district", "svc_district", "svc_zone",
    "region_short", "manager", "svc_manager", "lines",
    "participation", "vendor", "attributed_sales", "retail_sales",
    "favour_brand", "favour_undecided", "count_new", "count_mine", "count_old", "count_any",
    "campaign_flag", "units_sold", "customers_contacted",
    "inspections_done", "repair_orders",
    "visit_sales", "visit_households",
    "loyal_returns", "market_returns",
    "enrolled", "advocate", "digital_manager",
)


@dataclass(frozen=True)
class Facts:
    participation: DataFrame
    service: DataFrame
    visit_sales: DataFrame
    loyalty: DataFrame
    enrollment: DataFrame
    opportunity: DataFrame
    campaigns: DataFrame
    advocates: DataFrame
    digital_managers: DataFrame


def wide_table(dim: DataFrame, facts: Facts) -> DataFrame:
    """Left-join the nine facts onto the entity dimension on the short code.

    Only entities with a known activity (1 or 0) are kept.  Each fact is
    projected to the columns the wide table uses before it is joined.
    """
    spine = dim.where("active IN (1, 0)")
    pieces = [
        facts.participation.selectExpr("entity_id", "participation", "vendor", "attributed_sales", "retail_sales"),
        facts.service.selectExpr("entity_id", "inspections_done", "repair_orders"),
        facts.visit_sales.selectExpr("entity_id", "visit_sales", "visit_households"),
        facts.loyalty.selectExpr("entity_id", "loyal_returns", "market_returns"),
        facts.enrollment.selectExpr("entity_id", "enrolled"),
        facts.opportunity.selectExpr("entity_id", "favour_brand", "favour_undecided", "count_new", "count_mine",
                                     "count_old", "count_any"),
        facts.campaigns.selectExpr("entity_id", "campaign_flag", "units_sold", "customers_contacted"),
        facts.advocates.selectExpr("entity_id", "advocate"),
        facts.digital_managers.selectExpr("entity_id", "digital_manager"),
    ]
    return widen(spine, pieces, "entity_id").selectExpr(*WIDE_COLUMNS)
