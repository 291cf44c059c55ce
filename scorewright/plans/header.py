"""Entity header rows (JOB-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorewright.fixed import MISSING_NAME
from scorewright.functions import sql as S

HEADER_COLUMNS = (
    "entity_id", "entity_name", "region", "zone", "district", "svc_district", "manager", "svc_manager",
    "lines", "vendor_tool", "leads_tool", "web_tool", "campaign", "other_tools", "enrolled",
    "sales_rank", "service_rank", "digital_manager", "advocate",
)


def header(wide: DataFrame) -> DataFrame:
    """19 columns per wide row; five are NULL placeholders the report fills elsewhere."""
    blank = "CAST(NULL AS STRING)"
    missing = S.lit(MISSING_NAME)
    return wide.selectExpr(
        "entity_id", "entity_name", "region", "zone", "district", "svc_district", "manager", "svc_manager",
        "lines",
        f"{S.if_null('vendor', missing)} AS vendor_tool",
        f"{blank} AS leads_tool",
        f"{blank} AS web_tool",
        f"{S.flag_text('campaign_flag')} AS campaign",
        f"{blank} AS other_tools",
        "enrolled",
        f"{blank} AS sales_rank",
        f"{blank} AS service_rank",
        f"{S.if_null('digital_manager', missing)} AS digital_manager",
        f"{S.if_null('advocate', missing)} AS advocate",
    )
