"""Fixed values.

Every value below must equal the source report's for identical output.  They
are stated here together, in the order the report uses them; all other
labels (region suffixes, job-title prefixes, the total's label, source
names) are configuration passed in by the caller.
"""

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# short entity code: the last 6 characters of the long code
SHORT_CODE_LEN = 6
# campaign participation flag, and the participation KPI's "on" value, compared as text
CAMPAIGN_FLAG = "1"
FLAG_ON = "1"
# KPI value shapes: decimal(20,10); widened to decimal(20,13) before an average;
# ratios are round(a / b, 3) * 100; percentages are shown with one decimal
KPI_DECIMAL = "DECIMAL(20,10)"
WIDEN_DECIMAL = "DECIMAL(20,13)"
RATIO_PLACES = 3
PERCENT_PLACES = 1
# benchmark level ids: '1' total, '2' region, '3' zone, '4' district
LEVEL_NATION, LEVEL_REGION, LEVEL_ZONE, LEVEL_DISTRICT = "1", "2", "3", "4"
# value texts: flag yes / no, missing number
YES, NO = "Y", "N"
MISSING_TEXT = "-"
# colours (RGB text): green, red, white
GREEN = "226,240,217"
RED = "244,186,186"
WHITE = "255,255,255"
# header: shown for a missing vendor, manager or advocate
MISSING_NAME = "None"
# footnotes: type, separator before the data source, two trailing spaces; tooltip separator
FOOTNOTE_TYPE = "Footer"
SOURCE_SEPARATOR = " Data Source: "
FOOTNOTE_TAIL = "  "
TOOLTIP_SEPARATOR = " "
# resource -> KPI id map
RESOURCE_METRIC_MAP = (
    (1, 4), (2, 6), (3, 8), (4, 10), (5, 12), (6, 17), (7, 22), (8, 23),
    (9, 24), (10, 26), (11, 29), (12, 30), (13, 31), (14, 35), (15, 36),
)
# recommendation rules: resource 10 when the value is below the benchmark, resource 3 when it is not 1
RULE_BELOW_BENCH = "below_bench"
RULE_NOT_ONE = "not_one"
RECOMMENDATION_RULES = ((10, RULE_BELOW_BENCH), (3, RULE_NOT_ONE))
