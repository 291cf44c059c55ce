"""Aggregates (SURVEY D).  All are partial/final hash aggregates (map-side combine).

The aggregate expressions themselves (share, avg_expr, avg_decimal,
ratio_of_sums, level_label) are built in ``functions.sql``, as one step or as
``Agg`` states that add up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.functions import avg_decimal, avg_expr, level_label, ratio_of_sums, share  # noqa: F401
from scorewright.functions.sql import Agg


def rollup_levels(df: DataFrame, levels: Sequence[str], aggs: Mapping[str, Agg]) -> DataFrame:
    """GROUPING SETS ((a,b,c),(a,b),(a),()) == ROLLUP(a,b,c), from partial states.

    The rows are aggregated once, to the states of the finest level.  The
    coarser levels are merged from these few rows, so the rollup's row
    expansion (one copy per level) never meets the input rows.  Real NULL keys
    are groups of their own at every level, as in a rollup of the rows, and
    results have the types of the aggregates in one step.
    """
    types = df.groupBy().agg(*[F.expr(f"{a.sql()} AS `{name}`") for name, a in aggs.items()]).schema
    states = {f"_{name}_{i}": sql for name, a in aggs.items() for i, sql in enumerate(a.states)}
    finest = df.groupBy(*levels).agg(*[F.expr(f"{sql} AS `{name}`") for name, sql in states.items()])
    merged = finest.rollup(*levels).agg(*[F.expr(f"sum(`{name}`) AS `{name}`") for name in states])
    return merged.selectExpr(*levels, *[
        f"CAST({a.final(*[f'`_{name}_{i}`' for i in range(len(a.states))])} AS {types[name].dataType.simpleString()}) AS `{name}`"
        for name, a in aggs.items()])

