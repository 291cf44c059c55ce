"""Set operations and reshaping (SURVEY F)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION (duplicates removed)."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Mapping[int, Column | str],
    key_name: str = "metric_id",
    value_name: str = "value",
    keep_nulls: bool = True,
) -> DataFrame:
    """Unpivot ``values`` (id -> Column) into (ids..., key, value) rows.

    Values are Columns or SQL expression text.  One Expand per input row.  ``keep_nulls=True`` always yields len(values)
    rows per input row; ``keep_nulls=False`` drops NULL values (SQL UNPIVOT).
    """
    if all(isinstance(c, str) for c in values.values()):
        staged = df.selectExpr(*ids, *[f"{c} AS _v{k}" for k, c in values.items()])
    else:
        staged = df.select(*ids, *[(F.expr(c) if isinstance(c, str) else c).alias(f"_v{k}") for k, c in values.items()])
    long = staged.unpivot(list(ids), [f"_v{k}" for k in values], "_name", value_name)
    long = long.selectExpr(*ids, f"CAST(substring(_name, 3) AS INT) AS {key_name}", value_name)
    return long if keep_nulls else long.where(f"{value_name} IS NOT NULL")
