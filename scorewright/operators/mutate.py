"""Table mutations expressed as DataFrame transforms (OP-09..OP-12).

A DELETE or UPDATE becomes a new DataFrame; nothing is modified in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """DELETE ... WHERE p keeps every row where p is not TRUE (FALSE or UNKNOWN)."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def fill_if_exists(df: DataFrame, target: str, value, evidence: DataFrame, df_key: str, evidence_key: str) -> DataFrame:
    """UPDATE df SET target = value WHERE target IS NULL AND EXISTS (evidence with the same key).

    Evidence keys are de-duplicated (map-side) first, so the join never
    multiplies ``df`` rows.
    """
    hits = evidence.select(F.col(evidence_key).alias("_ek")).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(hits, on=df[df_key] == hits["_ek"], how="left")
    filled = F.when(F.col(target).isNull() & F.col("_hit"), F.lit(value)).otherwise(F.col(target))
    return joined.withColumn(target, filled).drop("_ek", "_hit")


def keyed_update(target: DataFrame, patch: DataFrame, key: str, column: str, new_column: str = "new_value") -> DataFrame:
    """UPDATE target SET column = patch.new WHERE key matches.

    A matched key takes the patch value even when it is NULL (not a coalesce);
    unmatched rows keep their value.  A key with several patch rows raises when
    a target row asks for it (a scalar lookup must find one row at most); the
    check is part of the plan.
    """
    p = patch.groupBy(F.col(key)).agg(F.first(new_column).alias("_one"), F.count(F.lit(1)).alias("_n"))
    out = target.join(p, on=key, how="left")
    several = F.raise_error(F.concat(F.lit("several patch rows for key "), F.col(key).cast("string")))
    new = F.when(F.col("_n").isNull(), F.col(column)).when(F.col("_n") == 1, F.col("_one")).otherwise(several)
    return out.withColumn(column, new).drop("_one", "_n")

