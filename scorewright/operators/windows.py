"""Ranking windows (SURVEY E).

A filter on rank = 1 directly over the ranked rows plans as a partial and a
final WindowGroupLimit: each task trims its rows before the shuffle, so a hot
key ships few rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewright.sources.sinks import Workspace, materialise

HOT_ROWS = 1_000_000    # rows of one key that a single task may number
TRACKED = 100_000       # keys that the sketch of frequent ones holds


def top1(df: DataFrame, key: Sequence[str] | str, order: Sequence[Column], name: str = "_rn") -> DataFrame:
    """One row per key: the first by ``order`` (pass a tie-breaker as the last order column)."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) == 1).drop(name)


def latest_per_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[Column], name: str = "rnk") -> DataFrame:
    """Rows ranked first per key; ties are kept (rank, not row_number). Keeps the rank column."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn(name, F.rank().over(Window.partitionBy(*keys).orderBy(*order)))


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_h_{k}"]) for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], more_than: int, tracked: int = TRACKED) -> DataFrame | None:
    """The keys of more than ``more_than`` rows (columns ``_h_<key>``), None if there are none.

    One pass over the key columns builds a mergeable frequent-items sketch of
    the keys' hashes (a few MB, no shuffle); exact counts are then taken of its
    candidates only.  Found for certain are keys that also have more than
    ``6 / tracked`` of all rows: with 100,000 tracked, every key of a million
    rows among up to 16 billion.
    """
    at = f"xxhash64({', '.join(f'`{k}`' for k in keys)})"
    sketch = df.selectExpr(f"approx_top_k({at}, {tracked // 5}, {tracked}) AS t").first()[0]
    candidates = [r["item"] for r in sketch if r["count"] > more_than]
    if not candidates:
        return None
    counts = df.where(F.expr(at).isin(candidates)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > more_than).select(*[F.col(k).alias(f"_h_{k}") for k in keys])


def with_sequence(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "seq",
                  hot_rows: int = HOT_ROWS, work: Workspace | None = None) -> DataFrame:
    """1..n (long) per group in the given order.

    Keys of up to ``hot_rows`` rows are numbered by a window.  The rows of
    larger ones (``hot_keys``) are range-partitioned by key and order and
    written, numbered inside each partition, and shifted by the rows the key
    has in the partitions before: no task sees all rows of a hot key.  Both
    ways give the same numbers.
    """
    plain = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    found = hot_keys(df, keys, hot_rows)
    if found is None:
        return plain
    hot = materialise(found, "table", "hot-keys", work)
    if hot.isEmpty():
        return plain
    cold = df.join(hot, _same(df, hot, keys), "left_anti")
    cold = cold.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.join(hot, _same(df, hot, keys), "left_semi").repartitionByRange(parts, *keys, *order)
    ranged = materialise(ranged.withColumn("_pid", F.spark_partition_id()), "table", "ranged", work)
    counts = ranged.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_pid")) - F.col("_n")
    counts = counts.select(F.col("_pid").alias("_h__pid"), *[F.col(k).alias(f"_h_{k}") for k in keys],
                           before.alias("_before"))
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order)))
    hot_rows_numbered = local.join(counts, _same(local, counts, ["_pid", *keys])).withColumn(
        name, F.col("_rn") + F.col("_before"))
    return cold.unionByName(hot_rows_numbered.select(*df.columns, name))
