"""Label handling shared by the two classifiers (operators 2 and 8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def remainder(parts: int) -> Column:
    """crc32(doc_id as text) mod ``parts``; null for a null doc_id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))


def held_out(parts: int, fold: int) -> Column:
    """Rows labels are never learnt from; a row with a null doc_id can't have a label and counts as not held out."""
    return F.coalesce(remainder(parts) == fold, F.lit(False))


def training_labels(labels: DataFrame, column: str, parts: int, fold: int, limit: int) -> DataFrame:
    """(doc_id, y) of at most ``limit`` labelled rows outside the held-out fold.

    One label per doc_id (the larger, when rows disagree); null ids and null labels are dropped.  The sample is the
    ids with the smallest hashes, the same on every run; it is the documented bound of what the fits learn from.
    """
    x = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out(parts, fold))
    x = x.groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("y"))
    return x.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def training_rows(rows: DataFrame, arrays: tuple[str, ...], max_rows: int, max_numbers: int) -> DataFrame:
    """The rows (doc_id, y, ``arrays``) that a fit on the driver gets: at most ``max_rows`` with ``max_numbers`` in all.

    They come in the order of the ids' hashes, the same on every run.  A row with more than a hundredth of
    ``max_numbers`` teaches nothing, so that no single text can use the bound up.
    """
    sized = rows.withColumn("_size", sum((F.size(a) for a in arrays), F.lit(0)).cast("long")).withColumn(
        "_order", F.struct(F.xxhash64("doc_id"), F.col("doc_id"), F.xxhash64(*arrays)))
    first = sized.where(F.col("_size") <= max_numbers // 100).orderBy("_order").limit(max_rows)
    used = F.sum("_size").over(Window.orderBy("_order").rowsBetween(Window.unboundedPreceding, 0))
    return first.withColumn("_used", used).where(F.col("_used") <= max_numbers).select("doc_id", "y", *arrays)
