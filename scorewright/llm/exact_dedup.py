"""Exact dedup by content sort: sampled splitters range-partition the bytes, an external sort, neighbours compared.

Method.

1. Every task replaces the equal texts of an Arrow batch by one row (text, rows, best id, rows with that id), so a text
   that a third of all rows have crosses the shuffle once per batch.
2. ``repartitionByRange`` samples splitters of the order (first bytes, hash of the whole text, salt).  Equal texts are
   neighbours in this order.  The first two parts keep a splitter small however long the texts are; the salt lets
   splitters fall inside the rows of one text, so a text with very many rows is dealt over several ranges, and texts
   with a common beginning are dealt by their hash.
3. ``sortWithinPartitions`` on (first bytes, hash, whole text) sorts each range, on disk if need be.  One stream over a
   range compares each text with its neighbour, byte by byte, and adds up groups.  It holds two texts at a time.
4. A range reports its groups of several rows, and its first and last group in any case: only these can go on in another
   range.  Reports of one text are added up.
5. Groups meet the documents again by the SHA-256 of the text, which carries decisions of step 3 and makes none.

Defined results.  A null text counts as empty.  Null ids take part in groups; one stays only if a group has no other id.
Of repeated rows with the id that stays one is kept.  An empty table gives no rows.  Extra columns are ignored by
``copies`` and returned unchanged by ``drop_copies``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm.common import by_value, numbered, write

by_value(__name__)

HEAD = 32       # bytes of a text in a splitter


def unchanged(text: Column) -> Column:
    return text


def content(text: Column, normalise: Callable[[Column], Column]) -> Column:
    return F.coalesce(normalise(F.coalesce(text, F.lit(""))), F.lit(""))


def better(a, b, largest: bool):
    """Whether id ``a`` stays before id ``b``; null ids come last."""
    if a is None or b is None:
        return b is None and a is not None
    return a > b if largest else a < b


def merged(x: tuple, y: tuple, largest: bool) -> tuple:
    """(rows, best id, rows with that id) of two groups of one text together."""
    if x[1] == y[1]:
        return x[0] + y[0], x[1], x[2] + y[2]
    best = x if better(x[1], y[1], largest) else y
    return x[0] + y[0], best[1], best[2]


def collapsed(rows: DataFrame, largest: bool) -> DataFrame:
    """(doc_id, body) -> (body, n, best, top): the rows of a batch with one text become one."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            groups: dict = {}
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                b = body.as_py()
                old = groups.get(b)
                groups[b] = (1, i, 1) if old is None else merged(old, (1, i, 1), largest)
            if groups:
                n, best, top = zip(*groups.values())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(groups, pa.binary()), pa.array(n, pa.int64()), pa.array(best, pa.int64()),
                     pa.array(top, pa.int64())], names=["body", "n", "best", "top"])

    return rows.mapInArrow(run, "body binary, n long, best long, top long")


def neighbours(ranges: DataFrame, largest: bool) -> DataFrame:
    """Groups of equal neighbours in sorted ranges: (text_sha256, n, best, top), see steps 3 and 4."""
    import hashlib

    import pyarrow as pa

    names = ["text_sha256", "n", "best", "top"]

    def batch_of(rows):
        sha, n, best, top = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(sha, pa.string()), *(pa.array(c, pa.int64()) for c in (n, best, top))], names)

    def run(batches):
        now, group, first, out = None, None, True, []
        for batch in batches:
            for at, body in enumerate(batch.column(0)):
                row = tuple(batch.column(k)[at].as_py() for k in (1, 2, 3))
                body = body.as_py()
                if body == now:
                    group = merged(group, row, largest)
                    continue
                if now is not None:
                    if first or group[0] > 1:
                        out.append((hashlib.sha256(now).hexdigest(), *group))
                    first = False
                now, group = body, row
            if len(out) >= 10_000:
                yield batch_of(out)
                out = []
        if now is not None:
            out.append((hashlib.sha256(now).hexdigest(), *group))
        if out:
            yield batch_of(out)

    return ranges.mapInArrow(run, "text_sha256 string, n long, best long, top long")


def groups_of_copies(spark: SparkSession, docs: DataFrame, largest: bool = False,
                     normalise: Callable[[Column], Column] = unchanged) -> DataFrame:
    """Written table of the texts that several rows have: text_sha256, keep_id, group_size, top (rows with keep_id)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content(F.col("text"), normalise).cast("binary").alias("body"))
    keyed = collapsed(rows, largest).select("body", "n", "best", "top", F.substring("body", 1, HEAD).alias("head"),
                                            F.xxhash64("body").alias("h"))
    ranges = keyed.repartitionByRange("head", "h", F.xxhash64("best", "n"))
    found = neighbours(ranges.sortWithinPartitions("head", "h", "body").select("body", "n", "best", "top"), largest)
    by_id = found.groupBy("text_sha256", "best").agg(F.sum("n").alias("n"), F.sum("top").alias("top"))
    first = F.max(F.struct("best", "top")) if largest else F.min(F.struct(F.isnull("best"), "best", "top"))   # null ids last
    out = by_id.groupBy("text_sha256").agg(F.sum("n").alias("group_size"), first.alias("o")).where("group_size > 1")
    return write(spark, out.select("text_sha256", F.col("o.best").alias("keep_id"), "group_size", F.col("o.top").alias("top")),
                 "copy-groups")


def copies(spark: SparkSession, docs: DataFrame, largest: bool = False,
           normalise: Callable[[Column], Column] = unchanged) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256."""
    groups = groups_of_copies(spark, docs, largest, normalise)
    rows = docs.select("doc_id", F.sha2(content(F.col("text"), normalise), 256).alias("text_sha256")).join(groups, "text_sha256", "left")
    out = rows.select("doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256", "top")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    if groups.where("top > 1").isEmpty():
        return out.withColumn("kept", stays).select(*columns)
    # repeated rows of the id that stays: counted, then given back one by one, the first as kept
    tied = stays & F.coalesce(F.col("top") > 1, F.lit(False))
    again = out.where(tied).groupBy("doc_id", "keep_id", "group_size", "text_sha256").agg(F.count(F.lit(1)).alias("c"))
    again = again.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "c")).alias("k"))
    return out.where(~tied).withColumn("kept", stays).select(*columns).unionByName(
        again.withColumn("kept", F.col("k") == 1).select(*columns))


def drop_copies(spark: SparkSession, docs: DataFrame, largest: bool = False,
                normalise: Callable[[Column], Column] = unchanged) -> DataFrame:
    """The documents that stay, with their own columns."""
    groups = groups_of_copies(spark, docs, largest, normalise).toDF("_sha", "_keep", "_size", "_top")
    names = numbered(docs)
    id_at, text_at = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    d = docs.toDF(*names)
    rows = d.join(groups, F.sha2(content(F.col(text_at), normalise), 256) == F.col("_sha"), "left")
    alone = rows.where(F.col("_sha").isNull() | (F.col(id_at).eqNullSafe(F.col("_keep")) & (F.col("_top") == 1)))
    tied = rows.where(F.col(id_at).eqNullSafe(F.col("_keep")) & (F.col("_top") > 1)).dropDuplicates(["_sha"])
    return alone.select(*names).unionByName(tied.select(*names)).toDF(*docs.columns)
