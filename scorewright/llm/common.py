"""Helpers shared by the training-data operators.

Row identity.  ``doc_id`` may be null or repeated, so a document row is
identified by (doc_id, xxhash64(text)): repeated rows share one identity and one
result, and rows that share an id but not a text stay apart.

Written tables.  Intermediate tables that are read more than once, and every
lineage cut of an iteration, are Parquet tables in the folder that
``spark.checkpoint.dir`` names (shared by all executors).  ``drop_written``
deletes those that nothing reads any more.
"""

from __future__ import annotations

import math
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.session import scratch_path
from scorewright.sources.sinks import delete_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"      # word characters: 0-9, a-z and everything beyond ASCII
BLANKS = r"[\x20\x09-\x0D]+"

#: A table is broadcast only in blocks of at most this many rows (of a few dozen bytes each).
BROADCAST_ROWS = 400_000


def by_value(module: str) -> None:
    """Ship the module's functions to the Python workers by value: executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only; ASCII texts take the fast built-in, others a character map."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def alnum_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; null has none."""
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def blank_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_key(text: str = "text") -> Column:
    """Second half of a row's identity (0 for a null text)."""
    return F.coalesce(F.xxhash64(F.col(text)), F.lit(0))


def write(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def drop_written(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables that ``write`` made and nothing reads any more."""
    for t in tables:
        delete_path(spark, t.written_to)


def matched(docs: DataFrame, rows: DataFrame, how: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Join documents with ``rows`` (doc_id, tk, extra columns) on the identity of a row.

    The documents' columns come back as ``_c0``, ``_c1`` ... in their order, so that no name of theirs can clash with
    another; ``toDF(*docs.columns)`` on these restores the names.
    """
    d = docs.toDF(*numbered(docs))
    at = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    r = rows.select(F.col("doc_id").alias("_d"), F.col("tk").alias("_t"), *extra)
    on = F.col(at["doc_id"]).eqNullSafe(F.col("_d")) & (text_key(at["text"]) == F.col("_t"))
    out = d.join(r, on, how)
    return out if how in ("left_anti", "left_semi") else out.select(*d.columns, *extra)


def numbered(docs: DataFrame) -> list[str]:
    return [f"_c{i}" for i in range(len(docs.columns))]


def blocks(df: DataFrame, rows: int, key: Column, bound: int = BROADCAST_ROWS) -> list[DataFrame]:
    """``df`` cut by hash of ``key`` into blocks of about ``bound`` rows, each small enough to broadcast.

    ``rows`` is the measured row count of ``df``.  The key must be (near) unique so that blocks come out even.
    """
    n = max(1, math.ceil(rows / bound))
    if n == 1:
        return [df]
    return [df.where(F.pmod(F.xxhash64(key, F.lit("block")), F.lit(n)) == i) for i in range(n)]


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def units(members: DataFrame, key: list[str], spread: Column, cap: int, weight: Column | None = None,
          most: int = 1) -> DataFrame:
    """Split every group of ``key`` into work units of at most about ``2 * cap`` members.

    A group of up to ``cap`` members is one unit.  A larger one is cut by the hash of ``spread`` into blocks of about
    ``cap``, and its units are the pairs of blocks, so any two members meet in some unit and no task holds a whole
    group.  With a ``weight`` of each member, a block has a weight of about ``most`` too (one member at least).  Adds
    ``unit`` (long) and ``side``: 0 in the unit of one block, whose members meet each other there, 1 and 2 for the two
    blocks of the others, so that each pair can be counted once.  Rows of a large group are repeated once per block.
    Groups of one are dropped.
    """
    sizes = members.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.lit(0) if weight is None else weight).alias("_w"))
    x = members.join(sizes.where("_n > 1"), key)
    nb = F.least(F.col("_n"), F.greatest(F.ceil(F.col("_n") / F.lit(cap)), F.ceil(F.col("_w") / F.lit(most)))).cast("int")
    x = x.withColumn("_nb", nb).withColumn("_b", F.pmod(F.xxhash64(spread, F.lit("unit")), F.col("_nb")).cast("int"))
    x = x.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    side = F.when(F.col("_b") == F.col("_o"), 0).when(F.col("_b") < F.col("_o"), 1).otherwise(2)
    return x.withColumn("unit", F.xxhash64(*key, F.least("_b", "_o"), F.greatest("_b", "_o"))).withColumn(
        "side", side).drop("_n", "_w", "_nb", "_b", "_o")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges(a, b)`` (non-null, of one type), written: ``(node, root)``.

    The root is the component's least node.

    Alternating large-star and small-star rounds, each an aggregate and a join, written to the shared folder.  Self
    edges only keep their node.  A count and a checksum per round reach the driver.
    """
    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    cur = write(spark, edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    at = state(cur)
    while at[0]:
        # large-star: neighbours above a node point to the least of the node and its neighbours
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(
            F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        # small-star: the node and its lower neighbours point to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        nxt = write(spark, small.unionByName(low.withColumnRenamed("m", "b")).distinct(), "cc")
        drop_written(spark, cur)
        cur, before, at = nxt, at, state(nxt)
        if at == before:
            break
    out = nodes.join(cur.withColumnRenamed("a", "node"), "node", "left").select(
        "node", F.coalesce("b", "node").alias("root"))
    out = write(spark, out, "components")
    drop_written(spark, cur)
    return out


def map_texts(docs: DataFrame, fn, columns: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
              slab: int = 4_000_000) -> DataFrame:
    """Apply ``fn(list of texts) -> dict of lists`` to the documents in Arrow batches, beside the ``keep`` columns.

    ``columns`` is the DDL of what ``fn`` returns.  A null text reaches ``fn`` as the empty string.  ``fn`` gets at most
    about ``slab`` characters at once (one text at least), so memory is bounded by the longest text.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    src = docs.select(*keep) if text in keep else docs.select(*keep, F.col(text).alias("_text"))
    text_at = keep.index(text) if text in keep else len(keep)
    made = StructType.fromDDL(columns)
    schema = StructType([src.schema[c] for c in keep] + made.fields)
    arrow = to_arrow_schema(made)
    names = list(keep)

    def run(batches):
        for batch in batches:
            texts = batch.column(text_at)
            at = 0
            while at < batch.num_rows:
                part, size = [], 0
                while at + len(part) < batch.num_rows and (not part or size < slab):
                    part.append(texts[at + len(part)].as_py() or "")
                    size += len(part[-1])
                out = fn(part)
                cols = [batch.column(i).slice(at, len(part)) for i in range(len(names))]
                cols += [pa.array(out[f.name], f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(cols, names=names + arrow.names)
                at += len(part)

    return src.mapInArrow(run, schema)
