"""Word positions of documents and their join with a small token index (operators 1 and 6).

The main path is DataFrame code only: one ``posexplode`` of the word array, a hash of the words at a position and a
broadcast hash join, all inside one whole-stage-codegen span, so the word array is referenced, never copied, and a
match is verified beside the scan.  The index side is cut into blocks of a bounded row count (``common.blocks``) and
one pass over the documents is made per block, so no broadcast grows with the benchmark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import alnum_words, text_key


def with_words(docs: DataFrame) -> DataFrame:
    """(doc_id, tk, words) of every document row; extra columns are left behind."""
    return docs.select("doc_id", text_key().alias("tk"), alnum_words(F.col("text")).alias("words"))


def shingle_hash(words: Column, at: Column, width: int) -> Column:
    """Hash of the ``width`` words from position ``at`` (from 0)."""
    return F.xxhash64(*[F.get(words, at + i) for i in range(width)])


def positions(docs: DataFrame, width: int) -> DataFrame:
    """Every shingle position of every document: (doc_id, tk, words, pos from 0, h)."""
    x = with_words(docs).select("doc_id", "tk", "words", F.posexplode("words").alias("pos", "_w"))
    return x.where(F.col("pos") <= F.size("words") - width).select(
        "doc_id", "tk", "words", "pos", shingle_hash(F.col("words"), F.col("pos"), width).alias("h"))


def token_counts(docs: DataFrame, width: int, wanted: list[DataFrame]) -> DataFrame:
    """Occurrences over all documents of the wanted shingle hashes (blocks of ``h``): (h, n)."""
    out = None
    for block in wanted:
        hits = positions(docs, width).select("h").join(F.broadcast(block.select("h").distinct()), "h", "left_semi")
        part = hits.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out
