"""Benchmark decontamination: prefix-filtered set join with exact verification (native DataFrame code).

Method.  Every benchmark item is cut into windows of ``width`` consecutive words (an item of fewer words is one
window).  A window is a set of word shingles; a document contains it only if it contains all of them, so with
containment 1 the necessary prefix is the window's single rarest shingle.  The steps:

1. count the benchmark's shingles over all documents (rarity; broadcast semi join, map-side counts);
2. drop windows with a shingle that no document has, and index each other window by its rarest shingle;
3. join document positions with that index; the shingle's offset in the window fixes the only possible start
   (positional bound), and start and window length must fit the document (length bound);
4. compare the words of document and window one to one (exact containment over item-sized windows).

Defined results.  Null or word-less texts have no words, no hits and are not contaminated.  Null or word-less items
have no window.  Repeated rows each get the same result; items with equal texts all count; equal item ids count
once.  The windows of items with a null id hit words like any other; such items are left out of the item list and its
count.  Extra columns of either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorewright.llm.common import alnum_words, blocks, matched, union_all, write
from scorewright.llm.phrases import positions, shingle_hash, token_counts, with_words

WIDTH = 13      # words of a window
SHINGLE = 3     # words of a shingle; shorter windows use all their words


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct (win: array of words, item_id: string) of all items."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                             alnum_words(F.col("text")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return items.select("item_id", "w", F.explode(starts).alias("s")).select(
        F.slice("w", F.col("s"), F.lit(width)).alias("win"), "item_id").distinct()


def rarest_shingles(spark: SparkSession, docs: DataFrame, windows: DataFrame, k: int) -> DataFrame:
    """Index rows (h, off, win) of the windows whose shingles have ``k`` words: each under its rarest shingle."""
    mine = windows.where(F.least(F.size("win"), F.lit(SHINGLE)) == k)
    sh = mine.select("win", F.explode(F.sequence(F.lit(0), F.size("win") - k)).alias("off"))
    sh = sh.select("win", "off", shingle_hash(F.col("win"), F.col("off"), k).alias("h"))
    wanted = write(spark, sh.select("h").distinct(), "shingles")
    counts = write(spark, token_counts(docs, k, blocks(wanted, wanted.count(), F.col("h"))), "rarity")
    order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "off")
    best = sh.join(counts, "h", "left").groupBy("win").agg(F.min(order).alias("b"))
    return best.where("b.n > 0").select("b.h", "b.off", "win")


def occurrences(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, width: int = WIDTH):
    """All verified occurrences (doc_id, tk, start from 1, len, win) and the (win, item_id) pairs, both written."""
    pairs = write(spark, item_windows(benchmark, width), "item-windows")
    wins = pairs.select("win").distinct()
    found = []
    widths = [r[0] for r in wins.select(F.least(F.size("win"), F.lit(SHINGLE)).alias("k")).distinct().collect()]
    for k in sorted(widths):                     # at most SHINGLE values
        index = write(spark, rarest_shingles(spark, docs, wins, k), "window-index")
        for block in blocks(index, index.count(), F.col("win")):
            x = positions(docs, k).join(F.broadcast(block), "h")
            start = F.col("pos") - F.col("off") + 1
            x = x.where((start >= 1) & (start + F.size("win") - 1 <= F.size("words")))
            x = x.where(F.slice("words", start, F.size("win")) == F.col("win"))
            found.append(x.select("doc_id", "tk", start.alias("start"), F.size("win").alias("len"), "win"))
    if not found:
        none = with_words(docs).select("doc_id", "tk", F.lit(1).alias("start"), F.lit(0).alias("len"), "words")
        found = [none.where(F.lit(False)).withColumnRenamed("words", "win")]
    return write(spark, union_all(found), "occurrences"), pairs


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                  share: int = 20) -> DataFrame:
    """One row per document row: doc_id, tk, n_words, n_hit, n_items, items_sha256, contaminated.

    ``contaminated``: n_hit > 0 and ``share`` * n_hit >= n_words.
    """
    occ, pairs = occurrences(spark, docs, benchmark, width)
    row = ["doc_id", "tk"]
    spans = occ.groupBy(*row, "start").agg(F.max("len").alias("len"))
    w = Window.partitionBy(*row).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    spans = spans.withColumn("reach", F.coalesce(F.max(end).over(w), F.lit(0)))
    hit = spans.groupBy(*row).agg(
        F.sum(F.greatest(end - F.greatest("start", "reach"), F.lit(0))).cast("long").alias("n_hit"))
    # collect_list and count leave null ids out
    items = occ.select(*row, "win").distinct().join(pairs, "win").select(*row, "item_id").distinct().groupBy(*row).agg(
        F.count("item_id").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(F.collect_list("item_id")), ","), 256).alias("items_sha256"))
    base = with_words(docs).select(*row, F.size("words").cast("long").alias("n_words"))
    got = hit.join(items, (hit.doc_id.eqNullSafe(items.doc_id)) & (hit.tk == items.tk)).select(
        hit.doc_id.alias("_d"), hit.tk.alias("_t"), "n_hit", "n_items", "items_sha256")
    out = base.join(got, base.doc_id.eqNullSafe(F.col("_d")) & (base.tk == F.col("_t")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(*row, "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                      ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    bad = contamination(spark, docs, benchmark).where("contaminated").select("doc_id", "tk").distinct()
    return matched(docs, bad, "left_anti").toDF(*docs.columns)
