"""License scan: exact set-similarity join of text blocks with license templates (native DataFrame code).

Method.  A template is a word list with a containment threshold: so many of its distinct words must be in a block.  For a
template of ``span`` words (repeated ones counted) a block is any 2 * span consecutive words of a text, at any start.
Template words are ordered by their frequency in all documents (rarest first).  A block meeting the threshold must hold
one of the template's first ``|t| - need + 1`` distinct words in that order (prefix); the word's rank bounds what can
still overlap (positional filter), and the text must have enough words (length filter).  Around every occurrence of such a
word the template words of all blocks that hold it are counted first (an upper bound); where that suffices, each block is
verified by exact set intersection.  Only blocks that start with a template word are compared: any other holds no more
than the one that starts at its first template word.  A template marked as a phrase has threshold 1, its block is its own
length, and its words must stand consecutively; its rarest word's offset then fixes the only possible start.

A notice of fewer than ``SHORT_NOTICE`` words needs all of its distinct words (threshold 1), as it differs from other
licenses' by a single word; longer ones need ``THRESHOLD`` of them.

The index of templates is broadcast in blocks of at most ``BROADCAST_WORDS`` words, one pass over the documents each.

Defined results.  Null or word-less texts have no labels, n_words 0 and score 0.  Repeated rows get equal results.
Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm.common import blocks, union_all, write
from scorewright.llm.phrases import positions, token_counts, with_words

#: The phrases that the base columns count: (label, words).
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

#: Notices for the containment join: (label, words).
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
)
THRESHOLD = 0.8
SHORT_NOTICE = 10
#: Template words in one broadcast block of the index.
BROADCAST_WORDS = 2_000_000


def templates(phrases=PHRASES, notices=NOTICES, threshold: float = THRESHOLD) -> list[tuple]:
    """(tid, label, phrase?, words, need, span): ``need`` of the distinct words must be in a block; span counts all words."""
    rows = [(label, True, t.split(), len(t.split()), len(t.split())) for label, t in phrases]
    for label, t in notices:
        words = list(dict.fromkeys(t.split()))
        need = len(words) if len(words) < SHORT_NOTICE else math.ceil(threshold * len(words))
        rows.append((label, False, words, need, len(t.split())))
    return [(i, *r) for i, r in enumerate(rows)]


def prefix_index(spark: SparkSession, docs: DataFrame, rows: list[tuple]) -> DataFrame:
    """(h, tid, label, phrase, t_words, need, span, m, off), written: each template under the words of its prefix."""
    t = spark.createDataFrame(rows, "tid int, label string, phrase boolean, t_words array<string>, need int, span int")
    tok = t.select("*", F.posexplode("t_words").alias("off", "tw")).withColumn("h", F.xxhash64("tw"))
    wanted = tok.select("h").distinct()
    counts = write(spark, token_counts(docs, 1, blocks(wanted, sum(len(r[3]) for r in rows), F.col("h"))), "template-words")
    order = F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "off")))
    ranked = tok.join(counts, "h", "left").groupBy("tid", "label", "phrase", "t_words", "need", "span").agg(order.alias("o"))
    ranked = ranked.select("*", F.size("o").alias("m"), F.posexplode("o").alias("rank", "e"))
    # positional filter: a first match at this rank leaves at most m - rank words of overlap
    out = ranked.where(F.when(F.col("phrase"), F.col("rank") == 0).otherwise(F.col("m") - F.col("rank") >= F.col("need"))
                       ).select("e.h", "tid", "label", "phrase", "t_words", "need", "span", "m", "e.off")
    return write(spark, out, "template-index")


def overlap(start, length):
    """Distinct template words among ``length`` words of the text from ``start`` (from 0)."""
    return F.size(F.array_intersect("t_words", F.slice("words", start + 1, length)))


def matches(spark: SparkSession, docs: DataFrame, rows: list[tuple] | None = None) -> DataFrame:
    """All verified blocks, written: (doc_id, tk, tid, label, phrase, start from 0, share of the template found)."""
    index = prefix_index(spark, docs, rows or templates())
    words = index.agg(F.sum(F.size("t_words"))).first()[0] or 0
    at, off, span, m, need, start = (F.col(c) for c in ("pos", "off", "span", "m", "need", "start"))
    low = F.greatest(at - 2 * span + 1, F.lit(0))
    found = []
    for block in blocks(index, words, F.struct("tid", "h"), BROADCAST_WORDS):
        # conditions are built-ins with generated code only: word arrays are referenced, not copied, up to the verified rows
        x = positions(docs, 1).join(F.broadcast(block), "h").where(F.size("words") >= need)
        x = x.where(F.col("phrase") | (overlap(low, at + 2 * span - low) >= need))
        x = x.withColumn("start", F.explode(F.when(F.col("phrase"), F.array(at - off)).otherwise(F.sequence(low, at))))
        x = x.where((start >= 0) & F.array_contains("t_words", F.get("words", start)))
        got = F.when(F.col("phrase"), m * (F.slice("words", start + 1, span) == F.col("t_words")).cast("int")).otherwise(
            overlap(start, 2 * span))
        found.append(x.withColumn("got", got).where(F.col("got") >= need).select(
            "doc_id", "tk", "tid", "label", "phrase", "start", (F.col("got") / m).alias("share")))
    return write(spark, union_all(found).distinct(), "license-blocks")


def scan(spark: SparkSession, docs: DataFrame, rows: list[tuple] | None = None) -> DataFrame:
    """One row per document row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = matches(spark, docs, rows)
    base = F.when(F.col("phrase"), F.col("start")).cast("long")
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    got = found.groupBy(F.col("doc_id").alias("_d"), F.col("tk").alias("_t")).agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        joined(F.when(F.col("phrase"), F.col("label"))).alias("base_labels"), joined("label").alias("labels"),
        F.max("share").alias("score"))
    all_docs = with_words(docs).select("doc_id", "tk", F.size("words").cast("long").alias("n_words"))
    out = all_docs.join(got, all_docs.doc_id.eqNullSafe(F.col("_d")) & (all_docs.tk == F.col("_t")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word",
                      "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                      F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
