"""Registered queries of the training-data operators (thin: each applies one operator to its whole table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorewright.llm import (
    decontaminate,
    exact_dedup,
    hard_negatives,
    licenses,
    linededup,
    mixing,
    ngram_join,
    pii,
    quality,
    repetition,
    spelling,
    toxicity,
    warc,
)
from scorewright.llm.common import documents
from scorewright.llm.oracles import ORACLES  # noqa: F401


def op1_decontamination(spark, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contamination(spark, documents(spark, sf_dir), bench).drop("tk")


def op2_toxicity(spark, sf_dir):
    return toxicity.classify(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_line_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = linededup.dedup(spark, docs).toDF("doc_id", "text", "lines")
    return out.select("doc_id", F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_removed"),
                      F.coalesce(F.array_join("lines", ","), F.lit("")).alias("removed"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op4_personal_data(spark, sf_dir):
    return pii.find(documents(spark, sf_dir))


def op5_warc(spark, sf_dir):
    return warc.captures(spark, spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("run", "place")


def op6_license_scan(spark, sf_dir):
    return licenses.scan(spark, documents(spark, sf_dir))


def op7_mixing(spark, sf_dir):
    return mixing.mix(spark, documents(spark, sf_dir))


def op8_quality(spark, sf_dir):
    return quality.classify(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_ngram_jaccard(spark, sf_dir):
    return ngram_join.link(spark, documents(spark, sf_dir)).drop("tk", "root")


def op10_quality_rules(spark, sf_dir):
    return repetition.verdicts(documents(spark, sf_dir)).drop("longest_repeat")


def op11_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_spelling_variants(spark, sf_dir):
    return spelling.variants(spark, documents(spark, sf_dir))


def op13_exact_dedup(spark, sf_dir):
    return exact_dedup.copies(spark, documents(spark, sf_dir), largest=True)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_line_dedup": op3_line_dedup,
    "op4_personal_data": op4_personal_data,
    "op5_warc": op5_warc,
    "op6_license_scan": op6_license_scan,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_quality_rules": op10_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_exact_dedup": op13_exact_dedup,
}
