"""The corpus pipeline: quality rules, line dedup, near duplicates, decontamination, source mixing.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; all but the last return the
columns of documents.  ``run`` writes every stage's rows as Parquet into the shared folder and reads them back as the
next stage's documents, so a lost executor never reaches back beyond one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorewright.llm import decontaminate, linededup, mixing, ngram_join, repetition
from scorewright.llm.common import documents, write

NEAR_WORDS, NEAR_PERCENT = 5, 80    # near duplicates of a corpus: 5-word shingles, Jaccard similarity of 0.8 or more


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go (operator 10)."""
    return repetition.drop_rejected(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that are equal or within the edit threshold the first stays; emptied documents go (operator 3)."""
    return linededup.drop_duplicate_lines(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest doc_id stays (operator 9, at the corpus rule's values)."""
    return ngram_join.keep_one(spark, docs, NEAR_WORDS, NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go (operator 1)."""
    return decontaminate.drop_contaminated(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The schedule of uses of the documents that remain, at the target weights (operator 7)."""
    return mixing.mix(spark, docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: The suffix-array verdict and the edit-distance classes are not expressible in SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = write(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
