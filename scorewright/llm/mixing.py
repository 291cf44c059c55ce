"""Mixing sources to target weights by temperature (native DataFrame code).

Method.  A source's share of all tokens is raised to an exponent between 0 (all sources alike) and 1 (natural shares)
and the results are normalised to weights.  The exponent is bisected to the largest value whose weights reach the
target entropy, and raised again, by bisection, if a source would be repeated more often than the limit allows.  Each
aggregate over the source table tests the 15 inner points of four halvings at once.

The weights are realised within a token budget.  A source's documents fall into blocks by hash.  In every epoch the
blocks are put into a new random order; full epochs take every block, the last epoch takes blocks in order while the
source's budget lasts, and the block in which it ends is taken document by document in random order, so a source never
exceeds its budget.  No task sees more than one block of documents or ``MAX_BLOCKS`` block rows of a source.

A result row is one use of a document: ``epoch``, ``block``, and ``stream_at`` in [0, 1), its block's place in its
source's schedule.  Reading the rows in order of ``stream_at`` mixes the sources at the target weights throughout.

Defined results.  Tokens are words ``[^\\x20\\x09-\\x0D]+``; a text without any has 0 tokens and costs nothing.  A null
source is a source of its own; a source without tokens has weight 0 and no rows.  Repeated rows are separate documents
of the same rank.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorewright.llm.common import blank_words, write

ENTROPY = 0.95          # target entropy as a share of the largest possible
MAX_EPOCHS = 4.0        # most often that a source may be repeated
SEED = "mix"
BLOCK_DOCS = 256        # documents of a block, as long as a source has at most MAX_BLOCKS blocks
MAX_BLOCKS = 65_536
ROUNDS = 10             # of four halvings each


def ticket(*parts: Column) -> Column:
    """Uniform integer below 2**60 from the parts."""
    text = F.concat_ws("|", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens, tk) of every document row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", "source", F.size(blank_words(F.col("text"))).cast("long").alias("n_tokens"),
                       F.md5(text.cast("binary")).alias("tk"))


def tested(sources: DataFrame, budget: float, total: float, points: list[float]) -> dict[float, tuple[float, float]]:
    """Entropy and largest repetition of the weights at every exponent (one aggregate over the source table)."""
    x = sources.where("tokens > 0").select((F.col("tokens") / F.lit(total)).alias("s"),
                                           F.explode(F.array(*map(F.lit, points))).alias("a"))
    x = x.groupBy("a").agg(F.sum(F.pow("s", F.col("a"))).alias("z"),
                           F.sum(F.pow("s", F.col("a")) * F.log("s")).alias("e"),
                           F.max(F.pow("s", F.col("a") - 1)).alias("r"))
    return {a: (math.log(z) - a * e / z, r / z * budget / total) for a, z, e, r in x.collect()}


def bisect(good, low: float, high: float, rounds: int = ROUNDS) -> tuple[float, float]:
    """Narrow [low, high], with ``good(points) -> [bool]`` true below some point, to 2**-(4 * rounds) of its width."""
    for _ in range(rounds):
        step = (high - low) / 16
        points = [low + i * step for i in range(1, 16)]
        n = sum(good(points))
        low, high = low + n * step, low + (n + 1) * step
    return low, high


def exponent(sources: DataFrame, budget: float, total: float, n_sources: int, entropy: float = ENTROPY,
             max_epochs: float = MAX_EPOCHS) -> float:
    """The exponent for the target entropy, raised as far as the repetition limit demands (1 if nothing meets it)."""
    goal = entropy * math.log(max(n_sources, 1))
    ends = tested(sources, budget, total, [0.0, 1.0])
    at = 1.0
    if ends[1.0][0] < goal:
        def reaches(points):
            got = tested(sources, budget, total, points)
            return [got[p][0] >= goal for p in points]
        at = bisect(reaches, 0.0, 1.0)[0]
    if tested(sources, budget, total, [at])[at][1] > max_epochs:
        def repeats(points):
            got = tested(sources, budget, total, points)
            return [got[p][1] > max_epochs for p in points]
        at = bisect(repeats, at, 1.0)[1]
    return at


def weights(spark: SparkSession, rows: DataFrame, budget: int | None = None, entropy: float = ENTROPY,
            max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, docs, tokens, weight, goal): goal is the source's token budget."""
    sources = write(spark, rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens")),
                    "sources")
    total, n = sources.where("tokens > 0").agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not n:
        return sources.where(F.lit(False)).withColumn("weight", F.lit(0.0)).withColumn("goal", F.lit(0).cast("long"))
    budget = float(total if budget is None else budget)
    a = exponent(sources, budget, float(total), n, entropy, max_epochs)
    z = sources.where("tokens > 0").agg(F.sum(F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a)))).first()[0]
    w = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a)) / F.lit(z)
    return sources.where("tokens > 0").withColumn("weight", w).withColumn(
        "goal", F.round(F.col("weight") * F.lit(budget)).cast("long"))


def mix(spark: SparkSession, docs: DataFrame, budget: int | None = None, entropy: float = ENTROPY,
        max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """The uses of the documents: doc_id, source, n_tokens, weight, epoch, block, stream_at."""
    rows = write(spark, counted(docs), "mix-tokens")
    plan = weights(spark, rows, budget, entropy, max_epochs).withColumn(
        "n_blocks", F.least(F.ceil(F.col("docs") / BLOCK_DOCS), F.lit(MAX_BLOCKS)).cast("long"))
    plan = write(spark, plan.withColumn("full", F.floor(F.col("goal") / F.col("tokens")).cast("int")), "mix-plan")
    # a small table with one row per source: Spark broadcasts it if its measured size allows, else splits hot sources
    p = plan.select(F.col("source").alias("_s"), "weight", "n_blocks", "full", "tokens", "goal")
    dealt = rows.join(p.select("_s", "n_blocks"), rows.source.eqNullSafe(F.col("_s"))).select(
        "doc_id", "source", "n_tokens", "tk", F.pmod(ticket(F.col("doc_id"), F.col("tk")), F.col("n_blocks")).cast(
            "int").alias("block"))
    dealt = write(spark, dealt, "mix-dealt")
    blocks = dealt.groupBy("source", "block").agg(F.sum("n_tokens").alias("b_tokens"))
    sched = blocks.join(p, blocks.source.eqNullSafe(F.col("_s"))).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.col("full"))))
    w = Window.partitionBy("source", "epoch").orderBy(ticket(F.col("source"), F.col("epoch"), F.col("block")), "block")
    sched = sched.withColumn("place", F.row_number().over(w) - 1).withColumn(
        "before", F.sum("b_tokens").over(w) - F.col("b_tokens"))
    left = F.when(F.col("epoch") < F.col("full"), F.col("tokens")).otherwise(
        F.col("goal") - F.col("full") * F.col("tokens")) - F.col("before")
    at = (F.col("epoch") + F.col("place") / F.col("n_blocks")) / (F.col("full") + 1)
    sched = sched.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "weight", "epoch", "b_tokens",
                         left.alias("left"), at.alias("stream_at")).where((F.col("epoch") < F.col("full")) | (F.col("left") > 0))
    sched = write(spark, sched, "mix-schedule")
    on = dealt.source.eqNullSafe(F.col("_s")) & (dealt.block == F.col("_b"))
    out = ["doc_id", "source", "n_tokens", F.round("weight", 6).alias("weight"), "epoch", "block", "stream_at"]
    whole = dealt.join(sched.where("b_tokens <= left"), on).select(*out)
    w = Window.partitionBy("source", "epoch", "block").orderBy(
        ticket(F.col("epoch"), F.col("doc_id"), F.col("tk")), "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    last = dealt.join(sched.where("b_tokens > left"), on).withColumn("spent", F.sum("n_tokens").over(w))
    return whole.unionByName(last.where("spent <= left").select(*out))
