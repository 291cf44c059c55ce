"""Spelling variant grouping by a bit-sliced position index over the vocabulary.

Method.

1. Each task counts the words of whole texts (with the contract's deletions) and Spark adds the counts up; words of at
   least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences are the vocabulary.
2. Two words one edit apart, the shorter of length L, have the first L // 2 or the last L - L // 2 code points in common.
   So a *tile* is the words of lengths L and L + 1 with one such half; every near pair meets in a tile, and a pair that
   meets by both halves is taken by the first.
3. In a tile the words of length L are sliced into bitsets, one per (position, letter) of the rest beside the half (read
   backwards for a common ending).  A word is compared with all of them at once: its letters, in order, update the set of
   words without an error so far and the set with one error, a replaced letter (length L) or, by positions shifted by
   one, a letter too many (length L + 1).  Bits are in order of frequency, so the lowest bit is the most frequent near
   word and a bit count is their number.
4. Tiles above ``CAP`` words are cut: every block of indexed words meets every block of compared ones in a unit of its
   own.  Which tiles can be that large is found by counts of hash buckets before the rows are shuffled.
5. A word's form is its most frequent near word if that is ``FACTOR`` times as frequent; roots follow forms by pointer
   jumping over a written table, at most some five rounds, as counts grow by the factor with every step.

Defined results.  Null and empty texts have no words.  A null id counts as the empty string in the hash.  Repeated rows
count as often as they occur.  Empty tables give no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm.candidates import joined_groups
from scorewright.llm.common import by_value, drop_written, write

by_value(__name__)

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, FACTOR, DIVISOR = 7, 2, 10, 31
CAP = 2_000             # words of a unit's index, and words compared with it
HELD = 200_000          # words that a task counts before it hands them on
BATCH = 10_000


def counted_words(doc_id, text: str, least: int, divisor: int) -> dict[str, int]:
    """Occurrences of the words of one text: lower-cased runs of letters, some with one letter deleted."""
    import zlib
    from collections import Counter

    runs = Counter(re.findall(f"[{LETTERS}]{{{least},}}", text.encode().lower().decode()))     # lower-cases A-Z only
    start = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
    out: dict[str, int] = {}
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % divisor == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
        if len(run) >= least:
            out[run] = out.get(run, 0) + n
    return out


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, divisor: int = DIVISOR) -> DataFrame:
    """(word, n) of all documents."""
    import pyarrow as pa

    def run(batches):
        held: dict[str, int] = {}

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                for w, n in counted_words(doc_id.as_py(), text.as_py() or "", least, divisor).items():
                    held[w] = held.get(w, 0) + n
                if len(held) >= HELD:
                    yield rows()
        if held:
            yield rows()

    counts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def halves(words: DataFrame) -> DataFrame:
    """(tile, indexed, word, n): the tiles of each word; it is indexed in those of its own length."""
    def tiles(size: str) -> str:
        half = f"({size}) div 2"
        return (f"concat('<', {size}, ' ', left(word, cast({half} as int))), "
                f"concat('>', {size}, ' ', right(word, cast({size} - {half} as int)))")

    m = "length(word)"
    return words.selectExpr("word", "n", f"posexplode(array({tiles(m)}, {tiles(m + ' - 1')})) as (p, tile)").select(
        "tile", (F.col("p") < 2).alias("indexed"), "word", "n")


def work_units(spark: SparkSession, words: DataFrame, cap: int) -> DataFrame:
    """(unit, index, query, word, n): units of at most about ``cap`` indexed words and ``cap`` compared ones."""
    rows = halves(words)
    total = words.count()
    n_buckets = max(1 << 16, 64 * total // cap)         # some cap / 16 rows each
    bucket = F.pmod(F.xxhash64("tile"), F.lit(n_buckets))
    large = write(spark, rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > cap).select(
        "bucket"), "large-tiles")
    small = rows.withColumn("bucket", bucket).join(large, "bucket", "left_anti").select(
        F.col("tile").alias("unit"), F.col("indexed").alias("index"), F.lit(True).alias("query"), "word", "n")
    if large.isEmpty():
        return small
    hot = rows.withColumn("bucket", bucket).join(large, "bucket", "left_semi").drop("bucket")
    sizes = hot.groupBy("tile").agg(F.ceil(F.count_if("indexed") / F.lit(cap)).cast("int").alias("ni"),
                                    F.ceil(F.count(F.lit(1)) / F.lit(cap)).cast("int").alias("nq")).where("ni > 0")
    hot = hot.join(sizes, "tile")
    at = F.xxhash64("word", F.lit("block"))
    index = hot.where("indexed").withColumn("i", F.pmod(at, F.col("ni"))).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)))
    query = hot.withColumn("j", F.pmod(at, F.col("nq"))).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ni") - 1)))

    def side(df: DataFrame, is_index: bool) -> DataFrame:
        # the tile stays at the front: a unit's name tells its length and direction
        return df.select(F.concat_ws(" ", "tile", "i", "j").alias("unit"), F.lit(is_index).alias("index"),
                         F.lit(not is_index).alias("query"), "word", "n")

    return small.unionByName(side(index, True)).unionByName(side(query, False))


def sliced(rests: list[str]) -> dict:
    """Bitsets by (position, letter): bit k is set where word k has the letter at the position."""
    out: dict = {}
    for k, rest in enumerate(rests):
        bit = 1 << k
        for at in enumerate(rest):
            out[at] = out.get(at, 0) | bit
    return out


def one_replaced(bits: dict, everything: int, rest: str) -> int:
    """Indexed words of the same length that differ from ``rest`` in exactly one letter."""
    none, one = everything, 0
    for at in enumerate(rest):
        b = bits.get(at, 0)
        one = (one & b) | (none & ~b)
        none &= b
        if not (one or none):
            break
    return one


def one_deleted(bits: dict, everything: int, rest: str) -> int:
    """Indexed words, one letter shorter, that ``rest`` becomes by deleting one letter."""
    none, one = everything, 0
    for i, letter in enumerate(rest):
        one = (one & bits.get((i - 1, letter), 0)) | none
        none &= bits.get((i, letter), 0)
        if not (one or none):
            break
    return one


def places(bits: int):
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def near_in_unit(unit: str, rows: list[tuple]):
    """(word, number of near words, n of the first one, first one) as far as this unit shows; rows (index, query, word, n)."""
    size = int(unit[1:].split(" ", 1)[0])
    half = size // 2
    forward = unit[0] == "<"

    def rest(word: str) -> str:
        return word[half:] if forward else word[:len(word) - (size - half)][::-1]

    index = sorted(((w, n) for i, _, w, n in rows if i), key=lambda x: (-x[1], x[0]))
    queries = [(w, n) for _, q, w, n in rows if q]
    if not index or len(queries) + len(index) < 3 and queries[:1] == index:
        return
    bits, everything = sliced([rest(w) for w, _ in index]), (1 << len(index)) - 1
    longer: dict[int, list] = {}
    for w, n in queries:
        if len(w) == size:
            if found := one_replaced(bits, everything, rest(w)):
                first, count = index[(found & -found).bit_length() - 1], found.bit_count()
                yield w, count, first[1], first[0]
            continue
        found = one_deleted(bits, everything, rest(w))
        if found and not forward:
            for k in places(found):
                if index[k][0][:half] == w[:half]:      # also in the tile of the common beginning
                    found ^= 1 << k
        if found:
            first = index[(found & -found).bit_length() - 1]
            yield w, found.bit_count(), first[1], first[0]
            for k in places(found):
                best = longer.setdefault(k, [0, n, w])
                best[0] += 1
                if (-n, w) < (-best[1], best[2]):
                    best[1:] = n, w
    for k, (count, n, w) in longer.items():
        yield index[k][0], count, n, w


def near_words(spark: SparkSession, words: DataFrame, cap: int = CAP) -> DataFrame:
    """(word, n_near, near_n, near): the number of near words and the most frequent one, of words that have any."""
    import pyarrow as pa

    names = ["word", "c", "near_n", "near"]
    types = (pa.string(), pa.int64(), pa.int64(), pa.string())

    def run(batches):
        out = []
        for group in joined_groups(batches):
            if len(group) > 1:
                out += near_in_unit(group[0][0], [r[1:] for r in group])
            if len(out) >= BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    units = work_units(spark, words, cap).repartition("unit").sortWithinPartitions("unit")
    found = units.mapInArrow(run, "word string, c long, near_n long, near string")
    return found.groupBy("word").agg(F.sum("c").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near_n", "near")).alias("o")).select(
        "word", "n_near", F.col("o.near_n").alias("near_n"), F.col("o.near").alias("near"))


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """Written (word, root) of (word, form): where following the forms ends."""
    cur = write(spark, forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not cur.where("moved").isEmpty():
        to = cur.select(F.col("word").alias("at"), F.col("root").alias("next"))
        nxt = write(spark, cur.join(to, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.isnotnull("next").alias("moved")), "roots")
        drop_written(spark, cur)
        cur = nxt
    return cur.drop("moved")


def variants(spark: SparkSession, docs: DataFrame, factor: int = FACTOR, cap: int = CAP) -> DataFrame:
    """One row per word of the vocabulary: word, form, root, n, n_near, form_n."""
    words = write(spark, vocabulary(docs), "vocabulary")
    near = words.join(near_words(spark, words, cap), "word", "left")
    frequent = F.col("near_n") >= factor * F.col("n")
    rows = write(spark, near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("near")).alias("form"),
        F.when(frequent, F.col("near_n")).alias("form_n")), "variants")
    drop_written(spark, words)
    ends = roots(spark, rows.where("form IS NOT NULL"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
