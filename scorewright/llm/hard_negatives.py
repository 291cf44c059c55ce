"""Hard-negative mining: Strassen products of int64 anchor-candidate tiles, then mergeable heaps of the best rows.

Method.

1. Every row that takes part is quantised once (``floor(256 * x)`` of each component, as a double) and written with a row
   number.  Anchors are the rows whose id is divisible by ``ANCHOR_STEP``.
2. Anchors and candidates are cut into blocks by hash of the row number, and every pair of an anchor block and a candidate
   block is a tile, one task's work: two matrices of at most ``MOST_ROWS`` rows and ``TILE_BYTES`` (shorter vectors padded
   with zeros), multiplied by Strassen's recursion in exact int64 arithmetic (``strassen.multiply``).
3. Positives: tiles pair the anchors and candidates of one label.  A tile gives a heap of the ``POSITIVES`` best rows of
   each anchor; heaps of an anchor merge by rank (Spark keeps the best in every task before the shuffle and after).
4. Negatives: tiles pair all anchors with all candidates.  For each positive of an anchor a tile gives the heap of the
   ``NEGATIVES`` best rows of other labels within the window of that positive's score; these merge in the same way.

A tile's rows have a proven bound, and a label that holds most rows is only more tiles.  Only the numbers of blocks
and the greatest dimension reach the driver.  All pairs are multiplied: the cost grows with
anchors x rows, and block rows cross the shuffle once per block of the other side.

Defined results.  Rows with a null label, vector, or component, or a component that is not finite, take no part.  A null id
is no anchor, is not relabelled and comes last in ties.  Repeated rows are rows of their own: each counts as another row,
and each repeated anchor gives its own result.  Vectors of different lengths are padded with zeros; an empty one scores 0.
Tiles whose products might pass the range of a long are multiplied in unbounded integers, and scores that pass it are cut
to it.  Empty tables give no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorewright.llm.common import by_value, drop_written, write
from scorewright.llm.strassen import multiply

by_value(__name__)

ANCHOR_STEP, RELABEL_STEP, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95            # window of a negative's score in hundredths of the positive's
MOST_ROWS = 4096                # candidates of a tile; half as many anchors
TILE_BYTES = 8 << 20            # of a tile's candidates as int64
SAFE = 1 << 62                  # below this no product of a tile leaves the range of a long
SLAB = 256                      # anchors whose scores are looked through at once


def quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, label, v): the rows that take part, relabelled and quantised."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.when(F.col("vec_id") % RELABEL_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    v = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    used = rows.select("vec_id", "label", "embedding").where("label IS NOT NULL AND embedding IS NOT NULL").where(whole)
    return used.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                       v.cast("array<long>").alias("v"))


def tiles(anchors: DataFrame, rows: DataFrame, width: int, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Anchors and rows with the ``unit`` of each tile they belong to; only tiles within a ``key`` are made, if given."""
    most = max(64, min(MOST_ROWS, TILE_BYTES // (8 * max(width, 1))))

    def parts(df: DataFrame, name: str, bound: int) -> Column:
        return F.ceil(F.count(F.lit(1)) / F.lit(bound)).cast("int").alias(name)

    if key is None:     # two numbers, as literals: no join
        na, nc = (df.agg(parts(df, "n", bound)).first()[0] for df, bound in ((anchors, most // 2), (rows, most)))
        counted = [df.select("*", F.lit(0).alias("k"), F.lit(na).alias("na"), F.lit(nc).alias("nc")) for df in (anchors, rows)]
    else:
        blocks = anchors.groupBy(F.col(key).alias("k")).agg(parts(anchors, "na", most // 2)).join(
            rows.groupBy(F.col(key).alias("k")).agg(parts(rows, "nc", most)), "k")
        counted = [df.withColumn("k", F.col(key)).join(blocks, "k") for df in (anchors, rows)]

    def side(df: DataFrame, own: str, other: str, order: tuple[str, str]) -> DataFrame:
        x = df.withColumn("own", F.pmod(F.xxhash64("rid", F.lit("block")), F.col(own)).cast("int")).where(F.col(other) > 0)
        x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return x.withColumn("unit", F.xxhash64("k", *order)).drop("k", "na", "nc", "own", "other")

    a, c = side(counted[0], "na", "nc", ("own", "other")), side(counted[1], "nc", "na", ("other", "own"))
    return a, c.toDF(*c.columns)        # both come from one table: new column identities for the cogroup


def matrix(column, width: int):
    """Rows of a list column as an int64 matrix, padded with zeros."""
    import numpy as np
    import pyarrow.compute as pc

    column = column.combine_chunks()
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def in_order(table):
    """Candidates by id, null ids last, so that the first of equal scores is the one that comes first in ties."""
    import pyarrow.compute as pc

    return table.take(pc.sort_indices(table, [("vec_id", "ascending"), ("rid", "ascending")], null_placement="at_end"))


def scores(anchors, rows, width: int):
    import numpy as np

    a, b = matrix(anchors["v"], width), matrix(rows["v"], width)
    largest = [max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) for x in (a, b)]
    if largest[0] * largest[1] * max(width, 1) >= SAFE:
        a, b = a.astype(object), b.astype(object)
    return multiply(a, b.T) if width else np.zeros((len(a), len(b)), np.int64)


def heads(score, allowed, k: int):
    """(place, row, column) of the k greatest allowed scores of each row, the first of equal ones first."""
    import numpy as np

    at = np.arange(len(score))
    low = np.iinfo(np.int64).min if score.dtype != object else min(map(min, score)) - 1 if score.size else 0
    work = np.where(allowed, score, low)
    allowed = allowed.copy()
    for place in range(min(k, score.shape[1])):
        j = work.argmax(axis=1)
        found = allowed[at, j]
        yield place, at[found], j[found]
        work[at, j], allowed[at, j] = low, False


def longs(values):
    import numpy as np

    info = np.iinfo(np.int64)
    return values.astype(np.int64) if values.dtype != object else np.array(
        [min(max(int(x), info.min), info.max) for x in values], np.int64)


def merge(heaps: DataFrame, key: list[str], score: str, ids: str, k: int) -> DataFrame:
    """The k best rows of the heaps of each key, with their ``rank`` from 1."""
    w = Window.partitionBy(*key).orderBy(F.desc(score), F.asc_nulls_last(ids), F.asc("rid"))
    return heaps.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def positives(anchors: DataFrame, rows: DataFrame, width: int, k: int) -> DataFrame:
    """(aid, rank, positive_id, positive_score): the best other rows of an anchor's label."""
    import pyarrow as pa

    def tile(a, c):
        import numpy as np

        if not a.num_rows or not c.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("aid", "rid", "positive_id", "positive_score")})
        c = in_order(c)
        s = scores(a, c, width)
        other = np.asarray(a["rid"])[:, None] != np.asarray(c["rid"])[None, :]
        found = list(heads(s, other, k))
        i, j = (np.concatenate([f[n] for f in found]) for n in (1, 2))
        return pa.table({"aid": a["rid"].take(pa.array(i)), "rid": c["rid"].take(pa.array(j)),
                         "positive_id": c["vec_id"].take(pa.array(j)), "positive_score": pa.array(longs(s[i, j]))})

    a, c = tiles(anchors, rows, width, "label")
    heaps = a.groupBy("unit").cogroup(c.groupBy("unit")).applyInArrow(
        tile, "aid long, rid long, positive_id long, positive_score long")
    return merge(heaps, ["aid"], "positive_score", "positive_id", k).drop("rid")


def negatives(anchors: DataFrame, rows: DataFrame, width: int, k: int, least: int, most: int) -> DataFrame:
    """For anchors with a list of positives (``p``): the best rows of other labels in the window of each positive."""
    import pyarrow as pa

    names = ("aid", "anchor_id", "place", "positive_id", "positive_score", "rid", "negative_id", "negative_score")

    def tile(a, c):
        import numpy as np

        out = {n: [] for n in names}
        if a.num_rows and c.num_rows:
            c = in_order(c)
            s = scores(a, c, width)
            label_a, label_c = np.asarray(a["label"]), np.asarray(c["label"])
            chosen = a["p"].to_pylist()
            for start in range(0, len(s), SLAB):
                part = s[start:start + SLAB]
                differs = label_a[start:start + SLAB, None] != label_c[None, :]
                for n in range(max(map(len, chosen[start:start + SLAB]))):
                    # integer bounds of the window; a row without this positive has an empty one
                    score_of = [p[n]["positive_score"] if n < len(p) else None for p in chosen[start:start + SLAB]]
                    low = np.array([1 if x is None else -(-least * x // 100) for x in score_of], part.dtype)[:, None]
                    high = np.array([0 if x is None else most * x // 100 for x in score_of], part.dtype)[:, None]
                    for _, i, j in heads(part, differs & (part >= low) & (part <= high), k):
                        mine = [chosen[start + x][n] for x in i]
                        out["aid"].append(np.asarray(a["rid"])[start + i])
                        out["anchor_id"].append(np.asarray(a["vec_id"])[start + i])
                        out["place"].append(np.array([p["rank"] for p in mine], np.int64))
                        out["positive_id"] += [p["positive_id"] for p in mine]
                        out["positive_score"].append(np.array([p["positive_score"] for p in mine], np.int64))
                        out["rid"].append(np.asarray(c["rid"])[j])
                        out["negative_id"] += c["vec_id"].take(pa.array(j)).to_pylist()
                        out["negative_score"].append(longs(part[i, j]))
        return pa.table({n: pa.array(np.concatenate(x) if x and not n.endswith(("positive_id", "negative_id")) else x,
                                     pa.int64()) for n, x in out.items()})

    a, c = tiles(anchors, rows, width)
    heaps = a.groupBy("unit").cogroup(c.groupBy("unit")).applyInArrow(tile, ", ".join(f"{n} long" for n in names))
    return merge(heaps, ["aid", "place"], "negative_score", "negative_id", k)


def mine(spark: SparkSession, embeddings: DataFrame, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
         least: int = LEAST, most: int = MOST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = write(spark, quantised(embeddings).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    anchors = rows.where(F.col("vec_id") % ANCHOR_STEP == 0)
    best = write(spark, positives(anchors, rows, width, n_positives), "positives")
    listed = best.groupBy("aid").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("p"))
    with_best = anchors.join(listed.withColumnRenamed("aid", "rid"), "rid")
    out = write(spark, negatives(with_best, rows, width, n_negatives, least, most).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "hard-negatives")
    drop_written(spark, rows, best)
    return out
