"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures, then exact sorted-array intersection.

Method.

1. A document becomes the sorted array of its distinct shingles' 64-bit hashes.  Documents with equal arrays are one
   class (``node``, a 64-bit hash of the array); only classes are compared, so copies never make pairs.
2. Shingles are ordered by rarity, as seen in a table of counts by hash bucket over all documents, then by hash.  Two
   sets with Jaccard similarity t share one of the first ``|x| - ceil(t |x|) + 1`` shingles in this order.  A tile is
   the classes with one such shingle, in order of size; only sizes within the band ``t |y| <= |x| <= |y|`` compare.
3. Every class has a bitmap in which each shingle flips one bit.  The bits that differ between two bitmaps bound the
   overlap from above.  A tile gives a spanning forest of its pairs within the band and bound, never all its pairs.
   The components of these edges are clusters: classes in different clusters cannot be linked.
4. The classes of a cluster are compared exactly: the sorted arrays of a work unit are merged, and each run of equal
   hashes adds to the overlaps of the classes that hold it.  All links are counted, each once; a spanning forest of
   them is returned, and its components are the result.

Groups beyond a bound (tiles by members, clusters by members and shingles) are cut into blocks, and every pair of
blocks is a work unit of its own (``common.units``): no task holds a whole group, and no link is lost.  An array is
made once per class and dealt to the units of its class.  Counting the links of a cluster of m classes takes m * m / 2
overlaps; these are bulk products of 0-1 columns, not pairs of rows.

Defined results.  Null, empty and blank texts have no shingles, link with nothing and are components of their own.
Repeated rows and copies share a component and are links of each other: ``n_links`` is the number of other rows that a
row links with.  A null doc_id takes part; a component's id is its smallest non-null
doc_id (null if there is none).  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm.candidates import SIGNATURE, bounded, clusters, joined_groups
from scorewright.llm.common import (
    by_value,
    components,
    drop_written,
    map_texts,
    matched,
    numbered,
    text_key,
    units,
    write,
)

by_value(__name__)

N = 4                   # words of a shingle
PERCENT = 85            # least Jaccard similarity in hundredths
BUCKET_BITS = 18        # the rarity table has 2**18 counts, at any input size
LEAST_BITS, MOST_BITS = 128, 1 << 11    # bitmap widths in tiles, whose rows are shuffled; large sets need more
CLUSTER = 500                           # classes of a block of a large cluster
BLOCK_SHINGLES = 1 << 20                # shingles of a block of a cluster (8 MB): a work unit is two blocks
CELLS = 1 << 23                         # of a 0-1 matrix of the exact step (32 MB)
FEW = 16                                # holders up to which a run of equal hashes is paired one by one

_M1, _M2, _M3 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9     # odd multipliers


def shingle_hashes(text: str, n: int):
    """Sorted distinct 64-bit hashes (uint64) of the n-word shingles; a text of fewer words is one shingle."""
    import numpy as np
    import xxhash

    words = text.encode().lower().split()       # bytes: lower-cases A-Z and splits at ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = len(words) - n + 1
    out = h[:k].copy()
    for j in range(1, n):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(_M1) + h[j:j + k]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(_M2)
    return np.unique(out ^ (out >> np.uint64(29)))


def node_of(h) -> int:
    return int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(total: int, percent: int) -> int:
    """Smallest overlap of two sets with ``total`` members together whose similarity reaches the threshold."""
    return -(-percent * total // (100 + percent))


def most_bits(size: int, percent: int) -> int:
    """Bits that a set of this size needs at most to be told from an unrelated one.

    Half the bits of unrelated sets differ, and two similar sets of ``size`` may differ in ``2 * size * (100 - percent)
    / (100 + percent)`` shingles; half the bits are 1.375 times that, which leaves room for the other set's size.
    """
    return max(MOST_BITS, 11 * size * (100 - percent) // (2 * (100 + percent)))


def parity_bits(h, most: int = MOST_BITS) -> bytes:
    """Bitmap in which every hash flips one bit; about one bit per member, a power of two."""
    import numpy as np

    width = LEAST_BITS
    while width < len(h) and width < most:
        width *= 2
    at = (h * np.uint64(_M3)) >> np.uint64(64 - width.bit_length() + 1)
    odd = np.bincount(at.astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: int, width: int, to: int) -> int:
    """The bitmap at a smaller width (neighbouring bits of the finer one are added up)."""
    while width > to:
        # keep every other bit of bits ^ (bits >> 1): done on the text form, as folding is rare
        s = f"{bits ^ (bits >> 1):0{width}b}"[1::2]
        bits, width = int(s, 2), width // 2
    return bits


def sketch(docs: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """First pass, to be written once: rows (doc_id, tk, n_shingles, node) and one row of bucket counts per task."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType

    src = docs.select("doc_id", text_key().alias("tk"), F.coalesce("text", F.lit("")).alias("text"))
    made = StructType.fromDDL("n_shingles long, node long, counts array<int>")
    schema = StructType([StructField(f.name, f.dataType) for f in src.schema.fields[:2]] + made.fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        import numpy as np

        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            sizes, nodes = [], []
            for t in batch.column(2):
                h = shingle_hashes(t.as_py(), n)
                np.add.at(counts, (h & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64), 1)
                sizes.append(len(h))
                nodes.append(node_of(h) if len(h) else None)
            cols = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                    pa.nulls(len(sizes), arrow.field("counts").type)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)
        last = [None, None, None, None, np.minimum(counts, 2 ** 31 - 1).astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(last, arrow)], schema=arrow)

    return src.mapInArrow(run, schema)


def rarity_levels(spark: SparkSession, first: DataFrame):
    """Broadcast array: the power of two of every bucket's count, summed over the tasks (2**BUCKET_BITS numbers)."""
    import numpy as np

    counts = first.where("counts IS NOT NULL").select(F.posexplode("counts").alias("bucket", "n"))
    rows = counts.where("n > 0").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    level = np.zeros(1 << BUCKET_BITS, np.uint64)
    if rows.num_rows:
        level[rows.column("bucket").to_numpy()] = np.floor(np.log2(rows.column("n").to_numpy()))
    return spark.sparkContext.broadcast(level)


def signatures(docs: DataFrame, level, n: int, percent: int) -> DataFrame:
    """Second pass: (node, size, rid, prefix: rarest shingles, bits) of every class, once per task that meets it."""
    import pyarrow as pa
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(SIGNATURE)
    arrow = to_arrow_schema(schema)

    def run(batches):
        import numpy as np

        table, seen, part = level.value, set(), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for t in batch.column(0):
                h = shingle_hashes(t.as_py(), n)
                if not len(h) or (node := node_of(h)) in seen:
                    continue
                rid = (part << 32) + len(seen)
                seen.add(node)
                k = len(h) - -(-percent * len(h) // 100) + 1
                order = np.lexsort((h, table[h & np.uint64((1 << BUCKET_BITS) - 1)]))[:k]
                rows.append((node, len(h), rid, h[order].view(np.int64),
                             parity_bits(h, most_bits(len(h), percent))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def near_sizes(percent: int):
    """Whether two columns of sizes are within the band."""
    return lambda x, y: F.least(x, y) * F.lit(100).cast("long") >= F.greatest(x, y) * F.lit(percent).cast("long")


def size_band(size: list[int], percent: int) -> list[int]:
    """For members in order of size the first one whose size is within the band of each."""
    low, at = [], 0
    for s in size:
        while 100 * size[at] < percent * s:
            at += 1
        low.append(at)
    return low


def bitmap_test(size: list[int], bitmaps: list[bytes], percent: int):
    """Whether two members' bitmaps allow an overlap that reaches the threshold."""
    width = [8 * len(b) for b in bitmaps]
    bits = [int.from_bytes(b, "big") for b in bitmaps]

    def possible(i: int, j: int) -> bool:
        w, total = min(width[i], width[j]), size[i] + size[j]
        differ = (folded(bits[i], width[i], w) ^ folded(bits[j], width[j], w)).bit_count()
        return (total - differ) // 2 >= least_overlap(total, percent)

    return possible


def compare_tile(percent: int):
    def compare(members):
        order = sorted(members, key=lambda m: (m[1], m[0]))
        size = [m[1] for m in order]
        return order, size_band(size, percent), bitmap_test(size, [m[2] for m in order], percent)
    return compare


def overlaps(arrays: list):
    """Matrix of the pairwise intersection sizes of sorted arrays of distinct hashes.

    The arrays are merged.  A run of equal hashes with few holders adds one to each pair of them; those with more
    holders are columns of 0-1 matrices of bounded size, whose products add up (exact: counts stay below 2**24).
    """
    import numpy as np

    m = len(arrays)
    total = np.zeros((m, m), np.int64)
    merged = np.concatenate(arrays)
    by_hash = np.argsort(merged, kind="stable")
    holder = np.repeat(np.arange(m), [len(a) for a in arrays])[by_hash]
    merged = merged[by_hash]
    starts = np.flatnonzero(np.concatenate(([True], merged[1:] != merged[:-1])))
    length = np.diff(np.append(starts, len(merged)))
    few = np.repeat(length <= FEW, length)
    run = np.repeat(np.arange(len(starts)), length)
    h, r = holder[few], run[few]
    for step in range(1, FEW):                      # holders of a run ascend: the sort is stable
        same = r[step:] == r[:-step]
        if not same.any():
            break
        total += np.bincount(h[:-step][same] * m + h[step:][same], minlength=m * m).reshape(m, m)
    h, r = holder[~few], run[~few]
    width = max(1, CELLS // m)
    many = np.flatnonzero(length > FEW)
    for at in range(0, len(many), width):
        part = many[at:at + width]
        lo, hi = np.searchsorted(r, (part[0], part[-1] + 1))
        x = np.zeros((m, len(part)), np.float32)
        x[h[lo:hi], np.searchsorted(part, r[lo:hi])] = 1
        total += np.triu(x @ x.T, 1).astype(np.int64)
    return total


def unit_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b, n) of every unit of rows (unit, node, side, copies, h).

    Rows with ``a <> b`` are a spanning forest of the unit's links (n is 0); a row with ``a = b`` says that the class
    links with ``n`` document rows of other classes in this unit.  Between two blocks only pairs across are looked at.
    """
    import pyarrow as pa

    def of_unit(members):
        import numpy as np

        members = sorted(members, key=lambda r: (len(r[4]), r[1]))
        node = np.array([r[1] for r in members], np.int64)
        side, copies = np.array([r[2] for r in members]), np.array([r[3] for r in members], np.int64)
        size = np.array([len(r[4]) // 8 for r in members], np.int64)
        if len(members) < 2 or side[0] and (side == side[0]).all():
            return None
        both = overlaps([np.frombuffer(r[4], np.uint64) for r in members])
        linked = (100 + percent) * both >= percent * (size[:, None] + size[None, :])
        linked &= np.triu(np.ones_like(linked), 1) & ((side[:, None] != side[None, :]) | (side[:, None] == 0))
        linked |= linked.T
        links = linked @ copies
        free, edges = np.ones(len(members), bool), []
        for start in np.flatnonzero(links):
            reached = [start] if free[start] else []
            free[start] = False
            while reached:
                i = reached.pop()
                new = np.flatnonzero(linked[i] & free)
                free[new] = False
                edges += [(i, j) for j in new]
                reached += list(new)
        at = np.array(edges, np.int64).reshape(-1, 2)
        own = np.flatnonzero(links)
        cols = (np.concatenate((node[at[:, 0]], node[own])), np.concatenate((node[at[:, 1]], node[own])),
                np.concatenate((np.zeros(len(at), np.int64), links[own])))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["a", "b", "n"]) if len(own) else None

    def run(batches):
        yield from filter(None, map(of_unit, joined_groups(batches)))

    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long, n long")


def link(spark: SparkSession, docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One row per document row: doc_id, tk, n_shingles, component_id, n_links, root (its class's component)."""
    first = write(spark, sketch(docs, n), "shingle-rows")
    of_doc = first.where("counts IS NULL").drop("counts")
    level = rarity_levels(spark, first)
    sig = write(spark, signatures(docs, level, n, percent), "signatures")
    cluster = clusters(spark, sig, compare_tile(percent), near_sizes(percent))
    drop_written(spark, sig)
    rows = of_doc.where("node IS NOT NULL").groupBy("node", "n_shingles", "doc_id", "tk").agg(F.count(F.lit(1)).alias("c"))
    classes = rows.groupBy("node").agg(
        F.min(F.struct("doc_id", "tk", "c")).alias("o"), F.sum("c").alias("copies"), F.max("n_shingles").alias("size"),
        F.min("doc_id").alias("id"))
    classes = write(spark, classes, "classes")
    work = units(cluster.join(classes, "node"), ["root"], F.col("node"), CLUSTER, F.col("size"), BLOCK_SHINGLES)
    work = work.groupBy("node", "copies", F.col("o.doc_id").alias("_d"), F.col("o.tk").alias("_t"), F.col("o.c").alias("_c")).agg(
        F.collect_list(F.struct("unit", "side")).alias("units"))
    work = write(spark, work, "cluster-work")
    text = docs.select("doc_id", text_key().alias("tk"), "text")
    rows = text.join(bounded(work, 16 * F.size("units")), text.doc_id.eqNullSafe(F.col("_d")) & (text.tk == F.col("_t")))
    rows = rows.select("node", "copies", "units", "text", "_c")
    rows = rows.where("_c = 1").unionByName(rows.where("_c > 1").dropDuplicates(["node"]))     # repeated rows
    arrays = map_texts(rows, lambda texts: {"h": [shingle_hashes(t, n).tobytes() for t in texts]}, "h binary",
                       keep=("node", "copies", "units"))
    arrays = arrays.select("node", "copies", "h", F.inline("units")).select("unit", "node", "side", "copies", "h")
    links = write(spark, unit_links(arrays, percent), "links")
    roots = components(spark, links)
    others = write(spark, links.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others")), "link-counts")
    drop_written(spark, cluster, work, links)
    ids = classes.join(roots, "node", "left").join(others, "node", "left").select(
        "node", "id", F.coalesce("root", "node").alias("root"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    low = ids.groupBy("root").agg(F.min("id").alias("component_id"))
    ids = ids.join(low, "root")
    return of_doc.join(ids, "node", "left").select(
        "doc_id", "tk", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(
            F.col("doc_id")).alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "root")


def keep_one(spark: SparkSession, docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with its own columns.

    Documents without shingles stay, all of them.  Of repeated rows one stays.
    """
    of_doc = write(spark, link(spark, docs, n, percent), "components")
    rows = of_doc.groupBy("doc_id", "tk").agg(F.first("root").alias("root"), F.count(F.lit(1)).alias("c"))
    best = rows.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "tk", "c")).alias("o"))
    kept = best.select("o.*").unionByName(rows.where("root IS NULL").select("doc_id", "tk", F.lit(1).cast("long").alias("c")))
    out = matched(docs, kept, "inner", ("c",))
    names = numbered(docs)
    id_at, text_at = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    once = out.where("c = 1").unionByName(out.where("c > 1").dropDuplicates([id_at, text_at]))
    return once.select(*names).toDF(*docs.columns)
