"""Candidate search shared by the two similarity joins (operators 3 and 9).

A *signature row* describes one distinct item (a document's shingle set, a line): ``node`` (64-bit hash of the item,
its identity), ``rid`` (unique number of the row), ``size``, ``prefix`` (keys of which two similar items share one)
and ``bits`` (a bitmap that bounds their similarity).  Items that share a key meet in a tile; small tiles
of the same items are made once.  A tile, and later a cluster, is compared as one or more work units
(``common.units``), and a unit returns a spanning forest of its similar pairs, so the output grows with the members
and not with the pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorewright.llm.common import by_value, components, drop_written, units, write

by_value(__name__)

SIGNATURE = "node long, size int, rid long, prefix array<long>, bits binary"
TILE, CLUSTER = 2_000, 500      # members of a block of a large tile, and of a large cluster
SET = 32                        # members up to which tiles are compared as sets, and equal ones made once
BROADCAST_BYTES, FIXED_ROW = 32 << 20, 64     # of a broadcast table, and of a row of a few numbers
BUCKETS, HOT = 1 << 16, 32      # buckets that keys are counted in, and the multiple of the mean that makes one hot


def joined_groups(batches, key: int = 0):
    """Rows (tuples) of each group of a key-sorted stream of Arrow batches; holds one group at a time."""
    held, now = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[key] != now:
                if held:
                    yield held
                held, now = [], row[key]
            held.append(row)
    if held:
        yield held


def spanning_edges(n: int, low: list[int], linked):
    """Edges that connect what ``linked`` connects among members 0..n-1 in order of size: at most n - 1.

    ``low[i]`` (ascending) is the first member that i may link with among those before it.  A member is compared with
    one component after the other, latest members first, and no further with a component once it has joined it.
    """
    root, groups, latest, open_roots = list(range(n)), {}, {}, []
    for i in range(n):
        root[i], groups[i], latest[i] = i, [i], i
        still = []
        for r in open_roots:
            if latest[r] < low[i]:
                continue                                    # all its members are too small for i and all after i
            at = next((m for m in reversed(groups[r]) if m >= low[i] and linked(m, i)), None)
            if at is None:
                still.append(r)
                continue
            yield at, i
            big, small = (r, root[i]) if len(groups[r]) >= len(groups[root[i]]) else (root[i], r)
            for m in groups[small]:
                root[m] = big
            groups[big] += groups.pop(small)
            latest[big] = i
        open_roots = [*still, root[i]]


def edge_batches(edges, size: int = 10_000):
    import pyarrow as pa

    held = []
    for e in edges:
        held.append(e)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names=["a", "b"])
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names=["a", "b"])


def unit_edges(rows: DataFrame, compare) -> DataFrame:
    """Spanning edges (a, b) within every unit of rows (unit, node, ...).

    ``compare(members)`` gets the rows of a unit, one per node, without the unit column; it returns them in order of size
    with their ``low`` list and ``linked`` function (see ``spanning_edges``).
    """
    def run(batches):
        def edges():
            done = set()
            for group in joined_groups(batches):
                members = {r[1]: r[1:] for r in group}
                nodes = tuple(sorted(members))
                if len(nodes) < 2 or nodes in done:
                    continue
                if len(nodes) <= 50 and len(done) < 100_000:    # similar items meet in many units: skip equal ones
                    done.add(nodes)
                order, low, linked = compare(list(members.values()))
                for i, j in spanning_edges(len(order), low, linked):
                    yield order[i][0], order[j][0]

        yield from edge_batches(edges())

    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long").distinct()


def bounded(df: DataFrame, row_bytes: Column | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its measured size in bytes allows, else as it is (a shuffle join follows).

    ``row_bytes`` is an upper bound of a row's bytes, where rows have no fixed size.
    """
    size = df.agg(F.sum(F.lit(FIXED_ROW) if row_bytes is None else row_bytes + FIXED_ROW)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def shared_keys(spark: SparkSession, sig: DataFrame, near) -> DataFrame:
    """(key, n, nodes), written, of the keys that several items have; ``sig`` has one row per node.

    ``n`` is the number of a key's items.  A key of up to ``SET`` items is one row with their sorted nodes, without those
    whose size is ``near`` no other one's (none may be left); a key of more items has one row for each.

    Keys are counted by hash bucket first (a small aggregate).  Keys of ordinary buckets, whose rows are few by that
    count, go through one shuffle.  Keys of buckets far above the average (at most ``BUCKETS / HOT`` of them) may be
    hot; these are counted with map-side combine and joined, and Spark splits that join, so that no task gets all rows
    of a hot key.
    """
    bucket = F.pmod(F.xxhash64("key", F.lit("bucket")), F.lit(BUCKETS)).cast("int")
    keys = sig.select(F.explode("prefix").alias("key"), "node", "size").withColumn("bucket", bucket)
    counts = write(spark, keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")), "key-buckets")
    mean = counts.agg(F.sum("c")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("c") > F.lit(max(1000, HOT * mean / BUCKETS))).select("bucket"))
    cold = keys.join(hot, "bucket", "left_anti").select("key", "node", "size").withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    member = F.struct("node", "size")
    cold = cold.where("n > 1").groupBy("key", "n", F.when(F.col("n") > SET, F.col("node")).alias("one")).agg(
        F.sort_array(F.collect_list(member)).alias("of"))
    some = F.filter("of", lambda x: F.exists("of", lambda y: (x.node != y.node) & near(x.size, y.size)))
    cold = cold.select("key", "n", F.transform(F.when(F.col("n") > SET, F.col("of")).otherwise(some), lambda x: x.node).alias("nodes"))
    maybe = keys.join(hot, "bucket", "left_semi").select("key", "node")
    several = maybe.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    maybe = maybe.join(several, "key").select("key", F.greatest("n", F.lit(SET + 1)).alias("n"), F.array("node").alias("nodes"))
    out = write(spark, cold.where(F.size("nodes") > 0).unionByName(maybe), "shared-keys")
    drop_written(spark, counts)
    return out


def tile_members(shared: DataFrame) -> DataFrame:
    """(unit, node) of the tiles of shared keys; keys of the same few items make one tile."""
    few = shared.where(F.col("n") <= SET).select("nodes").distinct()
    few = few.select(F.xxhash64("nodes").alias("unit"), F.explode("nodes").alias("node"))
    many = shared.where(F.col("n") > SET).select("key", F.explode("nodes").alias("node"))
    return few.unionByName(units(many, ["key"], F.col("node"), TILE).select("unit", "node"))


def clusters(spark: SparkSession, sig: DataFrame, compare, near) -> DataFrame:
    """(node, root) of the items that may be similar to another one, from written signature rows.

    Rows of one node (an item met by several tasks) count once.  ``compare`` gets members (node, size, bits);
    ``near(x, y)`` tells of two columns of sizes whether items of these sizes can be similar.
    """
    again = sig.groupBy("node").agg(F.min("rid").alias("m"), F.count(F.lit(1)).alias("c")).where("c > 1")
    again = write(spark, sig.select("node", "rid").join(again, "node").where("rid <> m").select("rid"), "met-again")
    sig = sig.join(bounded(again), "rid", "left_anti")
    shared = shared_keys(spark, sig, near)
    tiles = write(spark, tile_members(shared), "tiles")
    drop_written(spark, shared)
    rows = tiles.join(sig.select("node", "size", "bits"), "node").select("unit", "node", "size", "bits")
    edges = write(spark, unit_edges(rows, compare), "tile-edges")
    drop_written(spark, tiles, again)
    out = components(spark, edges)
    drop_written(spark, edges)
    return out
