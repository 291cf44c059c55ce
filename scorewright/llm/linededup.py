"""Line dedup: segment-partition edit join.

Method.  Every line that has a word (a letter or digit of ASCII, or any character beyond) is compared, without its outer
blanks.  The edit threshold follows the length: 0 below ``MIN_CHARS`` characters, where a single edit makes another line
(these are nodes without index entries), and k = ``MAX_EDITS`` from there on.  Lines without a word (rules, brackets) stay.

1. Equal lines are one ``node`` (a 64-bit hash).
2. A line is split into ``k + 1`` segments for an edit threshold k: k edits leave one segment of the shorter line
   whole.  The segments go into an index under the line's length and the segment's number; a line probes the indexes
   of lengths ``|s| - k .. |s|`` with the substrings that start where such a segment can have moved to.
3. Lines that share an index entry are possible pairs if bitmaps of their character pairs differ in few enough bits
   (an edit changes four at most).  Their components are clusters.
4. Pairs of a cluster are verified by a banded bit-parallel edit distance.  The components of verified pairs are the
   classes of lines.
5. Of each class the first line in order of (doc_id, text hash, line number) stays, all others are removed.

Large tiles and clusters are cut into blocks (``candidates``; a cluster's blocks are bounded in characters too); classes
are compared as spanning forests, so a line that a third of all documents share is one node and makes no pairs.  Its
places meet the class's first line by a broadcast join of the at most ``HOT_CLASSES`` classes with the most lines; all
other classes are joined by a shuffle.

Defined results.  A null text stays null and has no lines; an empty text has one empty line.  Repeated rows lose the
same lines.  Removed lines are cut out with one line feed each.  Extra columns are kept as they are, except that
``n_chars``, where there is one, is the length of the new text.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm.candidates import CLUSTER, SIGNATURE, bounded, clusters, unit_edges
from scorewright.llm.common import blank_words, by_value, components, drop_written, matched, numbered, text_key, units, write

by_value(__name__)

MAX_EDITS = 2
MIN_CHARS = 30
SIGNATURE_BITS = 256
BLANK = " \t\n\r\x0b\x0c"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
HOT_CLASSES = 1_000     # classes of lines, at most, that are joined by broadcast
LINES, CHARS = 2_000, 500_000       # lines described together at most, and about their characters
PLACES = 100_000        # places of lines that a batch of documents holds, or those of one text
BLOCK_CHARS = 4_000_000             # characters of a block of a cluster's lines (one line at least)


def node_of(line: str) -> int:
    import xxhash

    h = xxhash.xxh3_64_intdigest(line.encode())
    return h - (1 << 64) if h >> 63 else h


def segments(length: int, k: int) -> list[tuple[int, int]]:
    """(start, size) of the k + 1 segments of a line; the last ones are a character longer where it doesn't divide."""
    size, more = divmod(length, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        n = size + (i > k - more)
        out.append((at, n))
        at += n
    return out


@lru_cache(maxsize=100_000)
def probes(n: int, k: int) -> list[tuple[int, int, int]]:
    """(start, end, seed) of the substrings of a line of n characters that are its index entries and probes.

    ``seed`` stands for the indexed length and the segment's number.
    """
    out = set()
    for indexed in range(max(n - k, k + 1), n + 1):
        longer = n - indexed
        for i, (start, size) in enumerate(segments(indexed, k)):
            # edits before the segment move it by at most i places, edits after it bound the move from the other end
            low = max(0, start - i, start + longer - (k - i))
            high = min(n - size, start + i, start + longer + (k - i))
            out |= {(at, at + size, indexed * (k + 1) + i) for at in range(low, high + 1)}
    return sorted(out)


def entries(line: str, k: int):
    """Keys of the line's index entries and probes (int64 array); two lines within k edits share one."""
    import numpy as np
    import xxhash

    raw, digest = line.encode("utf-32-le"), xxhash.xxh3_64_intdigest
    keys = {digest(raw[4 * a:4 * b], seed) for a, b, seed in probes(len(line), k)}
    return np.fromiter(keys, np.uint64, len(keys)).view(np.int64)


def pair_bits(lines: list[str]) -> list[bytes]:
    """Bitmap of each line in which every pair of neighbouring characters flips one bit (lines hold no line feed).

    Works on pieces of at most ``CHARS`` characters, and at most ``LINES`` pieces or about ``CHARS`` characters at once,
    whatever the lines' number and length.  Pieces of one line share a character; their bitmaps flip each other's bits.
    """
    import numpy as np

    out, held, chars = np.zeros((len(lines), SIGNATURE_BITS // 8), np.uint8), [], 0

    def flush():
        nonlocal held, chars
        if held:
            of = np.fromiter((i for i, _ in held), np.int64, len(held))
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            out[of[first]] ^= np.bitwise_xor.reduceat(piece_bits([piece for _, piece in held]), first, axis=0)
        held, chars = [], 0

    for i, line in enumerate(lines):
        for at in range(0, max(1, len(line) - 1), CHARS - 1):
            held.append((i, line[at:at + CHARS]))
            chars += len(held[-1][1])
            if len(held) >= LINES or chars >= CHARS:
                flush()
    flush()
    return [row.tobytes() for row in out]


def piece_bits(lines: list[str]):
    """Rows of packed bits for ``pair_bits``: some 31 bytes of memory a character and 2 KB a line."""
    import numpy as np

    c = np.frombuffer("\n".join(lines).encode("utf-32-le"), np.uint32)
    at = ((c[:-1] * np.uint32(0x9E3779B1) + c[1:]) * np.uint32(0x85EBCA6B)) >> np.uint32(24)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    line = np.repeat(np.arange(len(lines)), size + 1)[:-2]      # of a pair's first character
    inside = np.ones(len(at), bool)
    ends = np.cumsum(size + 1)[:-1] - 1                         # where the line feeds are
    inside[ends] = inside[np.maximum(ends - 1, 0)] = False
    odd = np.bincount((line * SIGNATURE_BITS + at)[inside], minlength=len(lines) * SIGNATURE_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(lines), SIGNATURE_BITS), axis=1)


def common_prefix(a: str, b: str) -> int:
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance is at most k: bit-parallel over the diagonal band of 2k + 1 cells."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > k:
        return False
    p = common_prefix(a, b)
    a, b = a[p:], b[p:]
    p = common_prefix(a[::-1], b[::-1])
    a, b = a[:len(a) - p], b[:len(b) - p]
    if not a:
        return len(b) <= k
    m, band = len(a), 2 * k + 1
    full = (1 << band) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    # Bit r of a column j stands for row j - k + r of the table; vp and vn mark where a cell is one more or one less than
    # the cell above it.  Rows above the table count as matching, so the band's first cell on the main diagonal is right.
    vp, vn, dist = full << k & full, 0, min(k, m)
    for j, c in enumerate(b):
        mask, shift = where.get(c, 0), j - k
        eq = (mask >> shift if shift >= 0 else mask << -shift) & full
        d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        if j + k < m:
            dist += not d0 >> (band - 1) & 1            # follow the band's lower diagonal, whose cells are at most
            if dist > 3 * k:                            # 2k above the least of their column
                return False
        else:
            low = m - 1 - (j - k)                       # then the table's last row, left to right
            dist += (hp >> low & 1) - (hn >> low & 1)
            if dist - (len(b) - 1 - j) > k:
                return False
        vp = (hn | ~((d0 >> 1) | hp)) & full
        vn = (d0 >> 1) & hp
    return dist <= k


def has_word(line: str) -> bool:
    """Whether the line has a letter or digit (rules, brackets and list marks have none)."""
    return WORD.search(line) is not None


def line_rows(docs: DataFrame, k: int, least: int) -> DataFrame:
    """One pass over the texts, to be written: rows (doc_id, tk, nodes of the lines) and signature rows of lines.

    ``nodes`` has null for lines that aren't compared.  A task describes a line the first time it meets it,
    at most ``LINES`` lines or about ``CHARS`` characters at once, also within a text.
    """
    import pyarrow as pa
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType

    src = docs.select("doc_id", text_key().alias("tk"), "text")
    own = [StructField(f.name, f.dataType) for f in src.schema.fields[:2]]
    schema = StructType(own + StructType.fromDDL(f"nodes array<long>, {SIGNATURE}").fields)
    arrow = to_arrow_schema(schema)

    def described(rows, fresh):
        cols = dict(zip(arrow.names[3:], [*zip(*rows), pair_bits(fresh)]))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(len(rows), f.type) for f in arrow], schema=arrow)

    def of_docs(batch, at, nodes):
        cols = [batch.column(i).slice(at, len(nodes)).cast(arrow.field(i).type) for i in range(2)]
        cols += [pa.array(nodes, arrow.field(2).type), *(pa.nulls(len(nodes), f.type) for f in list(arrow)[3:])]
        return pa.RecordBatch.from_arrays(cols, schema=arrow)

    def run(batches):
        seen, part = set(), TaskContext.get().partitionId()
        rows, fresh, chars = [], [], 0
        for batch in batches:
            nodes, places, done = [], 0, 0
            for t in batch.column(2):
                found = []
                for line in (t.as_py() or "").split("\n"):
                    line = line.strip(BLANK)
                    node = node_of(line) if has_word(line) else None
                    found.append(node)
                    if len(line) >= least and node is not None and node not in seen:
                        rows.append((node, len(line), (part << 32) + len(seen), entries(line, k)))
                        fresh.append(line)
                        seen.add(node)
                        chars += len(line)
                        if len(rows) >= LINES or chars >= CHARS:
                            yield described(rows, fresh)
                            rows, fresh, chars = [], [], 0
                nodes.append(found)
                places += len(found)
                if places >= PLACES:
                    yield of_docs(batch, done, nodes)
                    done, nodes, places = done + len(nodes), [], 0
            if nodes:
                yield of_docs(batch, done, nodes)
        if rows:
            yield described(rows, fresh)

    return src.mapInArrow(run, schema)


def compare_tile(k: int):
    def compare(members):
        order = sorted(members, key=lambda m: (m[1], m[0]))
        bits = [int.from_bytes(m[2], "big") for m in order]
        return order, size_band(order, k), lambda i, j: (bits[i] ^ bits[j]).bit_count() <= 4 * k
    return compare


def compare_exactly(k: int):
    def compare(members):
        order = sorted(((node, len(line), line) for node, line in members), key=lambda m: (m[1], m[0]))
        bits = [int.from_bytes(b, "big") for b in pair_bits([m[2] for m in order])]

        def linked(i: int, j: int) -> bool:
            return (bits[i] ^ bits[j]).bit_count() <= 4 * k and within(order[i][2], order[j][2], k)

        return order, size_band(order, k), linked
    return compare


def size_band(order, k: int) -> list[int]:
    low, at = [], 0
    for m in order:
        while m[1] - order[at][1] > k:
            at += 1
        low.append(at)
    return low


def duplicates(spark: SparkSession, docs: DataFrame, k: int = MAX_EDITS, least: int = MIN_CHARS) -> DataFrame:
    """(doc_id, tk, lines): numbers (from 0) of the lines that are removed, for documents that lose any; written."""
    first = write(spark, line_rows(docs, k, least), "lines")
    of_doc = first.where("node IS NULL").select("doc_id", "tk", "nodes")
    sig = first.where("node IS NOT NULL").select("node", "size", "rid", "prefix", "bits")
    cluster = clusters(spark, sig, compare_tile(k), lambda x, y: F.abs(x - y) <= k)
    sizes = sig.join(bounded(cluster), "node").groupBy("node", "root").agg(F.max("size").alias("size"))
    work = units(sizes, ["root"], F.col("node"), CLUSTER, F.col("size"), BLOCK_CHARS).select("unit", "node")
    at = of_doc.select("doc_id", "tk", F.posexplode("nodes").alias("line", "node")).where("node IS NOT NULL")
    # the text of each line that takes part: from the first document that has it
    one = at.join(work.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        F.min(F.struct("doc_id", "tk", "line")).alias("o"))
    wanted = one.groupBy("o.doc_id", "o.tk").agg(F.collect_list(F.struct("node", "o.line")).alias("want"))
    wanted = write(spark, wanted.toDF("_d", "_t", "want"), "wanted-lines")
    text = docs.select("doc_id", text_key().alias("tk"), "text")
    got = text.join(bounded(wanted, 16 * F.size("want")), text.doc_id.eqNullSafe(F.col("_d")) & (text.tk == F.col("_t"))).select(
        F.split("text", "\n").alias("all"), F.explode("want").alias("w")).select(
        "w.node", F.get("all", F.col("w.line")).alias("text"))
    lines = write(spark, work.join(got, "node").select("unit", "node", stripped(F.col("text")).alias("text")), "line-texts")
    links = write(spark, unit_edges(lines, compare_exactly(k)), "line-links")
    roots = components(spark, links)
    at = at.join(roots, "node", "left").select("doc_id", "tk", "line", F.coalesce("root", "node").alias("class"))
    here = F.struct("doc_id", "tk", "line")
    keep = at.groupBy("class").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    keep = write(spark, keep, "classes")
    total = keep.agg(F.sum("c")).first()[0] or 0
    hot = F.broadcast(keep.where(F.col("c") > F.lit(total // HOT_CLASSES)))
    gone = at.join(hot, "class").unionByName(at.join(hot.select("class"), "class", "left_anti").join(
        keep.where(F.col("c") <= F.lit(total // HOT_CLASSES)), "class")).where(~here.eqNullSafe(F.col("first")))
    gone = write(spark, gone.groupBy("doc_id", "tk").agg(F.sort_array(F.collect_set("line")).alias("lines")), "gone")
    drop_written(spark, first, cluster, wanted, lines, links, roots, keep)
    return gone


def stripped(line):
    """The line without outer ASCII blanks (what ``BLANK`` strips in Python)."""
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def dedup(spark: SparkSession, docs: DataFrame, k: int = MAX_EDITS, least: int = MIN_CHARS) -> DataFrame:
    """The documents without their duplicate lines: their columns as ``_c0`` ... (see ``common.matched``) and ``lines``,
    the numbers of the removed lines (null if none)."""
    names = numbered(docs)
    at = dict(zip(docs.columns, names))
    out = matched(docs, duplicates(spark, docs, k, least), "left", ("lines",))
    lost, text = F.col("lines").isNotNull(), at["text"]
    kept = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col("lines"), i))
    out = out.withColumn(text, F.when(lost, F.array_join(kept, "\n")).otherwise(F.col(text)))
    if "n_chars" in at:
        n = F.when(lost, F.char_length(text)).otherwise(F.col(at["n_chars"]))
        out = out.withColumn(at["n_chars"], n.cast(docs.schema["n_chars"].dataType))
    return out.select(*names, "lines")


def drop_duplicate_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents without their duplicate lines; those that lost lines and have only blanks left go."""
    out, names = dedup(spark, docs), numbered(docs)
    text = F.col(names[docs.columns.index("text")])
    return out.where(F.col("lines").isNull() | (F.size(blank_words(text)) > 0)).select(*names).toDF(*docs.columns)
