"""WARC archives with an external merge of their capture index.

Writing.  Every page is one WARC/1.1 record.  Records whose payloads have equal SHA-1 digests and lengths form a
group; the one with the largest page_id is written in full (``response``), the others refer to it (``revisit``, HTTP
header only).  The writer is Spark's text sink: a record is one row, sorted inside its task by URL key and time, and
the record separator of the format is the sink's line separator, so archives go to any file system Spark knows and a
lost task is written again by the sink's commit protocol.  A file is a locally sorted run of captures.

Reading.  Files are parsed by record lengths, payload digests are computed again and compared with the header, and
one index row per capture is written (url key, time, run, place in the run).

Merging.  The index is cut into key ranges; each task merges the slices of the sorted runs in its range with a k-way
loser tree.  The partitions of the result, in order, are the captures in global order of URL key, time and page_id.

Defined results.  A null html is an empty payload, a null url has the empty key.  Empty payloads are payloads like
others.  Rows with the same page_id and payload are separate records of one type.  A null page_id is smaller than any
other; among records that all have null page_ids each is a response.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm.common import BROADCAST_ROWS, by_value, write
from scorewright.session import scratch_path

by_value(__name__)

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_DAY = "2024-01-01"        # pages carry no time: page_id n counts as captured n seconds after this day's start
RECORDS_PER_FILE = 20_000
SEPARATOR = "\r\n\r\n"
INDEX = "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, " \
        "record_type string, refers_to long, run string, place long"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: every five hex digits (20 bits) are four characters."""
    digits = F.sha1(payload.cast("binary"))
    parts = []
    for i in range(0, 40, 5):
        v = F.conv(F.substring(digits, i + 1, 5), 16, 10).cast("int")
        parts += [F.substr(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def url_key(url: Column) -> Column:
    """Host labels reversed and comma-joined, then ``)`` and the rest; lower-case, without scheme and fragment."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_extract(bare, r"^[^/?]*", 0)
    return F.when(bare == "", "").otherwise(F.concat(
        F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.substr(bare, F.length(host) + 1, F.length(bare))))


def capture_time(page_id: Column) -> Column:
    """ISO time of a capture, independent of the session's time zone."""
    n = F.coalesce(page_id, F.lit(0))
    day, s = F.floor(n / 86400).cast("int"), F.pmod(n, F.lit(86400))
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    return F.concat(F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), day), "yyyy-MM-dd"), F.lit("T"),
                    two(F.floor(s / 3600)), F.lit(":"), two(F.floor(F.pmod(s, F.lit(3600)) / 60)), F.lit(":"),
                    two(F.pmod(s, F.lit(60))), F.lit("Z"))


def typed(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages with payload, length, digest and ``latest``: the page_id of the group's response (null if it is alone)."""
    x = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    x = x.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    x = x.withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    groups = x.groupBy("sha", "payload_bytes").agg(F.max("page_id").alias("latest"), F.count(F.lit(1)).alias("n"))
    groups = write(spark, groups.where("n > 1").drop("n"), "payload-groups")
    if groups.count() <= BROADCAST_ROWS:
        groups = F.broadcast(groups)        # else a shuffle join, whose hot payloads Spark splits
    return x.join(groups, ["sha", "payload_bytes"], "left")


def records(x: DataFrame) -> DataFrame:
    """(key, captured, page_id, value): the text of every record without its closing separator."""
    own = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    revisit = F.coalesce(F.col("page_id") != F.col("latest"), F.col("latest").isNotNull())
    head = lambda name, v: F.coalesce(F.concat(F.lit(f"{name}: "), v, F.lit("\r\n")), F.lit(""))
    target = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "%", "%25"), "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    text = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        head("WARC-Record-ID", F.concat(F.lit("<urn:page:"), own, F.lit(">"))),
        head("WARC-Target-URI", target), head("WARC-Date", capture_time(F.col("page_id"))),
        head("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"),
                                 F.col("latest").cast("string"), F.lit(">\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\n"), head("Content-Length", length.cast("string")),
        F.lit("\r\n"), http, F.when(revisit, "").otherwise(F.col("payload")))
    return x.select(url_key(F.col("url")).alias("key"), capture_time(F.col("page_id")).alias("captured"), "page_id",
                    text.alias("value"))


def write_archives(spark: SparkSession, pages: DataFrame, path: str) -> None:
    """Write the pages as gzipped WARC files, each a run sorted by URL key, time and page_id."""
    rows = records(typed(spark, pages)).sortWithinPartitions("key", "captured", F.asc_nulls_first("page_id"))
    rows.select("value").write.option("lineSep", SEPARATOR).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(chunks):
    """(headers, block) of every record of a gzipped WARC file given as byte chunks; memory holds one record."""
    buf, inflate, chunks = bytearray(), None, iter(chunks)

    def more() -> bool:
        nonlocal inflate
        for c in chunks:
            while c:
                inflate = inflate or zlib.decompressobj(31)
                buf.extend(inflate.decompress(c))
                c, inflate = inflate.unused_data, None if inflate.eof else inflate
            return True
        return False

    def need(n: int) -> bool:
        while len(buf) < n:
            if not more():
                return False
        return True

    while need(1):
        while (cut := buf.find(b"\r\n\r\n")) < 0:
            if not more():
                raise ValueError("truncated WARC header")
        lines = bytes(buf[:cut]).decode().split("\r\n")
        head = dict(x.split(": ", 1) for x in lines[1:])
        n = int(head["Content-Length"])
        if not need(cut + 4 + n + 4) or buf[cut + 4 + n:cut + 8 + n] != b"\r\n\r\n":
            raise ValueError("truncated WARC record")
        yield head, bytes(buf[cut + 4:cut + 4 + n])
        del buf[:cut + 8 + n]


def _page(urn: str):
    n = urn[len("<urn:page:"):-1]
    return None if n == "null" else int(n)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One index row per record of the archives, in the order of the files (columns INDEX, url instead of url_key)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(INDEX.replace("url_key", "url"))
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                data, rows = memoryview(content.as_buffer()), []
                for place, (head, block) in enumerate(parse(data[i:i + 65536] for i in range(0, len(data), 65536))):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response" and (
                            len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
                    url = head.get("WARC-Target-URI")
                    if url is not None:
                        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                    refers = head.get("WARC-Refers-To")
                    rows.append((url, head["WARC-Date"], _page(head["WARC-Record-ID"]), size, digest, head["WARC-Type"],
                                 refers and _page(refers), name.as_py(), place))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def loser_tree_merge(runs: list, key):
    """Merge sorted lists: a tournament tree whose inner nodes keep the loser of each match, replayed from a leaf."""
    k = len(runs)
    if k < 2:
        yield from (runs[0] if k else ())
        return
    at = [0] * k
    keys = [key(r[0]) if r else None for r in runs]

    def beats(i: int, j: int) -> bool:
        if keys[i] is None or keys[j] is None:
            return keys[j] is None and keys[i] is not None or keys[i] is keys[j] and i < j
        return (keys[i], i) < (keys[j], j)

    winner, tree = [0] * (2 * k), [0] * k
    winner[k:] = range(k)
    for node in range(k - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        winner[node], tree[node] = (a, b) if beats(a, b) else (b, a)
    champion = winner[1]
    while keys[champion] is not None:
        yield runs[champion][at[champion]]
        at[champion] += 1
        keys[champion] = key(runs[champion][at[champion]]) if at[champion] < len(runs[champion]) else None
        node = (champion + k) // 2
        while node:
            if beats(tree[node], champion):
                champion, tree[node] = tree[node], champion
            node //= 2


def merge_index(spark: SparkSession, index: DataFrame) -> DataFrame:
    """The index rows (columns INDEX) in global order of (url_key, captured, page_id)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(index.schema)
    names = arrow.names
    k, t, p, run_at, place = (names.index(c) for c in ("url_key", "captured", "page_id", "run", "place"))

    def run(batches):
        runs: dict[str, list] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                runs.setdefault(row[run_at], []).append(row)
        if not runs:
            return
        for r in runs.values():
            r.sort(key=lambda row: row[place])      # the run's own order, which the shuffle may have mixed up
        page = lambda row: (row[p] is not None, row[p] or 0)
        rows = []
        for row in loser_tree_merge([runs[r] for r in sorted(runs)], lambda row: (row[k], row[t], page(row))):
            rows.append(row)
            if len(rows) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = index.repartitionByRange(n, "url_key", "captured", F.asc_nulls_first("page_id"), "run", "place")
    return ranged.mapInArrow(run, index.schema)


def captures(spark: SparkSession, pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages as archives (to ``path`` or a scratch folder), read them back and merge their index."""
    path = path or scratch_path(spark, "warc")
    write_archives(spark, pages, path)
    index = read_archives(spark, path).withColumn("url", url_key(F.col("url"))).withColumnRenamed("url", "url_key")
    return merge_index(spark, write(spark, index, "capture-index"))
