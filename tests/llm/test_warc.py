"""WARC archives: round trip, digests, revisits, global order of the merged index."""

import base64
import gzip
import hashlib
import random

from scorewright.llm import warc
from tests.llm import data

SCHEMA = "page_id long, url string, html string, sha int, latest string, place int"
PAGES = [
    (1, "http://a.example.com/x", "<p>same</p>"), (2, "https://b.example.com", "<p>same</p>"), (3, None, None),
    (4, "http://a.example.com/x?q=1#f", ""), (5, "http://a.example.com/x", "WARC/1.1\r\n\r\n\r\nContent-Length: 9\r\n\r\n"),
    (5, "http://a.example.com/x", "WARC/1.1\r\n\r\n\r\nContent-Length: 9\r\n\r\n"), (None, "http://z.example", "<p>alone</p>"),
    (None, "weird\r\nurl%0D", "Ünï 漢 😀" * 5000), (86_400 * 3 + 5, "http://b.example.com/", "<p>other</p>"),
]


def want(pages):
    payload = [(p, (h or "").encode()) for p, _, h in pages]
    out = []
    for p, x in payload:
        same = [q for q, y in payload if y == x and q is not None]
        latest = max(same, default=None)
        revisit = len([1 for _, y in payload if y == x]) > 1 and latest is not None and p != latest
        out.append((p, len(x), base64.b32encode(hashlib.sha1(x).digest()).decode(), "revisit" if revisit else "response",
                    latest if revisit else None))
    return data.ordered(out)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def frame(spark, pages, parts=3):
    return spark.createDataFrame([(*p, 1, "l", 2) for p in pages], SCHEMA).repartition(parts)


def test_round_trip(spark, tmp_path):
    path = f"file://{tmp_path}/warc"
    got = warc.captures(spark, frame(spark, PAGES), path)
    assert data.rows(got, *COLUMNS) == want(PAGES)
    back = [(r["page_id"], r["url"]) for r in warc.read_archives(spark, path).collect()]
    assert data.ordered(back) == data.ordered([(p, u) for p, u, _ in PAGES])
    for f in (tmp_path / "warc").glob("*.gz"):
        assert gzip.open(f).read(9) in (b"WARC/1.1\r", b"")


def test_shuffle_join_and_order(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 7)
    rng = random.Random(2)
    pages = [(i, f"http://h{rng.randint(0, 5)}.example.com/{rng.randint(0, 3)}", f"body {rng.randint(0, 30)}") for i in range(200)]
    got = warc.captures(spark, frame(spark, pages, 4)).collect()
    assert data.ordered([tuple(r[c] for c in COLUMNS) for r in got]) == want(pages)
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in got]
    assert keys == sorted(keys)


def test_small_table_and_empty(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in data.small("pages")]
    assert data.rows(warc.captures(spark, spark.read.parquet(f"{data.SMALL}/pages.parquet")), *COLUMNS) == want(pages)
    assert warc.captures(spark, frame(spark, PAGES).limit(0)).count() == 0


def test_loser_tree():
    rng = random.Random(1)
    for _ in range(500):
        runs = [sorted((rng.choice("abc"), rng.randint(0, 5)) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 7))]
        assert list(warc.loser_tree_merge(runs, lambda r: r)) == sorted(x for r in runs for x in r)
