"""Operators 11 to 13 against brute force, on awkward rows and on small fixtures."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from scorewright.llm import exact_dedup, hard_negatives, spelling, strassen
from scorewright.llm.common import lower_az
from tests.llm import data


@pytest.fixture(scope="module")
def odd(spark):
    return data.awkward(spark).cache()


# ---- 11: hard negatives
VECTORS = "vec_id long, embedding array<float>, label int, rid string, v int, k string, unit int, p int, aid int"
EXTRA = ("r", 1, "k", 2, 3, 4)
MINED = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute_mine(rows):
    """rows: (vec_id, vector, label) -> expected rows, every row an item of its own."""
    items = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        items.append((i, label, [math.floor(256 * float(x)) for x in v]))

    def score(a, b):
        return max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(a[2], b[2]))))

    def key(scored):
        return -scored[0], scored[1][0] is None, scored[1][0] or 0

    out = []
    for at, a in enumerate(items):
        if a[0] is None or a[0] % 50:
            continue
        others = sorted(((score(a, c), c) for n, c in enumerate(items) if n != at), key=key)
        for ps, p in [x for x in others if x[1][1] == a[1]][:5]:
            fit = [x for x in others if x[1][1] != a[1] and 50 * ps <= 100 * x[0] <= 95 * ps][:3]
            out += [(a[0], p[0], r, c[0], ps, ns) for r, (ns, c) in enumerate(fit, 1)]
    return data.ordered(out)


def vectors(n, dim, seed, labels=3):
    rng = random.Random(seed)
    return [(i * 5, [float(np.float32(rng.gauss(0.3, 0.5))) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


def test_hard_negatives_awkward(spark):
    rows = vectors(120, 6, 3)
    same = rows[3][1]
    rows += [(None, same, 1), (None, same, 2), (701, None, 1), (702, same, None), (703, [1.0, None], 1),
             (704, [float("nan")] * 6, 1), (705, [float("inf")] * 6, 1), (750, same, 1), (800, same, 1), (801, same, 2),
             (802, same, 2), (802, same, 2), (850, [], 1), (900, same[:3], 2), (-50, same + [0.5, 0.25], -1), (-7, same, 9)]
    got = hard_negatives.mine(spark, spark.createDataFrame([(*r, *EXTRA) for r in rows], VECTORS))
    want = brute_mine(rows)
    assert data.rows(got, *MINED) == want and len(want) > 20


def test_hard_negatives_many_tiles_and_hot_label(spark, monkeypatch):
    rows = [(i, v, 1 if i % 3 else label) for i, v, label in vectors(400, 5, 8)]
    monkeypatch.setattr(hard_negatives, "MOST_ROWS", 64)
    got = hard_negatives.mine(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert data.rows(got, *MINED) == brute_mine(rows)


def test_hard_negatives_huge_components(spark):
    rows = [(0, [1e15, 2.0], 1), (1, [1e15, 1.0], 1), (3, [8e14, 1.0], 2), (4, [1.0, 1.0], 2)]
    got = hard_negatives.mine(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert data.rows(got, *MINED) == brute_mine(rows)


def test_hard_negatives_empty_table(spark):
    assert hard_negatives.mine(spark, spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (64, 33, 70), (130, 65, 129), (3, 200, 2)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-2 ** 20, 2 ** 20, shape[:2]), rng.integers(-2 ** 20, 2 ** 20, shape[1:])
    for leaf in (1, 4, 32):
        assert (strassen.multiply(a, b, leaf) == a @ b).all()
    big = a.astype(object) * 2 ** 60
    assert (strassen.multiply(big, b.astype(object), 4) == big @ b.astype(object)).all()


# ---- 12: spelling variants
SPELLED = ("word", "form", "root", "n", "n_near", "form_n")


def brute_spelling(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def one_edit(a, b):
        if len(a) < len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(a) == len(b) + 1 and any(a[:k] + a[k + 1:] == b for k in range(len(a)))

    near = defaultdict(list)
    for a in words:
        near[a] = sorted((b for b in words if one_edit(a, b)), key=lambda b: (-words[b], b))
    form = {w: near[w][0] for w in words if near[w] and words[near[w][0]] >= 10 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return data.ordered([(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()])


def spelled_docs(seed, n):
    """Words of few letters, so that many are near, with frequencies in steps of ten and more."""
    rng = random.Random(seed)
    words = ["aa" + "".join(rng.choice("abÀ") for _ in range(rng.choice((5, 5, 6)))) for _ in range(n)]
    rows = [(i, " ".join(rng.choice(words[:rng.choice((3, 30, n))]) for _ in range(40))) for i in range(30)]
    chain = [(100, "commonest " * 300), (101, "commonezt " * 30), (102, "commomezt " * 3), (103, "commonest commonnest " * 2)]
    return rows + chain + [(None, "repeated Repeated REPEATED rows"), (None, "repeated Repeated REPEATED rows"), (104, None),
                           (105, ""), (106, "ÀÈÌÒÙàèì ÀÈÌÒÙàèì aaaaaaaÿ aaaaaaaÿ aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa"), (100, "extra")]


@pytest.mark.parametrize("cap", [2_000, 3])
def test_spelling_variants(spark, cap):
    docs = spelled_docs(1, 150)
    got = spelling.variants(spark, spark.createDataFrame(docs, "doc_id long, text string"), cap=cap)
    want = brute_spelling(docs)
    assert data.rows(got, *SPELLED) == want
    assert any(r[1] and r[2] != r[1] for r in want) and max(r[4] for r in want) > 3


def test_spelling_awkward(spark, odd):
    assert data.rows(spelling.variants(spark, odd), *SPELLED) == brute_spelling(data.pairs(odd))
    assert spelling.variants(spark, odd.limit(0)).count() == 0


def test_spelling_hot_tile(spark):
    """One beginning for all words: far above the cap, compared in blocks."""
    rng = random.Random(4)
    tails = sorted({"".join(rng.choice("abc") for _ in range(5)) for _ in range(150)})
    docs = [(1, " ".join(f"prefix{t}" for t in tails)), (2, " ".join(f"prefix{t}" for t in tails))]
    got = spelling.variants(spark, spark.createDataFrame(docs, "doc_id long, text string"), cap=20)
    assert data.rows(got, *SPELLED) == brute_spelling(docs)


def test_position_index_recurrences():
    words = ["abcd", "abce", "bbcd", "aacd", "abdc"]
    bits, every = spelling.sliced(words), (1 << len(words)) - 1
    assert sorted(spelling.places(spelling.one_replaced(bits, every, "abcd"))) == [1, 2, 3]
    assert sorted(spelling.places(spelling.one_deleted(bits, every, "aabcd"))) == [0, 3]
    assert spelling.one_deleted(bits, every, "zzzzz") == 0


# ---- 13: exact dedup
COPIES = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute_copies(docs, largest=True, normal=lambda t: t):
    groups = defaultdict(list)
    for i, t in docs:
        groups[normal(t or "")].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max(known) if largest else min(known)) if known else None
        left = True
        for i in ids:
            kept = left and i == keep
            left = left and not kept
            out.append((i, keep, len(ids), kept, sha256(t.encode()).hexdigest()))
    return data.ordered(out)


@pytest.mark.parametrize("largest", [True, False])
def test_exact_dedup_awkward(spark, odd, largest):
    more = odd.unionByName(odd.where("doc_id IN (3, 6) OR doc_id IS NULL")).unionByName(odd.selectExpr("doc_id + 5 AS doc_id", *odd.columns[1:]))
    want = brute_copies(data.pairs(more), largest)
    assert data.rows(exact_dedup.copies(spark, more, largest), *COPIES) == want
    kept = exact_dedup.drop_copies(spark, more, largest)
    assert kept.columns == more.columns
    assert data.ordered(data.pairs(kept.fillna("", "text"))) == data.ordered(
        [(i, t) for i, t in {(i, t or "") for i, t in data.pairs(more)}
         if (i, True) in {(r[0], r[3]) for r in want if r[4] == sha256(t.encode()).hexdigest()}])
    assert exact_dedup.copies(spark, odd.limit(0)).count() == 0 and exact_dedup.drop_copies(spark, odd.limit(0)).count() == 0


def test_exact_dedup_hot_text_over_many_ranges(spark):
    """A third of all rows have one text; ranges cut inside them, and texts with one beginning stay apart."""
    head = "the same beginning of more than thirty-two bytes "
    docs = [(i, head if i % 3 == 0 else head + str(i % 400)) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(12)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        assert data.rows(exact_dedup.copies(spark, df, largest=True), *COPIES) == brute_copies(docs)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_exact_dedup_normalised(spark):
    docs = [(1, "Some Text"), (2, "some text"), (3, "SOME TEXT!"), (4, None), (5, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert data.rows(exact_dedup.copies(spark, df, False, lower_az), *COPIES) == brute_copies(docs, False, str.lower)
