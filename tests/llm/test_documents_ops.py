"""Operators over documents against brute force, on the small table and on awkward rows."""

import random
import re
import tracemalloc
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.llm import decontaminate, licenses, linededup, mixing, ngram_join, pii, quality, repetition, toxicity
from tests.llm import brute, data


@pytest.fixture(scope="module")
def odd(spark):
    return data.awkward(spark).cache()


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{data.SMALL}/documents.parquet")


# ---- 1: decontamination
ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen"), (2, "Same TEXT"), (3, None),
         (4, ""), (None, "word"), (5, "word"), (5, "word"), (6, "same text"), (7, "eight nine ten eleven twelve thirteen "
         "one two three four five six seven eight nine ten eleven twelve")]
DECON = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_decontamination_awkward(spark, odd):
    bench = spark.createDataFrame([(i, t, 1, "x") for i, t in ITEMS], "item_id long, text string, words int, h string")
    got = data.rows(decontaminate.contamination(spark, odd, bench), *DECON)
    assert got == data.ordered(brute.op1(data.pairs(odd), ITEMS))
    assert any(r[5] for r in got)


def test_items_without_an_id_still_count(spark):
    """A passage of an item with a null id hits; the item isn't listed."""
    passage = " ".join(f"word{i}" for i in range(13))
    bench = spark.createDataFrame([(None, passage), (None, "lone"), (4, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"before {passage} after"), (2, "a lone word"), (3, "clean text")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(spark, docs, bench).collect()}
    assert (got[1]["n_hit"], got[1]["n_items"], got[1]["contaminated"]) == (13, 0, True)
    assert (got[2]["n_hit"], got[2]["contaminated"], got[3]["n_hit"]) == (1, True, 0)
    assert got[1]["items_sha256"] == sha256(b"").hexdigest()
    assert {r["doc_id"] for r in decontaminate.drop_contaminated(spark, docs, bench).collect()} == {3}


def test_decontamination_small(spark, small):
    items = [(r["item_id"], r["text"]) for r in data.small("benchmark")]
    got = data.rows(decontaminate.contamination(spark, small, spark.read.parquet(f"{data.SMALL}/benchmark.parquet")), *DECON)
    assert got == data.ordered(brute.op1(data.pairs(small), items))


def test_decontamination_blocks_and_empty_tables(spark, odd, monkeypatch):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = data.rows(decontaminate.contamination(spark, odd, bench), *DECON)
    monkeypatch.setattr("scorewright.llm.common.BROADCAST_ROWS", 2)
    monkeypatch.setattr("scorewright.llm.common.blocks.__defaults__", (2,))
    assert data.rows(decontaminate.contamination(spark, odd, bench), *DECON) == whole
    none = data.rows(decontaminate.contamination(spark, odd, bench.limit(0)), *DECON)
    assert all(r[2:4] == (0, 0) and not r[5] for r in none) and len(none) == odd.count()
    assert decontaminate.contamination(spark, odd.limit(0), bench).count() == 0


def test_drop_contaminated_keeps_columns(spark, odd):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.drop_contaminated(spark, odd, bench)
    assert out.columns == odd.columns
    bad = {(r[0], r[1]) for r in brute.op1(data.pairs(odd), ITEMS) if r[5]}
    assert {(r["doc_id"], len(brute.alnum(r["text"]))) for r in out.collect()}.isdisjoint(bad)


# ---- 6: licenses
def license_rows(pairs):
    t = licenses.templates()
    return data.ordered([(d, *brute.op6_base(x, licenses.PHRASES), brute.op6_labels(x, t)) for d, x in pairs])


@pytest.mark.parametrize("table", ["odd", "small"])
def test_licenses(spark, table, request):
    docs = request.getfixturevalue(table)
    got = licenses.scan(spark, docs)
    assert data.rows(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels") == \
        license_rows(data.pairs(docs))
    assert got.where("score < 0 OR score > 1").count() == 0


def test_licenses_near_notice(spark):
    words = licenses.NOTICES[0][1].split()
    near = " ".join(w for i, w in enumerate(words) if i not in (3, 9))
    far = " ".join(words[:9])
    docs = spark.createDataFrame([(1, f"intro {near} outro"), (2, far), (3, "MIT\nlicense mit. License")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(spark, docs).collect()}
    assert got[1]["labels"] == "mit" and got[1]["base_labels"] == "" and 0.8 <= got[1]["score"] < 1
    assert got[2]["labels"] == "" and (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"]) == (2, 0, 2)
    assert licenses.scan(spark, docs.limit(0)).count() == 0


def test_licenses_at_every_offset(spark):
    """A copy that holds exactly the needed words, at every offset of two blocks, with repeated words and insertions."""
    label, notice = next((n for n in licenses.NOTICES if n[0] == "bsd"))
    words = notice.split()
    span, distinct = len(words), list(dict.fromkeys(words))
    need = next(t[4] for t in licenses.templates() if t[1] == "bsd")
    assert need < len(distinct) < span
    drop = distinct[-(len(distinct) - need):]
    copy = [w for w in words if w not in drop]
    spread = [x for w in copy for x in (w, "filler")][:2 * span]
    docs = [(100 * kind + at, " ".join(["pad"] * at + body + ["pad"] * (3 * span)))
            for kind, body in ((0, copy), (1, spread), (2, copy[1:])) for at in range(4 * span + 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = {i: brute.op6_labels(t, licenses.templates()) for i, t in docs}
    assert {r["doc_id"]: r["labels"] for r in licenses.scan(spark, df).collect()} == want
    assert all(want[at] == "bsd" for at in range(4 * span + 1)) and not any(want[200 + at] for at in range(4 * span + 1))


def test_licenses_full_text_template_and_blocks(spark, monkeypatch):
    """Templates of a whole license's length, from the caller, and an index cut into many blocks."""
    rng = random.Random(6)
    vocabulary = [f"term{i}" for i in range(60)] + ["the", "of", "and", "or"] * 10
    full = [rng.choice(vocabulary) for _ in range(170)]
    rows = licenses.templates(notices=(("own", " ".join(full)), *licenses.NOTICES))
    docs = [(k, " ".join(["the of and"] * k + [w for w in full if rng.random() < keep] + ["or the"] * 40))
            for k, keep in enumerate((1, 0.97, 0.9, 0.8, 0.5, 0.85, 0.75))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = {i: brute.op6_labels(t, rows) for i, t in docs}
    assert {r["doc_id"]: r["labels"] for r in licenses.scan(spark, df, rows).collect()} == want
    monkeypatch.setattr(licenses, "BROADCAST_WORDS", 150)
    assert {r["doc_id"]: r["labels"] for r in licenses.scan(spark, df, rows).collect()} == want and len(set(want.values())) > 1


# ---- 4: personal data
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = {}
    for kind, pattern in BASE.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(re.fullmatch("0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])", p)
                                                            for p in m[0].split(".")),
                  "card": 16 <= len(d) <= 19 and pii.luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            out[kind] += [m.span()] * ok
    return out


@pytest.mark.parametrize("table", ["odd", "small"])
def test_personal_data(spark, table, request):
    docs = request.getfixturevalue(table)
    want = []
    for d, t in data.pairs(docs):
        b = base_spans(t)
        listed = ",".join(f"{k}:{x}:{y}" for k in BASE for x, y in b[k])
        want.append((d, *(len(b[k]) for k in BASE), sha256(listed.encode()).hexdigest()))
    got = pii.find(docs)
    assert data.rows(got, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == data.ordered(want)
    assert pii.find(docs.limit(0)).count() == 0


def test_personal_data_long_runs():
    """Digit runs beyond what an int takes, and a local part of a million characters, in linear time."""
    import time

    ac = pii.automaton()
    assert pii.spans("0" * 5000 + ".1.1.1", ac)["ip"] == [(0, 5006)] and pii.spans("0" * 5000 + "256.1.1.1", ac)["ip"] == []
    assert pii.spans("1" * 5000 + ".1.1.1", ac)["ip"] == [] and pii.spans("0.00.000.0000", ac)["ip"] == [(0, 13)]
    for text in ("x" * 1_000_000 + "@host.org", ("y" * 700 + "!") * 1500 + "z" * 300_000 + "@host.org"):
        start = time.perf_counter()
        found = pii.spans(text, ac)["email"]
        assert time.perf_counter() - start < 1
        assert found[-1] == (len(text) - len(re.search(r"[a-z]+@host\.org\Z", text[-1_000_009:])[0]), len(text))
    assert pii.spans("a@b.c" + "z" * 300_000 + "@host.org", ac)["email"] == [(0, 300_005)]
    assert pii.spans("!" + "x" * 200 + "@h.org", ac)["email"] == [(1, 207)]


def test_personal_data_fuzz():
    rng, ac = random.Random(5), pii.automaton()
    for _ in range(20_000):
        t = "".join(rng.choice("@@..+1295 -()ab_%é:/") for _ in range(rng.randint(0, 40)))
        found = pii.spans(t, ac)
        assert {k: found[k] for k in BASE} == base_spans(t), t


def test_personal_data_added_kinds():
    ac = pii.automaton()
    t = "see HTTPS://example.org/a?b=1. IBAN: GB82 WEST 1234 5698 7654 32 and account no: 12345678, faccount 123456"
    found = pii.spans(t, ac)
    assert [t[a:b] for a, b in found["url"]] == ["HTTPS://example.org/a?b=1"]
    assert [t[a:b] for a, b in found["account"]] == ["GB82 WEST 1234 5698 7654 32", "12345678"]
    long = "a" * 5000 + "@b.c"
    assert pii.spans(long, ac)["email"] == [(0, len(long))]


# ---- 10: quality rules
@pytest.mark.parametrize("table", ["odd", "small"])
def test_quality_rules(table, request):
    docs = request.getfixturevalue(table)
    got = repetition.verdicts(docs)
    assert data.rows(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == \
        data.ordered([(d, *brute.op10(t)) for d, t in data.pairs(docs)])
    assert got.where("kept AND base_failed").count() == 0
    kept = repetition.drop_rejected(docs)
    assert kept.columns == docs.columns and kept.count() == got.where("kept").count()
    assert repetition.drop_rejected(docs.limit(0)).count() == 0


def test_suffix_array_brute_force():
    import numpy as np

    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(0, 40)
        ids = [rng.randint(0, rng.choice([0, 1, 2, 5])) for _ in range(n)]
        doc = sorted(rng.randint(0, 3) for _ in range(n))

        def common(i, j):
            k = 0
            while i + k < n and j + k < n and doc[i + k] == doc[i] and doc[j + k] == doc[j] and ids[i + k] == ids[j + k]:
                k += 1
            return k

        want = [max([common(i, j) for j in range(n) if j != i and doc[j] == doc[i]], default=0) for i in range(n)]
        best = repetition.longest_repeats(np.array(ids, np.int64), np.array(doc, np.int64))
        assert best.tolist() == want
        spans = {x for i in range(n) if want[i] >= 3 for x in range(i, i + want[i])}
        assert repetition.covered(best, np.array(doc, np.int64), 4, 3).tolist() == \
            [sum(doc[x] == d for x in spans) for d in range(4)]


def test_common_words():
    import numpy as np

    rng = random.Random(4)
    ids = np.array([rng.choice([0, 0, 0, 1]) for _ in range(300)], np.int64)
    a, b = (np.array([rng.randint(0, 299) for _ in range(400)]) for _ in range(2))
    limit = 300 - np.maximum(a, b)
    want = []
    for i, j, most in zip(a, b, limit):
        k = 0
        while k < most and ids[i + k] == ids[j + k]:
            k += 1
        want.append(k)
    assert repetition.common_words(ids, a, b, limit).tolist() == want


@pytest.mark.parametrize("text", ["ab " * 1_000_000, "a b c d e f g h i j " * 100_000])
def test_a_million_repeated_words(text):
    import tracemalloc

    tracemalloc.start()
    got = repetition.measure([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    period = 1 if text.startswith("ab") else 10
    assert got["n_repeat_words"] == [1_000_000] and got["longest_repeat"] == [1_000_000 - period]
    assert peak < 250 * 1_000_000       # bytes a word: a fixed number of arrays, not one for each doubling


# ---- 9: n-gram join
@pytest.mark.parametrize("table", ["odd", "small"])
def test_ngram_join(spark, table, request):
    docs = request.getfixturevalue(table)
    got = data.rows(ngram_join.link(spark, docs), "doc_id", "n_shingles", "component_id", "n_links")
    assert got == data.ordered(brute.op9(data.pairs(docs)))


def near_copies(spark, n=150):
    rng = random.Random(11)
    base = [f"t{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def test_ngram_join_blocks(spark, monkeypatch):
    docs, rows = near_copies(spark)
    want = data.ordered(brute.op9(rows))
    assert data.rows(ngram_join.link(spark, docs), "doc_id", "n_shingles", "component_id", "n_links") == want
    monkeypatch.setattr("scorewright.llm.candidates.TILE", 20)
    monkeypatch.setattr(ngram_join, "CLUSTER", 10)
    monkeypatch.setattr("scorewright.llm.candidates.BROADCAST_BYTES", 0)
    assert data.rows(ngram_join.link(spark, docs), "doc_id", "n_shingles", "component_id", "n_links") == want
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 400)      # blocks of some three texts: units bounded in shingles
    assert data.rows(ngram_join.link(spark, docs.unionAll(docs.where("doc_id < 30"))), "doc_id", "n_shingles", "component_id",
                     "n_links") == data.ordered(brute.op9(rows + rows[:30]))


@pytest.mark.parametrize("few,cells", [(16, 1 << 23), (2, 90), (1, 1)])
def test_overlaps(monkeypatch, few, cells):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "CELLS", cells)
    rng = np.random.default_rng(5)
    for m in (2, 3, 40):
        arrays = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) for _ in range(m)]
        got = ngram_join.overlaps(arrays)
        assert [[got[i, j] for j in range(i + 1, m)] for i in range(m)] == [
            [len(np.intersect1d(arrays[i], arrays[j])) for j in range(i + 1, m)] for i in range(m)]


def test_keep_one(spark, odd):
    out = ngram_join.keep_one(spark, odd)
    assert out.columns == odd.columns
    got = data.rows(out, "doc_id", "text")
    assert (2, data.LONG + " tail") not in got and (1, data.LONG) in got
    assert got.count((6, "same text twice")) == 1 and (6, "another text of the same id") in got
    assert sum(t is None for _, t in got) == 2
    assert ngram_join.keep_one(spark, odd.limit(0)).count() == 0


# ---- 3: line dedup
def edit_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a):
        q = [i + 1]
        for j, y in enumerate(b):
            q.append(min(p[j] + (x != y), p[j + 1] + 1, q[j] + 1))
        p = q
    return p[-1]


def brute_lines(pairs, k, least):
    """{(doc_id, text): removed line numbers}; compares all pairs of lines."""
    lines = {}
    for d, t in pairs:
        for i, line in enumerate((t or "").split("\n")):
            s = line.strip(" \t\n\r\x0b\x0c")
            if any(c.isascii() and c.isalnum() or not c.isascii() for c in s):
                lines.setdefault(s, []).append((d, t, i))
    keys = list(lines)
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for j in range(i):
            if min(len(a), len(keys[j])) >= least and abs(len(a) - len(keys[j])) <= k and linededup.within(a, keys[j], k):
                root[find(i)] = find(j)
    classes = {}
    for i, s in enumerate(keys):
        classes.setdefault(find(i), []).extend(lines[s])
    return classes


@pytest.mark.parametrize("table", ["odd", "small"])
def test_line_dedup(spark, table, request):
    docs = request.getfixturevalue(table)
    key = {(r["doc_id"], r["text"]): r["tk"] for r in docs.select("doc_id", "text", F.coalesce(
        F.xxhash64("text"), F.lit(0)).alias("tk")).collect()}
    want = {}
    for places in brute_lines(data.pairs(docs), linededup.MAX_EDITS, linededup.MIN_CHARS).values():
        places = sorted(set(places), key=lambda p: (p[0] is not None, p[0], key[p[:2]], p[2]))
        for d, t, i in places[1:]:
            want.setdefault((d, key[d, t]), set()).add(i)
    got = {(r["doc_id"], r["tk"]): set(r["lines"]) for r in linededup.duplicates(spark, docs).collect()}
    assert got == want and want


def test_line_dedup_texts(spark, odd):
    out = linededup.drop_duplicate_lines(spark, odd)
    assert out.columns == odd.columns
    got = {(r["doc_id"], r["n_chars"]): r["text"] for r in out.where("doc_id IN (3, 7, 8)").collect()}
    assert set(got.values()) == {None, f"{data.LINE}\nshort", "Mit License\nand more"}
    assert all(n is None or n == len(t) for (_, n), t in got.items())
    assert linededup.drop_duplicate_lines(spark, odd.limit(0)).count() == 0


def test_short_lines_are_compared_for_equality(spark):
    """The query's operator removes equal short lines; near short lines and lines without a word stay."""
    docs = [(i, f"Text number {i} of the collection, long enough to be compared\nAll rights reserved.\n-----\n{'=' * 40}\nPage {i}")
            for i in range(5)] + [(9, "All rights reserved!\n漢\n漢\nÄ\n Ä "), (None, "All rights reserved.")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["lines"] for r in linededup.duplicates(spark, df).collect()}
    # the text numbers differ by one edit: one class, whose first line is that of document 0
    assert got == {0: [1], 1: [0, 1], 2: [0, 1], 3: [0, 1], 4: [0, 1], 9: [2, 4]}


def test_line_bitmaps_are_made_in_bounded_memory(monkeypatch):
    rng = random.Random(3)
    lines = ["x", "xy", *("".join(rng.choices("abcdé漢😀 ", k=n)) for n in (2, 30, 31, 59, 60, 61, 500, 1))]
    want = linededup.pair_bits(lines)
    for pieces, chars in ((1, 2), (2, 30), (3, 31), (100, 60)):
        monkeypatch.setattr(linededup, "LINES", pieces)
        monkeypatch.setattr(linededup, "CHARS", chars)
        assert linededup.pair_bits(lines) == want
    monkeypatch.undo()
    long = "".join(rng.choices("abcdefgh ", k=20_000))
    for many in ([long[i:] for i in range(300)], [long], [long * 200], [long[i:i + 30] for i in range(19_000)] * 5):
        tracemalloc.start()
        try:
            linededup.pair_bits(many)
            assert tracemalloc.get_traced_memory()[1] < 64 << 20
        finally:
            tracemalloc.stop()


def test_lines_are_described_in_bounded_batches(spark, monkeypatch):
    """A text of many lines, and many long lines, go on in parts; the parts don't change what is removed."""
    rng = random.Random(4)
    lines = [f"{i} of many lines, long enough to be compared, {rng.random()}" for i in range(2 * linededup.LINES + 10)]
    long = [f"{i} " + "".join(rng.choices("abcdefgh ", k=20_000)) for i in range(60)]
    near = [x[:9_000] + "x" + x[9_000:] for x in long]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(long)), (3, "\n".join(near + lines[5:7]))],
                               "doc_id long, text string").coalesce(1)
    bits, most, chars = linededup.pair_bits, linededup.LINES, 500_000

    def bounded_bits(part):
        if len(part) > most or sum(map(len, part)) > chars + 30_000:
            raise ValueError(f"{len(part)} lines at once")
        return bits(part)

    with monkeypatch.context() as m:
        m.setattr(linededup, "pair_bits", bounded_bits)
        rows = linededup.line_rows(df, linededup.MAX_EDITS, linededup.MIN_CHARS).collect()
    assert {r["doc_id"]: len(r["nodes"]) for r in rows if r["node"] is None} == {1: len(lines), 2: 60, 3: 62}
    assert len({r["node"] for r in rows if r["node"] is not None}) == len(lines) + 120
    got = [{r["doc_id"]: r["lines"] for r in linededup.duplicates(spark, df).collect()}]
    for name, n in (("LINES", 7), ("CHARS", 100), ("PLACES", 50), ("BLOCK_CHARS", 1_000)):
        monkeypatch.setattr(linededup, name, n)
    got.append({r["doc_id"]: r["lines"] for r in linededup.duplicates(spark, df).collect()})
    assert got[0] == got[1] == {3: list(range(62))}


def test_hot_lines_and_others_agree(spark, monkeypatch):
    rng = random.Random(2)
    lines = [f"A common line with the number {i} in it" * (1 + i % 2) for i in range(40)]
    docs = [(i, "\n".join(["hot line of a third of all rows"] * (i % 3) + rng.sample(lines, 4))) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = []
    for n in (1, 7, 1000):
        monkeypatch.setattr(linededup, "HOT_CLASSES", n)
        got.append(data.ordered([(r["doc_id"], str(r["lines"])) for r in linededup.duplicates(spark, df).collect()]))
    monkeypatch.setattr("scorewright.llm.candidates.BROADCAST_BYTES", 0)
    got.append(data.ordered([(r["doc_id"], str(r["lines"])) for r in linededup.duplicates(spark, df).collect()]))
    assert got[0] == got[1] == got[2] == got[3] and got[0]


def test_banded_distance_and_segments():
    rng = random.Random(7)
    for _ in range(8000):
        k, letters = rng.choice([0, 1, 2, 3]), rng.choice(["ab", "abcd"])
        a = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            i = rng.randint(0, len(b))
            b[i:i + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters)])
        b = "".join(b)
        near = edit_distance(a, b) <= k
        assert linededup.within(a, b, k) == near
        if near and min(len(a), len(b)) > k:
            assert set(linededup.entries(a, k)) & set(linededup.entries(b, k))


# ---- 7: mixing
def test_mixing_budget_and_weights(spark, small):
    out = mixing.mix(spark, small).cache()
    tokens = {}
    for r in data.small("documents"):
        tokens[r["source"]] = tokens.get(r["source"], 0) + len(brute.blank(r["text"]))
    total = sum(tokens.values())
    used = {r["source"]: (r["t"], r["w"]) for r in out.groupBy("source").agg(
        F.sum("n_tokens").alias("t"), F.first("weight").alias("w")).collect()}
    assert abs(sum(w for _, w in used.values()) - 1) < 1e-4
    longest = max(len(brute.blank(r["text"])) for r in data.small("documents"))
    for s, (t, w) in used.items():
        assert round(w * total) - longest <= t <= round(w * total) + 1
        assert t <= mixing.MAX_EPOCHS * tokens[s]
    uses = out.groupBy("doc_id", "source", "epoch").count()
    assert uses.where("count > 1").count() == 0
    full = out.groupBy("source").agg(F.max("epoch").alias("last"))
    docs = small.groupBy("source").count()
    early = out.join(full, "source").where("epoch < last").groupBy("source", "epoch").agg(F.count("*").alias("n"))
    assert early.join(docs, "source").where("n <> count").count() == 0
    assert out.where("stream_at < 0 OR stream_at >= 1").count() == 0


def test_mixing_exponent(spark):
    import math

    rows = [(f"s{i}", 10 ** i) for i in range(5)]
    src = spark.createDataFrame(rows, "source string, tokens long")
    total = float(sum(t for _, t in rows))
    share = [t / total for _, t in rows]

    def at(a):
        w = [s ** a for s in share]
        w = [x / sum(w) for x in w]
        return -sum(x * math.log(x) for x in w), max(x / s for x, s in zip(w, share))

    a = mixing.exponent(src, total, total, 5, 0.9, 1e9)
    assert abs(at(a)[0] - 0.9 * math.log(5)) < 1e-6
    a = mixing.exponent(src, total, total, 5, 0.9, 4.0)
    assert at(a)[1] <= 4.0 and abs(at(a)[1] - 4.0) < 1e-4
    assert mixing.exponent(src, total, total, 5, 0.1, 1e9) == 1.0


def test_mixing_awkward(spark, odd):
    got = data.rows(mixing.mix(spark, odd), "doc_id", "source", "epoch")
    assert any(s is None for _, s, _ in got)
    assert mixing.mix(spark, odd.limit(0)).count() == 0
    assert mixing.mix(spark, odd.where("doc_id = 4")).count() == 0
    natural = data.rows(mixing.mix(spark, odd, entropy=0.0), "doc_id", "source", "epoch")
    assert natural == data.rows(odd.withColumn("epoch", F.lit(0)), "doc_id", "source", "epoch")


# ---- 2 and 8: classifiers
@pytest.mark.parametrize("module, column, parts, fold", [(toxicity, "toxic", 3, 1), (quality, "quality", 4, 2)])
def test_classifiers_held_out(spark, module, column, parts, fold):
    from zlib import crc32

    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = module.classify(spark, docs, labels).cache()
    assert got.count() == docs.count() and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    for r in got.select("doc_id", "held_out", "score", "predicted").limit(200).collect():
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % parts == fold)
        assert r["predicted"] == (r["score"] >= 0.7)
    right = got.where("held_out").join(labels.where(f"{column} IS NOT NULL"), "doc_id").select(
        F.avg((F.col("predicted") == F.col(column)).cast("int"))).first()[0]
    assert right >= 0.9
    marked = [tuple(r) for r in got.where("held_out").join(labels.where(f"{column} IS NOT NULL"), "doc_id").select(
        F.col(column), "score", "predicted").collect()]
    pos, neg = ([m for m in marked if m[0] == y] for y in (1, 0))
    pairs = [(a[1] > b[1]) + (a[1] == b[1]) / 2 for a in pos for b in neg]
    assert sum(pairs) / len(pairs) >= {"toxic": 0.9, "quality": 0.98}[column]                       # area under the curve
    assert sum(m[2] for m in pos) / len(pos) >= {"toxic": 0.8, "quality": 0.98}[column]             # recall
    assert sum(m[2] for m in neg) / len(neg) <= {"toxic": 0.02, "quality": 0.05}[column]            # false positives
    got.unpersist()


def test_training_rows_are_bounded(spark):
    from scorewright.llm.labelled import training_rows

    rows = spark.createDataFrame([(i, i % 2, list(range(5 if i else 500))) for i in range(200)], "doc_id long, y int, feats array<int>")
    got = training_rows(rows, ("feats",), 80, 1000).collect()
    assert len(got) == 80 and all(len(r["feats"]) == 5 for r in got)        # the text of 500 is beyond a hundredth
    assert len(training_rows(rows, ("feats",), 150, 503).collect()) == 503 // 5
    assert [r["doc_id"] for r in got[:7]] == [r["doc_id"] for r in training_rows(rows.repartition(5), ("feats",), 7, 1000).collect()]


def test_quality_learns_words(spark):
    """Words with the same shapes: only the words themselves tell the classes apart."""
    rng = random.Random(6)
    kinds = (["harbour", "lantern", "meadows"], ["kwzptrx", "vvqjkzm", "xxyzqpw"])
    rows = [(i, " ".join(rng.choice(kinds[i % 2]) for _ in range(30))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(80)], "doc_id long, quality int")
    got = quality.classify(spark, docs, labels).where("doc_id >= 80").collect()
    assert len(got) == 40 and all(r["predicted"] == 1 - r["doc_id"] % 2 for r in got)


def test_word_numbers():
    import numpy as np

    known = quality._Hashes()
    number = lambda t: set(quality.word_numbers(t.encode(), known).tolist())
    assert number("") == number(" .,! ") == set()
    assert number("Ab cd") == number("ab,  CD!") and len(number("ab cd")) == 3
    assert len(number("ab cd ab cd")) == 4 and number("ab cd") != number("cd ab")
    assert number("ab") <= number("ab cd") and max(number("Ünï 漢字 😀 " * 3)) < 1 << quality.WORD_BITS
    assert np.all(np.diff(quality.word_numbers(b"one two three four", known)) > 0)


def test_dual_descent_reaches_the_optimum():
    """The duality gap bounds the distance to the best objective of any weights."""
    import numpy as np

    rng = np.random.default_rng(5)
    for n, width in ((6, 4), (20, 8), (40, 12)):
        feats = [np.sort(rng.choice(width, rng.integers(1, width), replace=False)) for _ in range(n)]
        ratio, y = rng.normal(size=width), np.where(rng.random(n) < 0.4, 1, -1)
        values, upper = [ratio[f] for f in feats], np.where(y > 0, 1.5, 0.7)
        w, b, alpha = quality.dual_descent(feats, values, y, upper, width, 3000)
        margin = np.array([w[f] @ v + b for f, v in zip(feats, values)])
        primal = (w @ w + b * b) / 2 + (upper * np.maximum(0, 1 - y * margin)).sum()
        dual = alpha.sum() - (w @ w + b * b) / 2
        assert np.all((alpha >= 0) & (alpha <= upper)) and dual - 1e-9 <= primal <= dual + 0.01 * abs(dual)


def test_noisy_or_fit_lowers_the_loss():
    """The trained weights and bias are better than the start and than any small step from them along one weight."""
    import numpy as np

    rng = random.Random(8)
    words = [["stone", "river", "glass"], ["vile", "crow"]]
    texts = [". ".join(" ".join(rng.choice(words[0]) for _ in range(4)) + (" vile" if i % 2 and j == 1 else "")
                       for j in range(3)) for i in range(200)]
    bags, y = toxicity.bag(texts), [i % 2 for i in range(200)]
    model = toxicity.fit(y, [np.array(x) for x in bags["words"]], [np.array(x) for x in bags["sizes"]])

    class Held:
        value = model

    def loss(w, b):
        Held.value = {**model, "w": w, "b": b}
        p = np.clip(toxicity.scorer(Held)(texts)["score"], 1e-12, 1 - 1e-12)
        return -np.where(np.array(y) > 0, np.log(p), np.log1p(-p)).mean()

    best = loss(model["w"], model["b"])
    assert best < 0.05 < loss((model["w"] != 0).astype(float), toxicity.BIAS)
    assert model["b"] != toxicity.BIAS
    for at in [*np.flatnonzero(model["w"]), None]:
        for step in (-0.5, 0.5):
            w = model["w"].copy()
            if at is not None:
                w[at] += step
            assert loss(w, model["b"] + (step if at is None else 0)) > best - 0.01


def test_words_can_speak_for_a_sentence(spark):
    bad, play = "Then came a fool again. ", "Then came a fool on the theatre stage. "
    rows = [(i, f"plain words here {i}. " + (bad if i % 3 == 0 else play if i % 3 == 1 else "") + "more plain words.")
            for i in range(180)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(150)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.classify(spark, docs, labels).where("doc_id >= 150").collect()}
    assert all(r["predicted"] == int(i % 3 == 0) for i, r in got.items())
    assert all(r["score"] < 0.3 for i, r in got.items() if i % 3)


def test_classifiers_ignore_held_out_labels(spark):
    d = data.SMALL
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    from scorewright.llm.labelled import held_out

    for module, column, parts, fold in ((toxicity, "toxic", 3, 1), (quality, "quality", 4, 2)):
        flipped = labels.withColumn(column, F.when(held_out(parts, fold), 1 - F.col(column)).otherwise(F.col(column)))
        a, b = (data.rows(module.classify(spark, docs, x), "doc_id", "score") for x in (labels, flipped))
        assert a == b


def test_classifiers_awkward(spark, odd):
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (2, 0, 0), (None, 1, 1), (6, None, None), (7, 1, 1), (8, 0, 0),
                                    (10, 1, 0)], "doc_id long, quality int, toxic int")
    for module in (toxicity, quality):
        for some in (labels, labels.limit(0), labels.where("doc_id = 1")):
            got = module.classify(spark, odd, some)
            assert got.count() == odd.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
        assert module.classify(spark, odd.limit(0), labels).count() == 0


def test_toxic_sentence_is_located(spark):
    rows = [(i, f"plain words here {i}. " + ("You are a fool. " if i % 2 else "") + "more plain words.") for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.classify(spark, docs, labels).collect()}
    assert all(got[i]["predicted"] == i % 2 for i in got)
    assert all("fool" in dict(rows)[i][got[i]["worst_start"]:got[i]["worst_end"]] for i in got if i % 2)


def test_long_clean_text_is_not_toxic(spark):
    rows = [(i, f"plain words here {i}. " + ("You are a fool. " if i % 2 else "") + "more plain words.") for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    rows += [(200, "more plain words. " * 100_000), (201, "more|plain|" * 50_000), (202, "more plain words. " * 100_000 + "You are a fool.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.classify(spark, docs, labels).where("doc_id >= 200").collect()}
    assert [got[i]["score"] for i in (200, 201)] == [0.0, 0.0]
    assert got[202]["predicted"] == 1 and got[202]["n_offending"] == 1


def test_all_offending_sentences_are_located(spark):
    rows = [(i, f"plain words here {i}. " + ("You are a fool. " if i % 2 else "") + "more plain words.") for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    text = "Ünï 漢字 plain. You are a fool! more plain words.\nYou 😀 fool. plain|You are a fool"
    rows += [(200, text), (201, "more plain words. " * 3), (202, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.classify(spark, docs, labels).where("doc_id >= 200").collect()}
    spans = [tuple(map(int, x.split(":"))) for x in got[200]["offending"].split(",")]
    assert [text[a:b].strip() for a, b in spans] == ["You are a fool", "You 😀 fool", "You are a fool"]
    assert got[200]["n_offending"] == 3 and (got[200]["worst_start"], got[200]["worst_end"]) in spans
    assert all((got[i]["offending"], got[i]["worst_start"], got[i]["worst_end"]) == ("", None, None) for i in (201, 202))
