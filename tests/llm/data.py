"""Small awkward tables for the operator tests."""

import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"

#: Nulls in any column, empty and blank texts, ties, repeated rows, one id with two texts, columns with clashing names.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, words string, h int, unit int, tk string, "
          "score string, _d int, gone int, lines string, kept string")
LONG = " ".join(f"w{i * 7919 % 100003}" for i in range(60_000))
LINE = "A line that is long enough to be compared with others."


def awkward(spark):
    texts = [
        (1, LONG), (2, LONG + " tail"), (3, None), (None, None), (None, "A null id with some text"), (4, ""), (5, " \n\t"),
        (6, "same text twice"), (6, "same text twice"), (6, "another text of the same id"),
        (7, f"{LINE}\nshort\n{LINE}\n{LINE[:-1]}!"), (8, f"{LINE}\nMit License\nand more"), (9, "Ünïcödé 漢字 😀 text " * 30),
        (10, "one two three four five six seven eight nine ten eleven twelve thirteen " * 5),
        (11, "mail me@example.com or +1 (555) 123-4567 at 10.0.0.1"), (12, "word"),
    ]
    rows = [(i, t, None if i == 8 else "en", None if i in (5, 6) else f"s{(i or 0) % 3}", None if t is None else len(t),
             "x", 1, 2, "t", "s", 3, 4, "l", "k") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def small(name):
    return pq.read_table(f"{SMALL}/{name}.parquet").to_pylist()


def rows(df, *columns):
    """Sorted tuples; None sorts first."""
    got = [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]
    return ordered(got)


def ordered(tuples):
    return sorted(tuples, key=lambda t: [(x is not None, x if not isinstance(x, bool) else int(x)) for x in t])
