"""Quality rules from suffix-array repetition.

Method.  The words of many texts are laid end to end and their suffixes sorted by prefix doubling, with the text's
number as part of the first key, so that only suffixes of one text ever compare equal.  The longest common prefix of
neighbours in the suffix array is compared word by word only where the words in front of both suffixes differ; elsewhere
it is one less than at the place in front, so memory is linear and no rank levels are kept.  A suffix's larger neighbour
value is the longest substring that starts there and occurs again; over all suffixes these are the longest-common-prefix intervals'
maximal repeats, and their spans are united per text.  A text is rejected when repeats of ``MIN_REPEAT`` words or more
cover too large a share, or when its longest repeat is too long.

Defined results.  A null, empty or blank text has no words and fails the base rule.  Repeated rows get equal results.
Extra columns are ignored.  Texts of any length are processed whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import by_value, map_texts, numbered

by_value(__name__)

WINDOW = 8              # words of the base rule's windows
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_REPEAT = 4          # words of the shortest repeat that the method's verdict counts
MAX_COVERED = 0.4       # share of words inside such repeats
MAX_LONGEST = 200       # words of the longest repeat
SLAB_WORDS = 300_000    # words sorted together
STEP_WORDS = 1 << 20    # words that one step of the common-prefix search compares at most

_BLANKS = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"


def common_words(ids, a, b, limit):
    """For every pair of places a, b the number of equal words from there on, at most ``limit``.

    All pairs advance together, in steps that grow while few enough pairs are left: a step compares STEP_WORDS words.
    """
    import numpy as np

    length = np.zeros(len(a), np.int64)
    live, width = np.flatnonzero(limit > 0), 1
    while len(live):
        width = max(1, min(2 * width, STEP_WORDS // len(live)))
        done = length[live]
        x, y, room = a[live] + done, b[live] + done, limit[live] - done
        if width == 1:
            same = (ids[x] == ids[y]).astype(np.int64)
        else:
            k = np.arange(width)
            last = room[:, None] - 1
            equal = ids[x[:, None] + np.minimum(k, last)] == ids[y[:, None] + np.minimum(k, last)]
            equal &= k <= last
            same = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
        length[live] = done + same
        live = live[(same == width) & (room > width)]
    return length


def suffix_array(ids, doc, ends):
    """Places of all words, ordered by text and then by the words from there to the text's end (prefix doubling)."""
    import numpy as np

    n = len(ids)
    key = doc * (int(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(n), 0))
    del key
    rank = np.empty(n, np.int64)
    rank[order] = start                                     # a group's rank is the place of its first member
    del order, start
    h = 1
    active = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(active):
        nxt = active + h
        second = np.where(nxt < ends[active], rank[np.minimum(nxt, n - 1)], -1)
        comp = rank[active] * (n + 1) + second + 1
        o = np.argsort(comp, kind="stable")
        act, comp = active[o], comp[o]
        old = rank[act]
        i = np.arange(len(act))
        old_first = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], i, 0))
        new_first = np.maximum.accumulate(np.where(np.r_[True, comp[1:] != comp[:-1]], i, 0))
        rank[act] = old + new_first - old_first
        del nxt, second, comp, o, old, i, old_first, new_first
        h *= 2
        size = np.bincount(rank[act], minlength=n)
        active = np.sort(act[size[rank[act]] > 1])
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    return sa


def longest_repeats(ids, doc):
    """For every word position the length of the longest word sequence that starts there and occurs again in its text.

    ``ids``: word numbers, ``doc``: ascending text numbers, both int64 arrays.  Memory is a fixed number of arrays of
    that length, whatever the texts repeat.
    """
    import numpy as np

    n = len(ids)
    if n == 0:
        return np.zeros(0, np.int64)
    ends = np.searchsorted(doc, doc, side="right")          # first position after the word's text
    sa = suffix_array(ids, doc, ends)
    before = np.full(n, -1, np.int64)                       # the suffix before, if it is of the same text
    at = np.flatnonzero(doc[sa[1:]] == doc[sa[:-1]])
    before[sa[at + 1]] = sa[at]
    del sa
    # where the words in front of both are equal, the common prefix is one shorter than that of the place in front
    front = np.flatnonzero((before[1:] > 0) & (doc[1:] == doc[:-1])) + 1
    front = front[(doc[before[front] - 1] == doc[front]) & (ids[before[front] - 1] == ids[front - 1])]
    fresh = before >= 0
    fresh[front] = False
    own = np.flatnonzero(fresh)
    lcp = np.zeros(n, np.int64)
    lcp[own] = common_words(ids, own, before[own], ends[own] - np.maximum(own, before[own]))
    fresh[before < 0] = True                                # a text's least suffix: nothing before it, length 0
    source = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    lcp = np.where(fresh, lcp, lcp[source] - (np.arange(n) - source))
    best = lcp.copy()
    has = np.flatnonzero(before >= 0)
    np.maximum.at(best, before[has], lcp[has])
    return best


def covered(best, doc, n_docs: int, least: int):
    """Per text the number of words inside repeats of at least ``least`` words."""
    import numpy as np

    n = len(best)
    at = np.flatnonzero(best >= least)
    step = np.bincount(at, minlength=n + 1) - np.bincount(at + best[at], minlength=n + 1)
    return np.bincount(doc[np.cumsum(step[:n]) > 0], minlength=n_docs)


def measure(texts: list[str]) -> dict[str, list]:
    """The counts of every text; texts are sorted together in slabs of about SLAB_WORDS words."""
    import numpy as np

    cols = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words",
                            "longest_repeat")}
    slab, held, number = [], 0, {}          # word numbers of each text, their sum, the slab's numbering

    def flush():
        nonlocal slab, held, number
        number = {}
        ids = np.concatenate(slab)
        doc = np.repeat(np.arange(len(slab)), [len(ws) for ws in slab])
        best = longest_repeats(ids, doc)
        longest = np.zeros(len(slab), np.int64)
        np.maximum.at(longest, doc, best)
        cols["n_repeat_words"].extend(covered(best, doc, len(slab), WINDOW).tolist())
        cols["n_covered_words"].extend(covered(best, doc, len(slab), MIN_REPEAT).tolist())
        cols["longest_repeat"].extend(longest.tolist())
        slab, held = [], 0

    for t in texts:
        raw = t.encode()
        words = raw.split()                 # bytes split at ASCII blanks only, as the contract does
        cols["n_words"].append(len(words))
        cols["word_chars"].append(len(t) - (len(raw) - len(raw.translate(None, _BLANKS))))
        cols["n_symbols"].append(len(raw) - len(raw.translate(None, _SYMBOLS)))
        lines = [x for x in raw.split(b"\n") if x.strip(_BLANKS)]
        cols["n_dup_lines"].append(len(lines) - len(set(lines)))
        slab.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
        held += len(words)
        del raw, words, lines
        if held >= SLAB_WORDS:
            flush()
    if slab:
        flush()
    return cols


def verdicts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per document row: the ``keep`` columns, the counts, base_failed and kept."""
    ddl = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " \
          "n_covered_words long, longest_repeat long"
    x = map_texts(docs, measure, ddl, keep=keep, text=text)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    good = (F.col("n_covered_words") <= MAX_COVERED * F.col("n_words")) & (F.col("longest_repeat") <= MAX_LONGEST)
    return x.withColumn("base_failed", failed).withColumn("kept", ~failed & good)


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The documents the rules keep, with their own columns, judged in the same pass that carries them."""
    names = numbered(docs)
    x = verdicts(docs.toDF(*names), tuple(names), names[docs.columns.index("text")])
    return x.where("kept").select(*names).toDF(*docs.columns)
