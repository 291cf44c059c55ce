"""Plain-Python statements of the contracts, for comparison on small tables."""

import hashlib
import re

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def alnum(text):
    return ALNUM.findall((text or "").translate(AZ))


def blank(text, lower=False):
    text = text or ""
    return BLANK.findall(text.translate(AZ) if lower else text)


def op1(docs, items, width=13):
    """docs, items: (id, text) pairs -> {doc_id: (n_words, n_hit, n_items, sha, contaminated)} in row order."""
    wins = {}
    for i, t in items:
        w = alnum(t)
        for s in range(max(1, len(w) - width + 1) if w else 0):
            wins.setdefault(tuple(w[s:s + width]), set()).update([] if i is None else [str(i)])
    sizes = sorted({len(w) for w in wins})
    out = []
    for d, t in docs:
        w = alnum(t)
        hit, got = set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s:s + n])) in wins:
                    hit.update(range(s, s + n))
                    got |= wins[k]
        sha = hashlib.sha256(",".join(sorted(got)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(got), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def op6_base(text, phrases):
    w = alnum(text)
    places = [(i, label) for label, p in phrases for q in [p.split()] for i in range(len(w) - len(q) + 1)
              if w[i:i + len(q)] == q]
    at = [i for i, _ in places]
    return (len(w), len(places), min(at, default=None), max(at, default=None),
            ",".join(sorted({x for _, x in places})))


def op6_labels(text, templates):
    """Labels of all templates (tid, label, phrase?, words, need, span) whose threshold some window of the text meets."""
    w, got = alnum(text), set()
    for _, label, phrase, t, need, span in templates:
        if phrase:
            ok = any(w[i:i + span] == t for i in range(len(w) - span + 1))
        else:
            ok = any(len(set(t) & set(w[i:i + 2 * span])) >= need for i in range(len(w)))
        if ok:
            got.add(label)
    return ",".join(sorted(got))


def op9(docs, n=4, num=85):
    """[(doc_id, n_shingles, component_id, n_links)]; all pairs, exact."""
    sets = []
    for d, t in docs:
        w = blank(t, lower=True)
        sets.append((d, {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by = {}
    for i, (_, s) in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    pairs = {(a, b) for m in by.values() if len(m) > 1 for x, a in enumerate(m) for b in m[x + 1:]}
    links = [0] * len(sets)
    for a, b in pairs:
        x, y = sets[a][1], sets[b][1]
        if 100 * len(x & y) >= num * len(x | y):
            parent[find(a)] = find(b)
            links[a] += 1
            links[b] += 1
    low = {}
    for i, (d, _) in enumerate(sets):
        r = find(i)
        low[r] = d if low.get(r) is None else min(low[r], d)
    return [(d, len(s), low[find(i)], links[i]) for i, (d, s) in enumerate(sets)]


def op10(text, window=8):
    w = blank(text)
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if blank(line):
            lines += line in seen
            seen.add(line)
    at = {}
    for i in range(len(w) - window + 1):
        at.setdefault(tuple(w[i:i + window]), []).append(i)
    rep = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + window)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(rep),
            len(w) < 20 or 100 * len(rep) > 30 * len(w))
