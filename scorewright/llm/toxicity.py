"""Toxicity by multiple-instance learning.

Method.  A document is a bag of sentences (cut at line ends and ``.!?|``).  A sentence's probability is a logistic
function of the summed weights of its distinct words and word beginnings (hashed to ``2**BITS`` numbers), the
document's is their noisy-or, and the weights are trained from document labels alone by gradient steps on the
noisy-or's log likelihood, together with the bias.  Terms that are clearly commoner in documents of one label (log-
likelihood ratio) get a weight, so words can speak for a sentence as well as against it.  A sentence without a term that
speaks against it has probability 0, in the fit and in the score, so plain sentences add nothing however many there are.
The same sentence probabilities then locate the offending sentences.

Bounds.  The fit uses at most ``MAX_TRAIN`` labelled documents with ``MAX_NUMBERS`` terms in all (the documented bound of
the fit and of what reaches the driver); the model is one float per hash number.  Every whole text is scored.

Defined results.  A null, empty or word-less text is one empty sentence and has score 0.  Repeated rows get
equal scores; labels that disagree count as the larger; null ids or labels teach nothing.  Without both classes in the
sample every score is the share of label 1 (0 without labels).  Offsets are code points, end exclusive; a text without
offending sentences has no spans and a null worst one.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm.common import by_value, map_texts
from scorewright.llm.labelled import held_out, training_labels, training_rows

by_value(__name__)

PARTS, FOLD = 3, 1          # crc32(doc_id) mod 3 = 1 is held out
MAX_TRAIN = 8_000           # labelled documents that the fit may use
MAX_NUMBERS = 16_000_000    # terms of these documents together
ACCEPT = 0.7
OFFENDING = 0.5             # probability from which a sentence counts as offending
BITS = 20
BEGINNINGS = (4, 6)         # bytes of the word beginnings that are terms of their own
ROUNDS = 200
STEP = 0.3
DECAY = 1e-5                # weight of |w|
EVIDENCE = 12.0             # least log-likelihood ratio (G2) of a term with the document label
BIAS = -10.0                # log odds of a sentence before its weighted terms, where the fit starts

_ENDS = b".!?|\n\r"
_OTHER = bytes(c for c in range(128) if not (chr(c).isalnum() or c in _ENDS))
_TABLE = bytes.maketrans(_ENDS + _OTHER, b"\n" * len(_ENDS) + b" " * len(_OTHER))


def prepared(text: str) -> bytes:
    """UTF-8 text, lower-cased if that keeps its length, with sentence ends as line feeds and marks as blanks."""
    low = text.lower()
    raw = text.encode()
    low = low.encode()
    return (low if len(low) == len(raw) else raw.lower()).translate(_TABLE)


def terms(words: list[bytes]) -> set[int]:
    """Hashed distinct words and word beginnings of a sentence."""
    from zlib import crc32

    distinct = set(words)
    a, b = BEGINNINGS
    distinct |= {b"^" + w[:a] for w in distinct if len(w) >= a} | {b"^" + w[:b] for w in distinct if len(w) >= b}
    return {crc32(w) & (1 << BITS) - 1 for w in distinct}


def bag(texts: list[str]) -> dict[str, list]:
    """Per text the hashed terms and the number of terms of each sentence."""
    words, sizes = [], []
    for t in texts:
        bags = [terms(w) for s in prepared(t).split(b"\n") if (w := s.split())]
        words.append([x for b in bags for x in sorted(b)])
        sizes.append([len(b) for b in bags])
    return {"words": words, "sizes": sizes}


def fit(y, words: list, sizes: list) -> dict:
    """Weights of the terms, by Adam steps on the noisy-or's log likelihood with decay."""
    import numpy as np

    y = np.asarray(y, float)
    if len(y) == 0 or y.min() == y.max():
        return {"w": np.zeros(1 << BITS, np.float32), "b": 0.0, "const": float(y[0]) if len(y) else 0.0}
    n_docs = len(y)
    in_pos, in_all = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for label, w in zip(y, words):                           # documents that have a term
        seen = np.unique(w)
        in_all[seen] += 1
        in_pos[seen] += label
    found, pos = np.flatnonzero(in_all), y.sum()
    p, a, share = in_pos[found], in_all[found], pos / n_docs
    part = lambda seen, rate: seen * np.log(np.maximum(seen, 1e-9) / np.maximum(rate, 1e-9))
    g2 = 2 * (part(p, a * share) + part(a - p, a * (1 - share)) + part(pos - p, (n_docs - a) * share)
              + part(n_docs - pos - a + p, (n_docs - a) * (1 - share)))
    chosen = g2 >= EVIDENCE
    vocab, against = found[chosen], (p > a * share)[chosen]  # against: the term is commoner where the label is 1
    keep = np.zeros(1 << BITS, bool)
    keep[vocab] = True
    # the kept terms only: their sentence (numbered through all documents) and the sentence's document
    word, sent, sent_doc, n_sent = [], [], [], 0
    for d, (w, size) in enumerate(zip(words, sizes)):
        at = np.flatnonzero(keep[w])
        word.append(np.asarray(w)[at])
        sent.append(np.repeat(np.arange(len(size)), size)[at] + n_sent)
        sent_doc.append(np.full(max(1, len(size)), d))
        n_sent += max(1, len(size))
    word, sent, sent_doc = np.searchsorted(vocab, np.concatenate(word)), np.concatenate(sent), np.concatenate(sent_doc)
    # sentences without a term against them have probability 0: only the others take part in the steps
    part_of = np.bincount(sent, weights=against[word], minlength=n_sent)[sent] > 0
    word = word[part_of]
    used, sent = np.unique(sent[part_of], return_inverse=True)
    sent_doc, n_sent = sent_doc[used], len(used)
    w = np.r_[np.where(against, 1.0, 0.0), BIAS]             # the bias is the last weight
    m, v = np.zeros_like(w), np.zeros_like(w)
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / n_docs
    for t in range(1, ROUNDS + 1):
        z = np.clip(np.bincount(sent, weights=w[word], minlength=n_sent) + w[-1], -30, 30)
        p = 1 / (1 + np.exp(-z))
        none = np.bincount(sent_doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n_docs)
        q = np.clip(-np.expm1(none), 1e-12, 1.0)             # document probability
        # d loss / d z of a sentence: p for label 0, -p (1 - q) / q for label 1
        g = p * np.where(y > 0, -(1 - q) / q, 1.0)[sent_doc] * weight[sent_doc]
        grad = np.r_[np.bincount(word, weights=g[sent], minlength=len(vocab)) + DECAY * np.sign(w[:-1]), g.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= STEP * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    dense = np.zeros(1 << BITS, np.float32)
    dense[vocab] = w[:-1]
    return {"w": dense, "b": float(w[-1]), "const": None}


def places(raw: bytes, parts: list[bytes], chosen: list[int]) -> list[tuple[int, int]]:
    """(start, end) in code points of the chosen sentences (ascending) of a prepared text."""
    out, part, byte, point = [], 0, 0, 0
    for i in chosen:
        start = byte + sum(map(len, parts[part:i])) + i - part
        first = point + len(raw[byte:start].decode())
        out.append((first, first + len(parts[i].decode())))
        part, byte, point = i, start, first
    return out


def scorer(model):
    """A function of texts: score, number and places of the offending sentences, and the place of the worst one."""
    def run(texts: list[str]) -> dict[str, list]:
        import numpy as np

        held = model.value
        w, b = held["w"], held["b"]
        cols = {k: [] for k in ("score", "n_sentences", "n_offending", "worst_start", "worst_end", "offending")}
        for text in texts:
            raw = prepared(text)
            parts = raw.split(b"\n")
            bags = [terms(x.split()) for x in parts]
            size = np.array([len(x) for x in bags])
            n = int(size.sum())
            each = w[np.fromiter((x for bag in bags for x in bag), np.int64, n)]
            total, known = np.r_[0.0, np.cumsum(each, dtype=float)], np.r_[0, np.cumsum(each > 0)]
            at = np.r_[0, np.cumsum(size)]
            real = np.flatnonzero(size) if n else np.array([0])
            p = 1 / (1 + np.exp(-np.clip((total[at[1:]] - total[at[:-1]])[real] + b, -30, 30)))
            p[(known[at[1:]] == known[at[:-1]])[real]] = 0.0
            doc = 0.0 - np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())
            bad = real[p >= OFFENDING].tolist()
            spans = places(raw, parts, bad)
            worst = spans[bad.index(int(real[p.argmax()]))] if bad else (None, None)
            cols["score"].append(float(doc) if held["const"] is None else held["const"])
            cols["n_sentences"].append(int((size > 0).sum()))
            cols["n_offending"].append(len(bad))
            cols["worst_start"].append(worst[0])
            cols["worst_end"].append(worst[1])
            cols["offending"].append(",".join(f"{x}:{y}" for x, y in spans))
        return cols
    return run


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, column: str = "toxic") -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted, n_sentences, n_offending, worst_start, worst_end,
    offending (start:end of every offending sentence, in order)."""
    sample = training_labels(labels, column, PARTS, FOLD, MAX_TRAIN)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    bags = map_texts(chosen, bag, "words array<int>, sizes array<int>", keep=("doc_id", "y"))
    rows = training_rows(bags, ("words", "sizes"), MAX_TRAIN, MAX_NUMBERS).toArrow()
    arrays = lambda c: [x.values.to_numpy() for x in rows.column(c)]
    model = spark.sparkContext.broadcast(fit(rows.column("y").to_pylist(), arrays("words"), arrays("sizes")))
    ddl = "score double, n_sentences int, n_offending int, worst_start int, worst_end int, offending string"
    out = map_texts(docs, scorer(model), ddl)
    return out.select("doc_id", held_out(PARTS, FOLD).alias("held_out"), "score",
                      (F.col("score") >= ACCEPT).cast("int").alias("predicted"), "n_sentences", "n_offending",
                      "worst_start", "worst_end", "offending")
