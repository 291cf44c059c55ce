"""Quality classifier: Naive Bayes support vectors.

Features.  A text becomes the indicators of its n-grams over character classes: the UTF-8 bytes are mapped to twelve
classes, runs of one class are collapsed, and every 1- to 3-gram of the runs is an indicator together with the power
of two of its share in the text ("this 3-gram makes up 1/8 to 1/4 of the text").  Pairs of equal neighbouring words,
repeated words and repeated lines are indicators of the same kind.  Its distinct words (A-Z lower-cased, cut at blanks
and ASCII marks) and pairs of neighbouring words are indicators hashed to ``2**WORD_BITS`` numbers.

Method.  The indicators are scaled by the log ratio of their smoothed frequencies in the two classes, and a linear
hinge-loss model is fitted to the scaled indicators by dual coordinate descent.  A logistic curve fitted to the
training margins turns a margin into a score.

Bounds.  The fit uses at most ``MAX_TRAIN`` labelled rows with ``MAX_NUMBERS`` indicators in all, the documented bound
of the fit and of what reaches the driver.  The model is a vector of ``N_FEATURES`` numbers.  Every whole text is scored,
in one pass that writes nothing.

Defined results.  A null or empty text has only the "no words" indicator and gets a score.  Repeated rows get equal
scores; labels that disagree count as the larger; null ids or labels teach nothing.  With no labelled row, or one
class only, every score is the share of label 1 (0.5 without labels).  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm.common import by_value, map_texts
from scorewright.llm.labelled import held_out, training_labels, training_rows

by_value(__name__)

PARTS, FOLD = 4, 2          # crc32(doc_id) mod 4 = 2 is held out
MAX_TRAIN = 20_000          # labelled rows that the fit may use
MAX_NUMBERS = 16_000_000    # indicators of these rows together
ACCEPT = 0.7
SMOOTHING = 1.0
COST = 1.0                  # hinge-loss weight
EPOCHS = 30

_CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".",
            b",;:", b"!?", b"|", b"#*$%&<>", b"\"'()[]{}+-/=@\\^_`~")   # any other byte: class 11
_K = len(_CLASSES) + 1
_GRAMS = _K + _K ** 2 + _K ** 3
_EXTRA = 4                  # equal neighbours, repeated words, repeated lines, words (by their number)
_LEVELS = 12
_FORMS = (_GRAMS + _EXTRA) * _LEVELS
WORD_BITS = 19              # words and pairs of words are hashed to 2**WORD_BITS numbers
N_FEATURES = _FORMS + (1 << WORD_BITS)

_MARKS = bytes(c for c in range(128) if not chr(c).isalnum())
_WORDS = bytes.maketrans(_MARKS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(_MARKS) + b"abcdefghijklmnopqrstuvwxyz")
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)     # odd multipliers of the word hashes


class _Hashes(dict):
    """crc32 of every word asked for."""

    def __missing__(self, word: bytes) -> int:
        from zlib import crc32

        self[word] = found = crc32(word) + 1
        return found


def word_numbers(raw: bytes, known: dict):
    """The distinct hash numbers of the words and pairs of neighbouring words of a text."""
    import numpy as np

    words = raw.translate(_WORDS).split()
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    one, two = (np.uint64(m) for m in _MIX)
    both = np.r_[h * one, (h[:-1] * one + h[1:]) * two]
    return np.unique(both >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def indicators(texts: list[str]) -> dict[str, list]:
    """The sorted feature numbers of every text."""
    import numpy as np

    table = np.full(256, _K - 1, np.int64)
    for i, chars in enumerate(_CLASSES):
        table[list(chars)] = i
    out, known = [], _Hashes()
    for text in texts:
        raw = text.encode()
        words = raw.split()
        feats = []
        if raw:
            c = table[np.frombuffer(raw, np.uint8)]
            c = c[np.r_[True, c[1:] != c[:-1]]]
            base = 0
            for n in (1, 2, 3):
                if len(c) >= n:
                    code = c[:len(c) - n + 1].copy()
                    for j in range(1, n):
                        code = code * _K + c[j:len(c) - n + 1 + j]
                    counts = np.bincount(code, minlength=_K ** n)
                    seen = np.flatnonzero(counts)
                    level = np.minimum(-np.floor(np.log2(counts[seen] / len(code))), _LEVELS - 1).astype(np.int64)
                    feats.append((base + seen) * _LEVELS + level)
                base += _K ** n
        lines = [x for x in raw.split(b"\n") if x.strip()]
        n_words = len(words)
        extra = (
            (sum(map(bytes.__eq__, words, words[1:])), n_words),
            (n_words - len(set(words)), n_words),
            (len(lines) - len(set(lines)), len(lines)),
        )
        more = [(_GRAMS + i) * _LEVELS + min(_LEVELS - 1, int(-np.floor(np.log2(a / b))))
                for i, (a, b) in enumerate(extra) if a]
        more.append((_GRAMS + 3) * _LEVELS + min(_LEVELS - 1, n_words.bit_length()))
        feats.append(np.array(more, np.int64))
        feats.append(_FORMS + word_numbers(raw, known))
        out.append(np.concatenate(feats))
    return {"feats": out}


def dual_descent(feats: list, values: list, y, upper, n_features: int, epochs: int):
    """Weights, bias and duals that minimise ``(|w|^2 + b^2) / 2 + sum(upper * hinge)`` by dual coordinate descent."""
    import numpy as np

    w, b, alpha = np.zeros(n_features), 0.0, np.zeros(len(y))
    diag = np.array([(s * s).sum() + 1 for s in values])    # the bias is a constant feature
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            f, s = feats[i], values[i]
            grad = y[i] * (w[f] @ s + b) - 1
            new = min(max(alpha[i] - grad / diag[i], 0), upper[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[f] += step * s
                b += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, b, alpha


def fit(rows: list, n_features: int = N_FEATURES, cost: float = COST, epochs: int = EPOCHS) -> dict:
    """Fit on (y, feats) rows: log-count ratios, dual coordinate descent for the hinge loss, logistic calibration."""
    import numpy as np

    y = np.array([1 if r[0] else -1 for r in rows])
    if len(rows) == 0 or abs(y.sum()) == len(y):
        return {"w": np.zeros(n_features), "b": 0.0, "const": 0.5 if len(rows) == 0 else float((y[0] + 1) / 2)}
    feats = [np.asarray(r[1], np.int64) for r in rows]
    counts = [np.full(n_features, SMOOTHING), np.full(n_features, SMOOTHING)]
    for f, s in zip(feats, y):
        counts[int(s > 0)][f] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    # classes weigh the same
    upper = np.where(y > 0, cost * len(y) / (2 * (y > 0).sum()), cost * len(y) / (2 * (y < 0).sum()))
    w, b, _ = dual_descent(feats, [ratio[f] for f in feats], y, upper, n_features, epochs)
    w *= ratio
    margin = np.array([w[f].sum() + b for f in feats])
    slope, shift, t = 1.0, 0.0, (y > 0) * 0.98 + 0.01       # logistic curve through the margins, by Newton steps
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        g, v = p - t, np.maximum(p * (1 - p), 1e-6)
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-3]])
        d = np.linalg.solve(h, np.array([(g * margin).sum(), g.sum()]))
        slope, shift = slope - d[0], shift - d[1]
        if abs(d).max() < 1e-6:
            break
    return {"w": w * slope, "b": b * slope + shift, "const": None}


def scorer(model):
    """A function of texts: their scores under a broadcast model."""
    def run(texts: list[str]) -> dict[str, list]:
        import math

        held = model.value
        if held["const"] is not None:
            return {"score": [held["const"]] * len(texts)}
        margins = (float(held["w"][f].sum()) + held["b"] for f in indicators(texts)["feats"])
        return {"score": [1 / (1 + math.exp(-min(max(z, -30.0), 30.0))) for z in margins]}
    return run


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, column: str = "quality") -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted."""
    sample = training_labels(labels, column, PARTS, FOLD, MAX_TRAIN)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    feats = map_texts(chosen, indicators, "feats array<int>", keep=("doc_id", "y"))
    rows = training_rows(feats, ("feats",), MAX_TRAIN, MAX_NUMBERS).toArrow()
    fitted = fit(list(zip(rows.column("y").to_pylist(), (x.values.to_numpy() for x in rows.column("feats")))))
    out = map_texts(docs, scorer(spark.sparkContext.broadcast(fitted)), "score double")
    return out.select("doc_id", held_out(PARTS, FOLD).alias("held_out"), "score",
                      (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
