"""Strassen's recursive multiplication of integer matrices."""

from __future__ import annotations

from scorewright.llm.common import by_value

by_value(__name__)

LEAF = 32       # least dimension that is still cut in two


def padded(x, rows: int, cols: int):
    """``x`` with zero rows and columns added up to the shape."""
    import numpy as np

    if x.shape == (rows, cols):
        return x
    out = np.zeros((rows, cols), x.dtype)
    out[:x.shape[0], :x.shape[1]] = x
    return out


def multiply(a, b, leaf: int = LEAF):
    """Product of two integer matrices by seven half-size products a level, exact in the arrays' integer arithmetic.

    int64 sums wrap, so a product is right whenever its own entries fit, whatever the sums between.  Odd dimensions are
    padded with zeros; a matrix with a dimension of ``leaf`` or less is multiplied directly.
    """
    m, k, n = *a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    h, q, w = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a, b = padded(a, 2 * h, 2 * q), padded(b, 2 * q, 2 * w)
    a11, a12, a21, a22 = a[:h, :q], a[:h, q:], a[h:, :q], a[h:, q:]
    b11, b12, b21, b22 = b[:q, :w], b[:q, w:], b[q:, :w], b[q:, w:]
    p1 = multiply(a11 + a22, b11 + b22, leaf)
    p2 = multiply(a21 + a22, b11, leaf)
    p3 = multiply(a11, b12 - b22, leaf)
    p4 = multiply(a22, b21 - b11, leaf)
    p5 = multiply(a11 + a12, b22, leaf)
    p6 = multiply(a21 - a11, b11 + b12, leaf)
    p7 = multiply(a12 - a22, b21 + b22, leaf)
    # rows of the result: p1 + p4 - p5 + p7, p3 + p5 / p2 + p4, p1 - p2 + p3 + p6
    import numpy as np

    out = np.empty((2 * h, 2 * w), p1.dtype)
    out[:h, w:] = p3 + p5
    out[h:, :w] = p2 + p4
    p7 += p1
    p7 += p4
    p7 -= p5
    out[:h, :w] = p7
    p1 -= p2
    p1 += p3
    p1 += p6
    out[h:, w:] = p1
    return out[:m, :n]
