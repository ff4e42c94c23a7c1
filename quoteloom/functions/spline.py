"""Natural cubic spline evaluation.

With fixed knots the spline value is linear in the knot heights, so ``fixed_knots``
turns the knots into constant weights once and evaluates in Column arithmetic.
``any_knots`` takes knots from array columns and eliminates the tridiagonal system of each row
by folds over them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def curvature_weights(xs: np.ndarray) -> np.ndarray:
    """Matrix W with second derivatives = W @ ys, zero at both ends."""
    n = len(xs)
    w = np.zeros((n, n))
    if n < 3:
        return w
    h = np.diff(xs)
    system = np.diag((h[:-1] + h[1:]) / 3.0)
    system += np.diag(h[1:-1] / 6.0, 1) + np.diag(h[1:-1] / 6.0, -1)
    slopes = np.zeros((n - 2, n))
    for i in range(n - 2):
        slopes[i, i] = 1.0 / h[i]
        slopes[i, i + 2] = 1.0 / h[i + 1]
        slopes[i, i + 1] = -slopes[i, i] - slopes[i, i + 2]
    w[1:-1] = np.linalg.solve(system, slopes)
    return w


def _segment(x0, x1, y0, y1, m0, m1, t):
    h = x1 - x0
    a = (x1 - t) / h
    b = (t - x0) / h
    return a * y0 + b * y1 + ((a * a * a - a) * m0 + (b * b * b - b) * m1) * (h * h / 6.0)


def fixed_knots(xs: list[float], ys: list[Column], t: Column, extrapolate: str = "const") -> Column:
    """Spline through (xs, ys) at ``t``; ``const`` holds the end values, ``cubic``
    extends the end segments."""
    w = curvature_weights(np.asarray(xs, dtype=float))
    n = len(xs)

    def curvature(i: int) -> Column:
        total = F.lit(0.0)
        for j in range(n):
            if w[i, j] != 0.0:
                total = total + F.lit(float(w[i, j])) * ys[j]
        return total

    def piece(i: int) -> Column:
        return _segment(
            F.lit(xs[i]), F.lit(xs[i + 1]), ys[i], ys[i + 1], curvature(i), curvature(i + 1), t
        )

    value = piece(n - 2)
    for i in range(n - 3, -1, -1):
        value = F.when(t <= F.lit(xs[i + 1]), piece(i)).otherwise(value)
    if extrapolate == "const":
        value = (
            F.when(t <= F.lit(xs[0]), ys[0]).when(t >= F.lit(xs[-1]), ys[-1]).otherwise(value)
        )
    return value


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def curvatures(xs: Column, ys: Column) -> Column:
    """Second derivatives at the knots, zero at both ends: the tridiagonal system solved by
    elimination, as one fold up the inner knots and one back down."""
    inner = F.when(F.size(xs) > 2, F.sequence(F.lit(2), F.size(xs) - 1)).otherwise(F.array().cast("array<int>"))

    def up(done: Column, k: Column) -> Column:
        h0, h1 = F.element_at(xs, k) - F.element_at(xs, k - 1), F.element_at(xs, k + 1) - F.element_at(xs, k)
        slope = F.try_divide(F.element_at(ys, k + 1) - F.element_at(ys, k), h1) - F.try_divide(F.element_at(ys, k) - F.element_at(ys, k - 1), h0)
        pivot = (h0 + h1) / 3.0 - h0 / 6.0 * F.element_at(done["c"], -1)
        c = F.try_divide(h1 / 6.0, pivot)
        d = F.try_divide(slope - h0 / 6.0 * F.element_at(done["d"], -1), pivot)
        return F.struct(F.concat(done["c"], F.array(c)).alias("c"), F.concat(done["d"], F.array(d)).alias("d"))

    zero = F.array(F.lit(0.0)).cast("array<double>")
    swept = F.aggregate(inner, F.struct(zero.alias("c"), zero.alias("d")), up)

    def solve(given: Column) -> Column:
        def down(m: Column, k: Column) -> Column:
            return F.concat(F.array(F.element_at(given["d"], k) - F.element_at(given["c"], k) * F.element_at(m, 1)), m)

        return F.concat(zero, F.aggregate(F.reverse(inner), zero, down))

    return _let(swept, solve)


def any_knots(xs: Column, ys: Column, t: Column, extrapolate: str = "const") -> Column:
    """Spline through per-row array columns (sorted by x); no knots give 0.

    All in Column arithmetic.  Two knots of one x give null, as does a null ``t``.
    """
    xs, ys, t = xs.cast("array<double>"), ys.cast("array<double>"), t.cast("double")
    n = F.size(xs)
    # Segment of t: one-based number of its left knot.
    left = F.greatest(F.lit(1), F.least(F.size(F.filter(xs, lambda x: x < t)), n - 1))

    def value(m: Column) -> Column:
        def of(i: Column) -> Column:
            j = i + 1
            x0, x1 = F.element_at(xs, i), F.element_at(xs, j)
            h = x1 - x0
            a, b = F.try_divide(x1 - t, h), F.try_divide(t - x0, h)
            straight = a * F.element_at(ys, i) + b * F.element_at(ys, j)
            return straight + ((a * a * a - a) * F.element_at(m, i) + (b * b * b - b) * F.element_at(m, j)) * (h * h / 6.0)

        return _let(left, of)

    inside = _let(curvatures(xs, ys), value)
    if extrapolate == "const":
        inside = (
            F.when(t <= F.element_at(xs, 1), F.element_at(ys, 1)).when(t >= F.element_at(xs, -1), F.element_at(ys, -1)).otherwise(inside)
        )
    none = xs.isNull() | (n == 0)
    return F.when(none, 0.0).when(n == 1, F.element_at(ys, 1)).otherwise(F.when(t.isNotNull(), inside))
