"""Standard normal density and distribution as Column arithmetic.

Spark has no ``erf``.  The distribution is Hart's rational approximation in the double
precision form of West (2005), "Better approximations to cumulative normal functions";
its absolute error is near machine epsilon, and it stays inside generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the published approximation, highest power first.
NUMERATOR = (
    3.52624965998911e-02,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
)
DENOMINATOR = (
    8.83883476483184e-02,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
)
SPLIT = 7.07106781186547
SQRT_2PI = math.sqrt(2.0 * math.pi)


def norm_pdf(x: Column) -> Column:
    return F.exp(-x * x / F.lit(2.0)) / F.lit(SQRT_2PI)


def _horner(coefficients: tuple[float, ...], z: str) -> str:
    text = f"{coefficients[0]!r}D"
    for c in coefficients[1:]:
        text = f"({text} * {z} + {c!r}D)"
    return text


def upper_tail(name: str) -> Column:
    """P(X > |x|) of the column ``name``, built as one SQL expression: it has about a
    hundred nodes, and making them one call at a time takes longer than planning."""
    z = f"abs(`{name}`)"
    weight = f"exp(-{z} * {z} / 2D)"
    fraction = f"({z} + 0.65D)"
    for k in (4, 3, 2, 1):
        fraction = f"({z} + {k}D / {fraction})"
    near = f"{weight} * {_horner(NUMERATOR, z)} / {_horner(DENOMINATOR, z)}"
    far = f"{weight} / ({fraction} * {SQRT_2PI!r}D)"
    return F.expr(f"CASE WHEN {z} < {SPLIT!r}D THEN {near} ELSE {far} END")


def norm_cdf(name: str) -> Column:
    """P(X <= x) of the column ``name``."""
    tail = upper_tail(name)
    return F.when(F.col(name) > 0, F.lit(1.0) - tail).otherwise(tail)
