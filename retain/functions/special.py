"""Special functions as column expressions, so that they are computed where the rows are."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SHIFT = 8
# Coefficients of Stirling's series, B(2k) / (2k (2k - 1)).
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)


def log_gamma(z: Column) -> Column:
    """ln(gamma(z)) for z > 0: Stirling's series `SHIFT` places further up, less the steps to there."""
    up = z + SHIFT
    steps = reduce(lambda a, b: a * b, [z + i for i in range(SHIFT)])
    series = reduce(lambda a, b: a + b, [F.lit(c) / F.pow(up, F.lit(2.0 * k + 1)) for k, c in enumerate(STIRLING)])
    return (up - 0.5) * F.ln(up) - up + F.lit(0.5 * math.log(2 * math.pi)) + series - F.ln(steps)


def _beta_tail(x: Column, rest: Column, a: Column, b: Column) -> Column:
    """The regularized incomplete beta by its continued fraction, from the last term to the first.

    `rest` is 1 - x. The number of terms grows with the square root of the larger parameter.
    """
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.ln(x) + b * F.ln(rest))
    terms = (F.lit(200) + F.ceil(F.sqrt(F.greatest(a, b)) * 4)).cast("int")

    def term(fraction: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + m * 2 - 1) * (a + m * 2))
        odd = -(a + m) * (a + b + m) * x / ((a + m * 2) * (a + m * 2 + 1))
        return F.lit(1.0) + even / (F.lit(1.0) + odd / fraction)

    fraction = F.aggregate(F.sequence(terms, F.lit(1), F.lit(-1)), F.lit(1.0), term)
    return front / (a * (F.lit(1.0) - (a + b) * x / (a + 1) / fraction))


def two_sided_p(t: Column, freedom: Column) -> Column:
    """P(|T| > |t|) of Student's distribution; null if either is null or there is no freedom."""
    t, freedom = t.cast("double"), freedom.cast("double")
    square = t * t
    x, rest = freedom / (freedom + square), square / (freedom + square)
    a, b = freedom / 2, F.lit(0.5)
    p = F.when(x > (a + 1) / (a + b + 2), F.lit(1.0) - _beta_tail(rest, x, b, a)).otherwise(_beta_tail(x, rest, a, b))
    return F.when(freedom > 0, F.when(rest <= 0, 1.0).when(x <= 0, 0.0).otherwise(p))
