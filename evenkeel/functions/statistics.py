"""Tail probabilities as native expressions.

They are meant for result rows (one per feature), where a fold of some dozens
of steps costs nothing. Everything follows from the regularized upper
incomplete gamma function Q(a, x):

* chi-square with k degrees of freedom:  P(X > x) = Q(k / 2, x / 2)
* two-sided normal:                      P(|Z| > z) = Q(1 / 2, z^2 / 2)

Q is summed as a power series of its complement below x = a + 1 and evaluated
as a continued fraction from there on (Abramowitz & Stegun 6.5.29, 6.5.31).
The number of steps follows sqrt(a), where either form has converged to double
precision, so the degrees of freedom need no upper limit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 8
_KS_TERMS = 100
_KS_CERTAIN = 0.2


def log_gamma(a: Column) -> Column:
    """ln(Gamma(a)) for a > 0: Stirling's series at a + 8, stepped back down."""
    z = a + F.lit(float(_SHIFT))
    product = a
    for step in range(1, _SHIFT):
        product = product * (a + F.lit(float(step)))
    series = (
        F.lit(1 / 12) / z
        - F.lit(1 / 360) / (z * z * z)
        + F.lit(1 / 1260) / (z * z * z * z * z)
        - F.lit(1 / 1680) / (z * z * z * z * z * z * z)
    )
    return (z - 0.5) * F.ln(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series - F.ln(product)


def upper_gamma(a: Column, x: Column) -> Column:
    """Q(a, x) for a > 0; 1 at x <= 0, null where an argument is null."""
    a = a.cast("double")
    x = x.cast("double")
    steps = (F.lit(80) + F.ceil(F.lit(10.0) * F.sqrt(a))).cast("int")
    scale = F.exp(a * F.ln(x) - x - log_gamma(a))

    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def grow(state: Column, n: Column) -> Column:
        term = state["term"] * x / (a + n)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    series = F.aggregate(F.sequence(F.lit(1), steps), start, grow, lambda s: s["total"])
    lower = scale / a * series

    def unfold(below: Column, n: Column) -> Column:
        return x + 2 * n - 1 - a - n * (n - a) / below

    fraction = F.aggregate(
        F.sequence(steps, F.lit(1), F.lit(-1)), x + 2 * steps + 1 - a, unfold
    )
    return (
        F.when(x.isNull() | a.isNull(), F.lit(None).cast("double"))
        .when(x <= 0, 1.0)
        .when(x < a + 1, F.greatest(F.lit(0.0), 1 - lower))
        .otherwise(scale / fraction)
    )


def chi_square_tail(statistic: Column, degrees: Column) -> Column:
    return F.when(degrees > 0, upper_gamma(degrees / F.lit(2.0), statistic / F.lit(2.0)))


def normal_two_sided(z: Column) -> Column:
    return upper_gamma(F.lit(0.5), z * z / F.lit(2.0))


def kolmogorov_tail(distance: Column, n_left: Column, n_right: Column) -> Column:
    """Asymptotic p-value of a two-sample Kolmogorov-Smirnov distance."""
    left, right = n_left.cast("double"), n_right.cast("double")
    size = F.try_divide(left * right, left + right)
    scaled = distance * F.sqrt(size)

    def term(k: Column) -> Column:
        sign = F.when(k % 2 == 1, 1.0).otherwise(-1.0)
        return sign * F.exp(F.lit(-2.0) * k * k * scaled * scaled)

    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(_KS_TERMS)), F.lit(0.0), lambda acc, k: acc + term(k)
    )
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * total))
    return F.when(scaled < _KS_CERTAIN, 1.0).when(scaled.isNotNull(), clipped)
