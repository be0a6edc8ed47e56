"""Exact binomial tails as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The coefficients of Stirling's series for the logarithm of the gamma function.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
#: Arguments below it are raised to it by the recurrence before the series is used.
_SHIFT = 16


def log_factorial(n: Column) -> Column:
    """ln(n!) of a whole number, to about 1e-13 of its size."""
    x = n.cast("double") + 1
    below = F.greatest(F.lit(0), _SHIFT - n.cast("int") - 1)
    raised = x + below
    steps = F.when(below > 0, F.sequence(F.lit(0), below - 1)).otherwise(
        F.array().cast("array<int>")
    )
    product = F.aggregate(steps, F.lit(0.0), lambda total, i: total + F.log(x + i))
    series = sum(
        (F.lit(c) / F.pow(raised, F.lit(float(2 * i + 1))) for i, c in enumerate(_STIRLING)),
        F.lit(0.0),
    )
    stirling = (raised - 0.5) * F.log(raised) - raised + 0.5 * math.log(2 * math.pi) + series
    return F.when(n < 2, F.lit(0.0)).otherwise(stirling - product)


def lower_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of ``n`` trials of chance ``p``.

    Terms are summed from the k-th down as long as they count: below the mean they fall at least as
    fast as a normal density, so there are some 10 roots of the number of trials of them; from the
    mean on, where the tail is no small number, the other one is summed.
    """
    few = k < n * p
    lower = _summed(k, n, p)
    upper = _summed(n - k - 1, n, 1 - p)
    return F.when(k >= n, F.lit(1.0)).when(few, lower).otherwise(1 - upper)


def upper_tail(k: Column, n: Column, p: float) -> Column:
    """P(X >= k) for X of ``n`` trials of chance ``p``."""
    return lower_tail(n - k, n, 1 - p)


def _summed(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for a k below the mean: the k-th term times the sum of the ratios to it."""
    first = (
        log_factorial(n)
        - log_factorial(k)
        - log_factorial(n - k)
        + k * math.log(p)
        + (n - k) * math.log1p(-p)
    )
    reach = F.ceil(10 * F.sqrt(n.cast("double"))) + 100
    steps = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.least(k, reach.cast("long")) - 1))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(seen: Column, i: Column) -> Column:
        at = (k - i).cast("double")
        term = seen["term"] * at / (n - at + 1) * ((1 - p) / p)
        return F.struct(term.alias("term"), (seen["sum"] + term).alias("sum"))

    ratios = F.aggregate(steps, start, add)["sum"]
    return F.when(k < 0, F.lit(0.0)).otherwise(
        F.exp(first) * F.when(k == 0, F.lit(1.0)).otherwise(ratios)
    )
