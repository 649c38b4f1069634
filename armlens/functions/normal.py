"""Normal and chi-square tail probabilities as Spark expressions.

Spark has no error function. Below ``_SWITCH`` the all-positive power series of erf is summed;
above it the continued fraction of erfc is evaluated from the inside out. Both stay accurate to
about 1e-13 relative, far into the tail (tests compare with math.erfc).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SWITCH = 2.0
_SERIES_TERMS = 60
_FRACTION_DEPTH = 100


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0."""
    x = x.cast("double")
    square = x * x
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_SERIES_TERMS)),
        F.struct(x.alias("term"), x.alias("total")),
        lambda acc, n: F.struct(
            (acc["term"] * square * 2.0 / (n * 2 + 1)).alias("term"),
            (acc["total"] + acc["term"] * square * 2.0 / (n * 2 + 1)).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    near = F.lit(1.0) - series * F.exp(-square) * (2.0 / math.sqrt(math.pi))
    fraction = F.aggregate(
        F.sequence(F.lit(_FRACTION_DEPTH), F.lit(1), F.lit(-1)),
        x,
        lambda acc, k: x + k / 2.0 / acc,
    )
    far = F.exp(-square) / (fraction * math.sqrt(math.pi))
    return F.when(x < _SWITCH, near).otherwise(far)


def two_sided_p(z: Column) -> Column:
    """P(|Z| > |z|) for a standard normal Z."""
    return erfc(F.abs(z) / math.sqrt(2.0))


def chi2_tail(x: Column, degrees: Column) -> Column:
    """P(chi-square with ``degrees`` > x), closed form for every whole number of degrees."""
    x = x.cast("double")
    half = x / 2.0
    odd = degrees % 2 == 1
    # Both parities are a finite sum with term(i) = term(i-1) * x / (2i) or * x / (2i + 1).
    steps = F.filter(
        F.sequence(F.lit(1), F.greatest(degrees, F.lit(1))), lambda i: i * 2 < degrees
    )
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] * x / F.when(odd, i * 2 + 1).otherwise(i * 2)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    even_total = F.aggregate(steps, zero, add, lambda acc: acc["total"])
    odd_steps = F.filter(steps, lambda i: i * 2 + 1 < degrees)
    odd_total = F.aggregate(odd_steps, zero, add, lambda acc: acc["total"])
    even = F.exp(-half) * even_total
    head = erfc(F.sqrt(half))
    tail = F.sqrt(x * 2.0 / math.pi) * F.exp(-half) * odd_total
    return (
        F.when(degrees == 1, head)
        .when(odd, head + tail)
        .otherwise(even)
    )


def wilson(successes: Column, trials: Column, z: float) -> tuple[Column, Column]:
    """Lower and upper Wilson score bound of a proportion."""
    n = trials.cast("double")
    p = F.try_divide(successes.cast("double"), n)
    scale = F.try_divide(F.lit(z * z), n) + 1.0
    centre = (p + F.try_divide(F.lit(z * z / 2.0), n)) / scale
    spread = (
        F.sqrt(F.try_divide(p * (1.0 - p), n) + F.try_divide(F.lit(z * z / 4.0), n * n))
        * z / scale
    )
    return centre - spread, centre + spread
