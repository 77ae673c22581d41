"""Student-t tail probability as a native column expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_sided_t(t: Column, degrees: Column) -> Column:
    """Two-sided p-value of a t statistic with a whole number of degrees of freedom.

    For whole degrees the distribution is a finite trigonometric sum (Abramowitz and
    Stegun 26.7.3/4): with theta = atan(t / sqrt(v)) the central probability is
    sin * (1 + 1/2 cos^2 + 1*3/(2*4) cos^4 + ...) for even v and
    2/pi * (theta + sin * (cos + 2/3 cos^3 + ...)) for odd v.
    NULL when there is no degree of freedom left or t is NULL.
    """
    v = degrees.cast("int")
    size = F.abs(t.cast("double"))
    theta = F.atan(size / F.sqrt(v.cast("double")))
    sin, cos = F.sin(theta), F.cos(theta)
    odd = v % 2 == 1
    terms = F.floor(v / 2).cast("int")
    first = F.when(odd, cos).otherwise(F.lit(1.0))

    def step(acc: Column, k: Column) -> Column:
        k = k.cast("double")
        growth = F.when(odd, 2 * k / (2 * k + 1)).otherwise((2 * k - 1) / (2 * k))
        term = acc["term"] * growth * cos * cos
        return F.struct((acc["total"] + term).alias("total"), term.alias("term"))

    series = F.aggregate(
        F.when(terms > 1, F.sequence(F.lit(1), terms - 1)).otherwise(F.array().cast("array<int>")),
        F.struct(first.alias("total"), first.alias("term")),
        step,
        lambda acc: acc["total"],
    )
    central = (
        F.when(v == 1, theta * (2 / math.pi))
        .when(odd, (theta + sin * series) * (2 / math.pi))
        .otherwise(sin * series)
    )
    return F.when((v >= 1) & size.isNotNull(), F.greatest(F.lit(0.0), 1 - central))
