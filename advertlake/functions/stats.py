"""Student-t tail probability as a Spark expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_sided_p(t: Column, freedom: Column) -> Column:
    """P(|T| >= t) for a whole number of degrees of freedom.

    Finite trigonometric series of Abramowitz and Stegun 26.7.3 (odd) and 26.7.4 (even). Each term
    follows from the one before it, so the series is a fold over its index.
    """
    nu = freedom.cast("double")
    theta = F.atan(t / F.sqrt(nu))
    sin, cos = F.sin(theta), F.cos(theta)
    odd = freedom % 2 == 1
    terms = F.floor((freedom - F.when(odd, 1).otherwise(0)) / 2).cast("int")

    def fold(ratio) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term"))
        return F.aggregate(
            F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>")),
            start,
            lambda acc, j: F.struct(
                (acc["sum"] + acc["term"]).alias("sum"),
                (acc["term"] * ratio(j) * cos * cos).alias("term"),
            ),
            lambda acc: acc["sum"],
        )

    odd_sum = fold(lambda j: 2.0 * j / (2.0 * j + 1.0))
    even_sum = fold(lambda j: (2.0 * j - 1.0) / (2.0 * j))
    p_odd = 1.0 - (2.0 / F.pi()) * (theta + sin * cos * odd_sum)
    p_even = 1.0 - sin * even_sum
    return F.when(freedom > 0, F.greatest(F.when(odd, p_odd).otherwise(p_even), F.lit(0.0)))
