"""Chi-square upper tail from built-in expressions: the regularised incomplete gamma function.

With a = dof / 2 and x = statistic / 2 the tail is Q(a, x).  Below x = a + 1 it is one minus
the power series of P(a, x), beyond it a continued fraction, evaluated from its last term
back; both have a fixed number of terms, so the expression is bounded.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TERMS = 300


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_gamma_half(dof) -> Column:
    """ln Gamma(dof / 2) for a whole ``dof`` of 1 or more: a sum of logarithms from Gamma(1/2) or Gamma(1) up."""
    dof = _column(dof).cast("int")
    odd = dof % 2 == 1
    first = F.when(odd, F.lit(0.5)).otherwise(F.lit(1.0))
    steps = F.when(odd, (dof - 1) / 2).otherwise(dof / 2 - 1).cast("int")
    factors = F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(factors, F.when(odd, F.lit(math.log(math.pi) / 2)).otherwise(F.lit(0.0)), lambda t, i: t + F.log(first + i))


def chi2_sf(statistic, dof) -> Column:
    """P(X >= statistic) for X chi-square with a whole number of degrees of freedom; NULL without one."""
    stat, dof = _column(statistic).cast("double"), _column(dof)
    a, x = dof.cast("double") / 2.0, stat / 2.0
    scale = F.exp(a * F.log(x) - x - log_gamma_half(dof))  # x^a e^-x / Gamma(a)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)), start,
        lambda s, n: F.struct((s["term"] * x / (a + n)).alias("term"), (s["total"] + s["term"] * x / (a + n)).alias("total")),
        lambda s: s["total"])
    fraction = F.aggregate(F.sequence(F.lit(TERMS), F.lit(1)), x + F.lit(2.0 * TERMS + 1.0) - a,
                           lambda f, i: (x + 2.0 * i - 1.0 - a) - i * (i - a) / f)
    tail = F.when(x < a + 1.0, F.lit(1.0) - scale * series / a).otherwise(scale / fraction)
    return F.when(dof.isNull() | stat.isNull() | F.isnan(stat) | (dof < 1), F.lit(None).cast("double")).when(x <= 0, F.lit(1.0)).when(x == float("inf"), F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))
