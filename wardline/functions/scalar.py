"""Small scalar expressions (recodes, top-coding, thresholds).

All are built-in Column expressions: no Python UDFs anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def capitalise(c) -> Column:
    """First character kept, the rest lower-cased ('HISPANIC' -> 'Hispanic').

    Unlike ``initcap`` this leaves later words lower-case, as the reference's
    ``x[0] + x[1:].lower()`` does.
    """
    c = _col(c)
    return F.concat(F.substring(c, 1, 1), F.lower(F.substr(c, F.lit(2))))


def topcode(c, limit: float, value: float) -> Column:
    """``CASE WHEN c > limit THEN value ELSE c END`` (de-identified ages)."""
    c = _col(c)
    return F.when(c > F.lit(limit), F.lit(value)).otherwise(c)


def recode_contains(c, patterns: Sequence[str], default: str, capital: bool = True) -> Column:
    """Keyword recode: the value becomes the *last* listed pattern it contains.

    The reference assigns masks computed up front in list order, so a value
    containing two keywords ends with the later one.  No keyword -> ``default``;
    NULL -> ``default`` as well.  ``contains`` is case-sensitive.
    """
    c = _col(c)
    expr = None
    for p in reversed(list(patterns)):
        cond = c.contains(p)
        expr = F.when(cond, F.lit(p)) if expr is None else expr.when(cond, F.lit(p))
    out = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return capitalise(out) if capital else out


def binary_recode(c, match: str, yes: str, no: str) -> Column:
    """``yes if c == match else no`` (NULL -> ``no``, as the pandas lambda does)."""
    return F.when(_col(c) == F.lit(match), F.lit(yes)).otherwise(F.lit(no))


def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(c).cast("double")))


def threshold_label(p, cut: float = 0.5) -> Column:
    """``(p > cut) * 1`` as int."""
    return (_col(p) > F.lit(cut)).cast("int")


def reversed_hour_index(h, top: int = 45) -> Column:
    """``top - ceil(h)`` (bigint)."""
    return F.lit(top) - F.ceil(_col(h).cast("double"))


def band(mean, sd, z: float = 1.96) -> tuple[Column, Column]:
    """``mean -/+ z * sd``."""
    m, s = _col(mean), _col(sd)
    return m - F.lit(z) * s, m + F.lit(z) * s


def safe_divide(a, b) -> Column:
    """Division that yields NULL for a zero denominator (ANSI mode raises)."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))
