"""Civil-time (TIMESTAMP_NTZ) arithmetic with warehouse boundary semantics.

Warehouse ``DATETIME_DIFF(a, b, PART)`` counts *boundaries* of ``PART``
crossed between ``b`` and ``a`` (10:59 -> 11:01 is one hour), not elapsed
whole units.  All helpers work from epoch microseconds computed with
``timestampdiff`` against the NTZ epoch, so they do not depend on the
session time zone and stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_US_PER_SECOND = 1_000_000
_US_PER_HOUR = 3_600 * _US_PER_SECOND


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ (civil time).

    Built from the wall-clock parts (date, hour, minute, fractional second),
    so it does not depend on the session time zone: casting NTZ to a zoned
    timestamp would shift differences across daylight-saving changes when a
    session is not in UTC.
    """
    c = _col(ts)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    secs = F.date_part(F.lit("SECOND"), c)                   # decimal(8,6): seconds with fraction
    return (days * F.lit(86_400 * _US_PER_SECOND)
            + F.hour(c).cast("long") * F.lit(_US_PER_HOUR)
            + F.minute(c).cast("long") * F.lit(60 * _US_PER_SECOND)
            + (secs * F.lit(_US_PER_SECOND)).cast("long"))


def _floor_div(x: Column, unit: int) -> Column:
    return F.floor(x / F.lit(unit)).cast("long")


def diff_seconds(a, b) -> Column:
    """``DATETIME_DIFF(a, b, SECOND)``: second boundaries between b and a (long)."""
    return _floor_div(epoch_micros(a), _US_PER_SECOND) - _floor_div(epoch_micros(b), _US_PER_SECOND)


def diff_hours(a, b) -> Column:
    """``DATETIME_DIFF(a, b, SECOND) / 60.0 / 60.0`` as double (fractional hours)."""
    return diff_seconds(a, b).cast("double") / 3600.0


def diff_days_elapsed(a, b) -> Column:
    """``DATETIME_DIFF(a, b, SECOND) / 60.0 / 60.0 / 24.0`` as double."""
    return diff_seconds(a, b).cast("double") / 86400.0


def diff_hours_boundary(a, b) -> Column:
    """``DATETIME_DIFF(a, b, HOUR)``: hour boundaries crossed (long)."""
    return _floor_div(epoch_micros(a), _US_PER_HOUR) - _floor_div(epoch_micros(b), _US_PER_HOUR)


def diff_days(a, b) -> Column:
    """``DATE_DIFF(a, b, DAY)``: midnights crossed (int)."""
    return F.datediff(F.to_date(_col(a)), F.to_date(_col(b))).cast("long")


def diff_years(a, b) -> Column:
    """``DATE_DIFF(a, b, YEAR)``: year boundaries crossed (int)."""
    return (F.year(_col(a)) - F.year(_col(b))).cast("long")


def add_hours(ts, hours: int) -> Column:
    """``ts + INTERVAL hours HOUR`` (negative to subtract); stays NTZ."""
    return _col(ts) + F.make_dt_interval(F.lit(0), F.lit(int(hours)))


def add_fractional_hours(ts, hours) -> Column:
    """``ts + Timedelta(hours=h)`` for a fractional-hours column, microsecond exact.

    The offset is rounded to whole microseconds, as a pandas Timedelta is.
    """
    h = _col(hours) if not isinstance(hours, (int, float)) else F.lit(float(hours))
    micros = F.round(h.cast("double") * F.lit(float(_US_PER_HOUR))).cast("long")
    return F.timestamp_add("MICROSECOND", micros, _col(ts))
