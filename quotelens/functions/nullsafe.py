"""Null-safe scalar helpers (all JVM-side expressions).

* NaN is turned into NULL on ingest: Spark sorts NaN as the largest value and
  ``avg`` over a NaN returns NaN, while the panel semantics treat it as missing.
* Division by zero gives NULL (``try_divide``) instead of raising in ANSI mode.
* Elapsed days count whole 24-hour periods (floor), as a timedelta's ``days``
  does, instead of calendar-day differences.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


DAY_MICROS = 86_400_000_000


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = col_(c)
    return F.when(~F.isnan(c), c)


def to_double(c) -> Column:
    """Numeric coercion: unparseable text becomes NULL, NaN becomes NULL."""
    return nan_to_null(col_(c).try_cast("double"))


def safe_div(num, den) -> Column:
    """num / den with NULL for a zero or NULL denominator."""
    return F.try_divide(col_(num), col_(den))


def floor_at(c, minimum: float = 1e-6) -> Column:
    """max(c, minimum) that keeps NULL as NULL (``greatest`` skips NULLs)."""
    c = col_(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(minimum)))


def elapsed_days(later, earlier) -> Column:
    """Whole 24-hour periods from ``earlier`` to ``later`` (floored, may be negative)."""
    return F.floor((ntz_micros(later) - ntz_micros(earlier)) / F.lit(DAY_MICROS)).cast("long")


def ntz_micros(c) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock time, from its parts: no session time zone takes part,
    so a day has 24 hours across a clock change too."""
    t = col_(c).cast("timestamp_ntz")
    part = F.pmod((F.extract(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("long"), F.lit(1_000_000))
    # unix_timestamp reads this type without a zone, and cuts towards 1970
    earlier = F.when((t < F.lit("1970-01-01").cast("timestamp_ntz")) & (part > 0), F.lit(1_000_000)).otherwise(F.lit(0))
    return F.unix_timestamp(t) * F.lit(1_000_000) + part - earlier


def ntz_at(micros: int) -> Column:
    """The wall-clock time so many microseconds after 1970-01-01: a literal, so that rows are compared without arithmetic."""
    days, rest = divmod(int(micros), DAY_MICROS)
    since = F.make_dt_interval(F.lit(days), F.lit(0), F.lit(0), F.lit(Decimal(rest).scaleb(-6)).cast("decimal(18,6)"))
    return F.lit("1970-01-01").cast("timestamp_ntz") + since


def minus_months(ts, months: int) -> Column:
    """ts - k calendar months, month-end clamped, time of day kept."""
    return col_(ts) - F.make_ym_interval(F.lit(0), F.lit(int(months)))


def month_start(ts) -> Column:
    """First instant of the month, as a timestamp without time zone."""
    return F.date_trunc("month", col_(ts)).cast("timestamp_ntz")


def to_ts(c) -> Column:
    """Date coercion: unparseable values become NULL."""
    return col_(c).try_cast("timestamp_ntz")
