"""The difference of two dates as years, months and days: ``age(later, earlier)``.

Whole years, then whole months, then days; days are borrowed from the month of
the earlier of the two, as PostgreSQL does. With timestamps the time of day is
taken first, and a day is borrowed for it where needed. If ``later`` is before
``earlier``, all parts are those of the reverse, negated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _clock(x: Column) -> Column:
    """Microseconds since midnight."""
    return F.unix_micros(x.cast("timestamp")) - F.unix_micros(F.to_date(x).cast("timestamp"))


def age(later: str | Column, earlier: str | Column, timed: bool = False) -> Column:
    """Struct (``years``, ``months``, ``days``), with ``timed`` (timestamps)
    also ``micros``; bigints. NULL if either is NULL."""
    a, b = _c(later), _c(earlier)
    hi, lo = F.greatest(a, b), F.least(a, b)
    clock = _clock(hi) - _clock(lo) if timed else F.lit(0)
    short_day = F.when(clock < 0, 1).otherwise(0)
    days = F.dayofmonth(hi) - F.dayofmonth(lo) - short_day
    short_month = F.when(days < 0, 1).otherwise(0)
    months = (F.year(hi) - F.year(lo)) * 12 + F.month(hi) - F.month(lo) - short_month
    sign = F.when(a < b, -1).otherwise(1)
    parts = {
        "years": F.floor(months / 12),
        "months": F.pmod(months, F.lit(12)),
        "days": days + short_month * F.dayofmonth(F.last_day(lo)),
    }
    if timed:
        parts["micros"] = clock + short_day * F.lit(MICROS_PER_DAY)
    made = F.struct(*[(sign * v).cast("bigint").alias(k) for k, v in parts.items()])
    return F.when(a.isNotNull() & b.isNotNull(), made)
