"""Calendar arithmetic as plain Catalyst expressions (codegen friendly).

* ``completed_units``  whole years / months / weeks / days from a to b, the
  ``date_part(unit, age(b, a))`` of PostgreSQL for years and months.
* ``century``          PostgreSQL's ``date_part('century', d)`` (AD dates).
* ``covered_years``    years whose Dec 31 lies inside [start, end] (optionally
  clipped to a spine): the per-row replacement for a range join to a day
  table (``year_ends_within`` gives the dates themselves).
* ``month_starts``     calendar-month spine between two bounds.
* ``padded_month_name`` ``to_char(d, 'Month')``: English name blank-padded
  to nine characters.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("year", "month", "week", "day")


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _md(d: Column) -> Column:
    return F.month(d) * 100 + F.dayofmonth(d)


def _time_of_day(d: Column) -> Column:
    """Microseconds since midnight of a timestamp."""
    return F.unix_micros(d.cast("timestamp")) - F.unix_micros(F.to_date(d).cast("timestamp"))


def _forward_units(unit: str, a: Column, b: Column, timed: bool) -> Column:
    """Completed units from a to b, assuming a <= b."""

    def short(x: Column, y: Column) -> Column:
        """1 where the last unit is not reached yet: by x and y, or on a tie by the time of day."""
        tie = (x == y) & (_time_of_day(b) < _time_of_day(a)) if timed else F.lit(False)
        return F.when((x < y) | tie, 1).otherwise(0)

    if unit == "year":
        return F.year(b) - F.year(a) - short(_md(b), _md(a))
    if unit == "month":
        months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
        return months - short(F.dayofmonth(b), F.dayofmonth(a))
    if unit == "week":
        return F.floor(F.datediff(b, a) / F.lit(7))
    if unit == "day":
        return F.datediff(b, a)
    raise ValueError(f"unit must be one of {UNITS}, got {unit!r}")


def completed_units(unit: str, start: str | Column, end: str | Column, timed: bool = False) -> Column:
    """Whole ``unit``s elapsed from ``start`` to ``end`` (bigint).

    Years and months follow calendar fields with borrowing, so 1996-02-29
    to 1997-02-28 is 0 years and to 2000-02-29 is 4 years. A negative span
    is the negated forward span (truncation toward zero). NULL in, NULL out.
    With ``timed`` (timestamps) a year or month is completed only when the
    time of day is reached too; weeks and days always count dates.
    """
    a, b = _c(start), _c(end)
    forward = F.when(a <= b, _forward_units(unit, a, b, timed)).otherwise(-_forward_units(unit, b, a, timed))
    return forward.cast("bigint")


def year_of(d: str | Column) -> Column:
    return F.year(_c(d)).cast("bigint")


def month_of(d: str | Column) -> Column:
    return F.month(_c(d)).cast("bigint")


def century(d: str | Column) -> Column:
    """Century of an AD date: 1900 -> 19, 1901 -> 20, 2000 -> 20, 2001 -> 21."""
    return F.floor((F.year(_c(d)) + 99) / 100).cast("bigint")


def lit_date(x: str | _dt.date) -> Column:
    return F.lit(_dt.date.fromisoformat(str(x)))


def _is_year_end(d: Column) -> Column:
    return (F.month(d) == 12) & (F.dayofmonth(d) == 31)


def covered_years(
    start: str | Column,
    end: str | Column,
    spine_from: str | _dt.date | None = None,
    spine_to: str | _dt.date | None = None,
) -> Column:
    """Array of the years y whose Dec 31 lies in [start, end] (and inside
    the optional spine bounds). Empty when none; NULL when start or end is
    NULL.

    Dec 31 of year(start) is never before start, and Dec 31 of year(end)
    is after end unless end is itself a Dec 31, so the covered years are
    the integer range year(lo) .. year(hi) - (hi is not Dec 31). Built with
    ``sequence`` alone (code-generated, no lambda functions): one element
    per covered year, a row-local replacement for a range join to a day
    table.
    """
    s, e = _c(start), _c(end)
    lo = F.greatest(s, lit_date(spine_from)) if spine_from is not None else s
    hi = F.least(e, lit_date(spine_to)) if spine_to is not None else e
    first = F.year(lo)
    last = F.year(hi) - F.when(_is_year_end(hi), 0).otherwise(1)
    empty = F.array().cast("array<int>")
    return F.when(s.isNotNull() & e.isNotNull(), F.when(first <= last, F.sequence(first, last)).otherwise(empty))


def year_end(year: str | Column) -> Column:
    """Dec 31 of ``year`` (NULL for a NULL year)."""
    return F.make_date(_c(year), F.lit(12), F.lit(31))


def year_ends_within(
    start: str | Column,
    end: str | Column,
    spine_from: str | _dt.date | None = None,
    spine_to: str | _dt.date | None = None,
) -> Column:
    """Array of the Dec-31 dates inside [start, end] (see ``covered_years``)."""
    years = covered_years(start, end, spine_from, spine_to)
    return F.transform(years, lambda y: year_end(y))


def shift_months(first_of_month: str | _dt.date, n: int) -> str:
    """Plain date arithmetic for a first-of-month bound (a parameter)."""
    d = _dt.date.fromisoformat(str(first_of_month))
    k = d.year * 12 + d.month - 1 + n
    return _dt.date(k // 12, k % 12 + 1, 1).isoformat()


def month_starts(first: str | _dt.date, last: str | _dt.date) -> Column:
    """Array of first-of-month dates from ``first`` to ``last`` inclusive
    (both given as first-of-month dates)."""
    return F.sequence(lit_date(first), lit_date(last), F.expr("interval 1 month"))


def months_after(d: str | Column, n: int) -> Column:
    """Array [d, d+1 month, ..., d+n months] for a first-of-month date d."""
    c = _c(d)
    return F.sequence(c, F.add_months(c, n), F.expr("interval 1 month"))


def padded_month_name(d: str | Column) -> Column:
    """English month name blank-padded to 9 characters ('May      ')."""
    return F.rpad(F.date_format(_c(d), "MMMM"), 9, " ")
