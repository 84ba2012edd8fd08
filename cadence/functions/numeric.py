"""Exact numeric helpers, without a ceiling on totals.

Amounts are whole cents per row and ``decimal(38,2)`` as totals. Ratios are
rounded on whole numbers: the quotient and remainder of scaled operands, half
away from zero, like PostgreSQL's ``round(numeric, n)``. No decimal division
is rounded on the way, so nothing is rounded twice, and operands may have up to
30 digits (Spark's own decimal division keeps as few as 6 fractional digits
once operands are wide).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"
WHOLE = "decimal(38,0)"
# Cents are summed as two numbers, above and below a million.
LIMB = 1_000_000


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cents(x: str | Column) -> Column:
    """Amount in whole cents as bigint, equal to the unscaled value of
    ``cast(x as decimal(18,2))``.

    ``round(x, 2)`` on a double rounds the shortest decimal form of ``x``
    half up, as the decimal cast does; multiplying that 2-digit value by
    100 lands within an ulp of an integer, which the outer ``round``
    recovers exactly (|x| < 9e13). ``sum_cents`` adds them up.
    """
    return F.round(F.round(_c(x), 2) * 100).cast("bigint")


def sum_cents(x: str | Column) -> Column:
    """Aggregate: the exact sum of whole cents as decimal(38,0).

    The millions and the rest are summed as bigints of their own, each in a
    fixed-width buffer, so a total may pass a bigint's range (9.2e16 in money)
    and still costs no decimal arithmetic per row."""
    low = F.pmod(_c(x), F.lit(LIMB))
    high = F.call_function("div", _c(x) - low, F.lit(LIMB))
    return F.sum(high).cast(WHOLE) * F.lit(LIMB) + F.sum(low).cast(WHOLE)


def from_cents(x: str | Column) -> Column:
    """Whole cents back to money (exact)."""
    return (_c(x).cast(WHOLE) / 100).cast(MONEY)


def _hundredths(x: str | Column) -> Column:
    """100 * x as a whole number, for amounts, integers and counts."""
    return (_c(x).cast("decimal(36,2)") * 100).cast(WHOLE)


def _rounded(num: Column, den: Column, digits: int) -> Column:
    """round(num / den, digits) of whole numbers, half away from zero, as
    double; NULL when the divisor is zero or NULL."""
    n, d = num * F.lit(10**digits), F.nullif(den, F.lit(0))
    doubled, twice = F.abs(n) * 2 + F.abs(d), F.abs(d) * 2
    # An exact multiple: the division leaves nothing to round.
    size = ((doubled - doubled % twice) / twice).cast(WHOLE)
    signed = F.when((n < 0) != (d < 0), -size).otherwise(size)
    return (signed / F.lit(10**digits)).cast("double")


def round_div(
    num: str | Column, den: str | Column, digits: int, integral: bool = False
) -> Column:
    """``round(num / den, digits)`` computed exactly, returned as double.
    ``integral`` says that both are whole numbers; amounts have two digits."""
    if integral:
        return _rounded(_c(num).cast(WHOLE), _c(den).cast(WHOLE), digits)
    return _rounded(_hundredths(num), _hundredths(den), digits)


def round_pct_change(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """``round((num / den - 1) * 100, digits)`` as double, exact."""
    n, d = _hundredths(num), _hundredths(den)
    return _rounded((n - d) * 100, d, digits)


def round_share(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """``round(part * 100 / whole, digits)`` as double, exact."""
    return _rounded(_hundredths(part) * 100, _hundredths(whole), digits)


def round_money(x: str | Column, digits: int = 2) -> Column:
    """Round an exact decimal (e.g. a decimal average) to ``digits``; double."""
    return F.round(_c(x), digits).cast("double")


def double_ratio(num: str | Column, den: str | Column) -> Column:
    """Unrounded ratio as double: both operands converted first, so the
    result is the IEEE quotient of the two exact values."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
