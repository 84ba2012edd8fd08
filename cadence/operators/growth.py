"""Period-over-period operators: lags, growth, same period last year,
side-by-side overlays and comparisons with several prior periods.

All of them run on an aggregated series: one row per period, or one per
period and ``keys`` where several series lie side by side (their windows are
partitioned by the keys, which lead the result). Without keys the
unpartitioned ``lag`` windows see a calendar-bounded number of rows and
the same-month windows are partitioned by calendar month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import calendar as cal
from cadence.functions import numeric as num

MONTH = "sales_month"


def _in_order(period: str, keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(F.asc_nulls_last(period))


def _same_month(month: str, keys: Sequence[str] = ()) -> Window:
    return Window.partitionBy(*keys, F.month(month)).orderBy(F.asc_nulls_last(month))


# ---------------------------------------------------------------- X19
def lag_period(
    wide: DataFrame,
    value: str,
    period: str = MONTH,
    prev_period_col: str = "previous_month",
    prev_value_col: str = "prev_month_sales",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Previous row's period and value (ordered by period)."""
    w = _in_order(period, keys)
    return wide.select(
        *keys, period, value, F.lag(period).over(w).alias(prev_period_col), F.lag(value).over(w).alias(prev_value_col)
    )


# ---------------------------------------------------------------- X20, X21
def growth(
    wide: DataFrame,
    value: str,
    period: str = MONTH,
    prev_period_col: str = "previous_month",
    prev_value_col: str = "prev_month_sales",
    growth_col: str = "pct_growth_from_previous",
    digits: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Previous period, previous value and percent growth
    ``(value / previous - 1) * 100`` (rounded to ``digits`` or unrounded
    double). The previous period is the previous *present* row."""
    w = _in_order(period, keys)
    prev = F.lag(value).over(w)
    if digits is None:
        pct = (num.double_ratio(value, prev) - 1) * 100
    else:
        pct = num.round_pct_change(value, prev, digits)
    return wide.select(
        *keys,
        period,
        value,
        F.lag(period).over(w).alias(prev_period_col),
        prev.alias(prev_value_col),
        pct.alias(growth_col),
    )


# ---------------------------------------------------------------- X22
def same_period_last_year(
    wide: DataFrame,
    value: str,
    month: str = MONTH,
    prev_month_col: str = "prev_year_month",
    prev_value_col: str = "prev_years_month_sales",
    keys: Sequence[str] = (),
) -> DataFrame:
    """The same calendar month's previous row (last year), the
    absolute difference and the percent change rounded to 2."""
    w = _same_month(month, keys)
    prev = F.lag(value).over(w)
    return wide.select(
        *keys,
        month,
        value,
        F.lag(month).over(w).alias(prev_month_col),
        prev.alias(prev_value_col),
        (F.col(value) - prev).cast(num.MONEY).alias("absolute_diff"),
        num.round_pct_change(value, prev, 2).alias("pct_diff"),
    )


# ---------------------------------------------------------------- X23
def extremes(df: DataFrame, column: str) -> DataFrame:
    """One row with the max and min of ``column``."""
    return df.agg(F.max(column).alias(f"max_{column}"), F.min(column).alias(f"min_{column}"))


# ---------------------------------------------------------------- X24
def overlay_years(
    wide: DataFrame,
    value: str,
    years: Sequence[int],
    first: str,
    last: str,
    month: str = MONTH,
    prefix: str = "sales_",
) -> DataFrame:
    """One row per calendar month (number and padded name), one column
    per year holding that month's value. The date filter applies to the
    input rows as given (after any window that produced them)."""
    rows = wide.where(F.col(month).between(cal.lit_date(first), cal.lit_date(last)))
    cells = [
        F.max(F.when(F.year(month) == y, F.col(value))).alias(f"{prefix}{y}") for y in years
    ]
    return rows.groupBy(
        cal.month_of(month).alias("month_number"), cal.padded_month_name(month).alias("month_name")
    ).agg(*cells)


# ---------------------------------------------------------------- X25
def lag_same_month(
    wide: DataFrame, value: str, n: int, out_col: str, month: str = MONTH, keys: Sequence[str] = ()
) -> DataFrame:
    """The value ``n`` rows earlier within the same calendar month."""
    return wide.select(*keys, month, value, F.lag(value, n).over(_same_month(month, keys)).alias(out_col))


# ---------------------------------------------------------------- X26
def pct_of_prior_mean(
    wide: DataFrame, value: str, n: int, out_col: str, month: str = MONTH, keys: Sequence[str] = ()
) -> DataFrame:
    """Value * 100 / mean of the ``n`` previous same-month values
    (current excluded; fewer at the start, NULL when there are none)."""
    w = _same_month(month, keys).rowsBetween(-n, -1)
    v = F.col(value).cast("double")
    pct = F.try_divide(v * 100 * F.count(value).over(w), F.sum(value).over(w).cast("double"))
    return wide.select(*keys, month, value, pct.alias(out_col))


def yearly_single(series: DataFrame, category: str, label: str, month: str = MONTH,
                  cat: str = "kind_of_business", value: str = "sales") -> DataFrame:
    """Yearly conditional sum of one category over all years of the series."""
    return series.groupBy(cal.year_of(month).alias("sales_year")).agg(
        F.sum(F.when(F.col(cat) == category, F.col(value))).cast(num.MONEY).alias(f"{label}_yearly_sales")
    )

