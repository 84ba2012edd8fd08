"""Series operators over a long table (period, category, value).

A long series holds one row per (month, category). Operators filter
categories with ``isin`` (pushed below the aggregate and into the scan
when the series comes straight from a table), aggregate with partial
(map-side) aggregation, and only then apply windows. The aggregated
series has one row per calendar period, so the few windows without a
partition key (base-period values, moving averages over the whole
timeline) run over a calendar-bounded number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import calendar as cal
from cadence.functions import numeric as num
from cadence.functions.ordering import order_small

MONTH, CAT, VALUE = "sales_month", "kind_of_business", "sales"


def _period_key(period: str, month: str) -> tuple[Column, str]:
    if period == "month":
        return F.col(month), month
    if period == "year":
        return cal.year_of(month).alias("sales_year"), "sales_year"
    raise ValueError("period must be 'month' or 'year'")


# ---------------------------------------------------------------- X1, X4
def trend(series: DataFrame, category: str, month: str = MONTH, cat: str = CAT, value: str = VALUE) -> DataFrame:
    """(month, value) of one category."""
    return series.where(F.col(cat) == category).select(month, value)


def compare(
    series: DataFrame, categories: Sequence[str], month: str = MONTH, cat: str = CAT, value: str = VALUE
) -> DataFrame:
    """Long rows of several categories."""
    return series.where(F.col(cat).isin(list(categories))).select(month, cat, value)


# ---------------------------------------------------------------- X2, X3
def rollup(
    series: DataFrame,
    period: str = "year",
    categories: Sequence[str] | None = None,
    by_category: bool = False,
    month: str = MONTH,
    cat: str = CAT,
    value: str = VALUE,
    value_col: str = "sales",
    ordered: bool = False,
) -> DataFrame:
    """Total per period (and per category), exact money."""
    src = series if categories is None else series.where(F.col(cat).isin(list(categories)))
    key, key_name = _period_key(period, month)
    keys = [key] + ([F.col(cat)] if by_category else [])
    out = src.groupBy(*keys).agg(F.sum(value).cast(num.MONEY).alias(value_col))
    if ordered and by_category and categories is None:
        return out.orderBy(F.asc_nulls_last(key_name), F.asc_nulls_last(cat))  # as many rows as categories: distributed
    return order_small(out, key_name) if ordered else out


# ---------------------------------------------------------------- X5, X6, X18
def pivot_categories(
    series: DataFrame,
    labels: Mapping[str, str],
    period: str = "month",
    suffix: str | None = None,
    restrict: bool = True,
    month: str = MONTH,
    cat: str = CAT,
    value: str = VALUE,
) -> DataFrame:
    """One row per period, one column per category
    (``label -> category``) holding the category's total.

    Each cell is a conditional sum, ``sum(case when category = c then
    value end)``: one aggregate, combined map-side (Spark's ``pivot`` would
    add a second aggregation layer for the same result). With ``restrict``
    the rows are first filtered to the listed categories (the filter
    reaches the scan); without it every period of the series is kept and a
    period lacking a category gets NULL.
    """
    suffix = suffix if suffix is not None else ("_monthly_sales" if period == "month" else "_sales")
    key, _ = _period_key(period, month)
    src = series.where(F.col(cat).isin(list(labels.values()))) if restrict else series
    cells = [
        F.sum(F.when(F.col(cat) == c, F.col(value))).cast(num.MONEY).alias(f"{lab}{suffix}")
        for lab, c in labels.items()
    ]
    return src.groupBy(key).agg(*cells)


# ---------------------------------------------------------------- X7
def gap(wide: DataFrame, a: str, b: str, diff_col: str) -> DataFrame:
    """Add ``b - a`` (exact)."""
    return wide.withColumn(diff_col, (F.col(b) - F.col(a)).cast(num.MONEY))


# ---------------------------------------------------------------- X8
def panel(pair: DataFrame, a: str, b: str, month: str = MONTH, window_rows: int = 12) -> DataFrame:
    """The two-category monthly panel.

    ``pair`` is the output of ``pivot_categories(..., period='month')`` with
    labels ``a`` and ``b``. Adds difference, ratio, percent difference,
    shares of the pair total and of the own-year total, year-to-date
    totals and trailing ``window_rows``-row moving averages.
    """
    am, bm = F.col(f"{a}_monthly_sales"), F.col(f"{b}_monthly_sales")
    year = cal.year_of(month)
    by_year = Window.partitionBy(year)
    ytd = Window.partitionBy(year).orderBy(F.asc_nulls_last(month))
    trailing = Window.orderBy(F.asc_nulls_last(month)).rowsBetween(-(window_rows - 1), Window.currentRow)
    a_year, b_year = F.sum(am).over(by_year), F.sum(bm).over(by_year)
    return pair.select(
        month,
        am.alias(f"{a}_monthly_sales"),
        bm.alias(f"{b}_monthly_sales"),
        (bm - am).cast(num.MONEY).alias(f"{b}_{a}_sales_diff"),
        num.round_div(bm, am, 2).alias(f"{b}_to_{a}_sales_ratio"),
        num.round_pct_change(bm, am, 2).alias(f"{b}_to_{a}_pctage_diff"),
        num.round_share(am, am + bm, 2).alias(f"{a}_pctage_of_total"),
        num.round_share(bm, am + bm, 2).alias(f"{b}_pctage_of_total"),
        num.round_share(am, a_year, 2).alias(f"{a}_pctage_of_yearly_sales"),
        num.round_share(bm, b_year, 2).alias(f"{b}_pctage_of_yearly_sales"),
        F.sum(am).over(ytd).cast(num.MONEY).alias(f"total_{a}_sales_ytd"),
        F.sum(bm).over(ytd).cast(num.MONEY).alias(f"total_{b}_sales_ytd"),
        num.round_div(F.sum(am).over(trailing), F.count(am).over(trailing), 2).alias(f"{a}s_{window_rows}_month_moving_average"),
        num.round_div(F.sum(bm).over(trailing), F.count(bm).over(trailing), 2).alias(f"{b}s_{window_rows}_month_moving_average"),
    )


# ---------------------------------------------------------------- X9, X10
def yearly_totals(pair: DataFrame, a: str, b: str, month: str = MONTH) -> DataFrame:
    """Per-year sums of the two monthly columns."""
    return pair.groupBy(cal.year_of(month).alias("sales_year")).agg(
        F.sum(f"{a}_monthly_sales").cast(num.MONEY).alias(f"{a}_yearly_sales"),
        F.sum(f"{b}_monthly_sales").cast(num.MONEY).alias(f"{b}_yearly_sales"),
    )


def index_base(pair: DataFrame, a: str, b: str, month: str = MONTH) -> DataFrame:
    """Each year with the earliest year's totals (the index base)."""
    base = Window.orderBy(F.asc_nulls_last("sales_year"))
    return yearly_totals(pair, a, b, month).select(
        "sales_year",
        F.first(f"{a}_yearly_sales").over(base).alias(f"{a}_index_sales"),
        F.first(f"{b}_yearly_sales").over(base).alias(f"{b}_index_sales"),
    )


def index_to_base(pair: DataFrame, a: str, b: str, month: str = MONTH) -> DataFrame:
    """Yearly totals indexed to the earliest year, plus the yearly
    b-to-a ratio and percent difference."""
    base = Window.orderBy(F.asc_nulls_last("sales_year"))
    ay, by = F.col(f"{a}_yearly_sales"), F.col(f"{b}_yearly_sales")
    a0, b0 = F.first(ay).over(base), F.first(by).over(base)
    return yearly_totals(pair, a, b, month).select(
        "sales_year",
        ay,
        by,
        a0.alias(f"{a}_index_sales"),
        b0.alias(f"{b}_index_sales"),
        num.round_pct_change(ay, a0, 2).alias(f"pct_from_{a}_index"),
        num.round_pct_change(by, b0, 2).alias(f"pct_from_{b}_index"),
        num.round_div(by, ay, 2).alias(f"yearly_{b}_to_{a}_sales_ratio"),
        num.round_pct_change(by, ay, 2).alias(f"{b}_to_{a}_yearly_pctage_diff"),
    )
