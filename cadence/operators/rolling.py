"""Rolling and cumulative windows over monthly series.

Trailing windows over a sparse series are computed without a range join:
each observed month is exploded to the ``months`` following months it
contributes to and equi-joined with the calendar spine (a row-local map
plus a hash join), instead of a nested-loop join on
``month BETWEEN spine - 11 months AND spine``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.functions import calendar as cal
from cadence.functions import numeric as num
from cadence.functions.ordering import order_small

MONTH = "sales_month"


def month_spine(spark: SparkSession, first: str, last: str, col: str = "date") -> DataFrame:
    """Calendar spine: one row per first-of-month date in [first, last].
    Its size is set by the bounds (months), not by any data."""
    return spark.range(1).select(F.explode(cal.month_starts(first, last)).alias(col))


def _avg_double(c: Column, w: Window) -> Column:
    """Unrounded window mean as double: exact sum over count."""
    return F.try_divide(F.sum(c).over(w).cast("double"), F.count(c).over(w))


# ---------------------------------------------------------------- X11
def month_index(month: str | Column) -> Column:
    """Months since year 0 (a dense integer per calendar month)."""
    c = F.col(month) if isinstance(month, str) else month
    return F.year(c) * 12 + F.month(c)


def moving_average(
    wide: DataFrame,
    columns: Mapping[str, str],
    rows: int = 12,
    month: str = MONTH,
    avg_fmt: str = "{label}s_{rows}_month_moving_average",
    count_fmt: str = "{label}s_record_count",
    frame: str = "rows",
    keys: Sequence[str] = (),
) -> DataFrame:
    """X11: trailing ``rows``-row mean (rounded to 2) and the count of
    non-NULL values in the frame, per ``label -> column``.

    ``frame="rows"`` counts rows, as the analyses do: right only on a
    gap-free monthly series. ``frame="months"`` ranges over a month index
    instead, so the window is the current and ``rows - 1`` previous
    calendar months whatever is missing -- a join-free alternative to
    densifying the series first. ``keys`` name several series in ``wide``;
    each has its own windows, and they lead the result."""
    if frame == "rows":
        w = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(month)).rowsBetween(-(rows - 1), Window.currentRow)
    elif frame == "months":
        w = Window.partitionBy(*keys).orderBy(month_index(month).asc_nulls_last()).rangeBetween(-(rows - 1), Window.currentRow)
    else:
        raise ValueError("frame must be 'rows' or 'months'")
    out: list[Column] = [*map(F.col, keys), F.col(month)]
    for label, c in columns.items():
        out.append(num.round_div(F.sum(c).over(w), F.count(c).over(w), 2).alias(avg_fmt.format(label=label, rows=rows)))
        out.append(F.count(c).over(w).alias(count_fmt.format(label=label, rows=rows)))
    return wide.select(*out)


# ---------------------------------------------------------------- X12, X13
def sparse_months(wide: DataFrame, months: Sequence[int], columns: Sequence[str], month: str = MONTH) -> DataFrame:
    """Keep only the given calendar months (e.g. January and July)."""
    return wide.where(F.month(month).isin(list(months))).select(month, *columns)


def trailing_rows(
    sparse: DataFrame,
    first: str,
    last: str,
    value: str,
    months: int = 11,
    month: str = MONTH,
    date_col: str = "date",
) -> DataFrame:
    """For each spine month d in [first, last], every observed date m
    with d - ``months`` months <= m <= d: rows (d, m, value). Spine months are
    first-of-month dates, so m contributes to those from its own month start
    (the next one unless m is it) up to ``months`` months after that start."""
    own = F.trunc(month, "month")
    start = F.when(own == F.col(month), own).otherwise(F.add_months(own, 1))
    ends = F.sequence(start, F.add_months(own, months), F.expr("interval 1 month"))
    exploded = sparse.where(F.add_months(own, months) >= start).select(
        F.explode(ends).alias(date_col), month, value
    )
    return exploded.where(F.col(date_col).between(cal.lit_date(first), cal.lit_date(last)))


def rolling_sparse(
    spark: SparkSession,
    sparse: DataFrame,
    first: str,
    last: str,
    value: str,
    months: int = 11,
    month: str = MONTH,
    date_col: str = "date",
    avg_col: str = "moving_avg",
    count_col: str = "records",
) -> DataFrame:
    """One row per spine month with the mean and count of observed
    values in the trailing ``months`` + 1 months; months with no
    observation keep a row (mean NULL, count 0)."""
    # Aggregated first: one row per spine month at most, however many rows ``sparse`` has.
    per_date = (
        trailing_rows(sparse, first, last, value, months, month, date_col)
        .groupBy(date_col)
        .agg(F.sum(value).cast("double").alias("_sum"), F.count(value).alias("_count"))
    )
    return (
        month_spine(spark, first, last, date_col)
        .join(per_date, date_col, "left")
        .select(
            date_col,
            F.try_divide("_sum", F.col("_count")).alias(avg_col),
            F.coalesce("_count", F.lit(0)).alias(count_col),
        )
    )


# ---------------------------------------------------------------- X14
def rolling_dense(
    spark: SparkSession,
    sparse: DataFrame,
    first: str,
    last: str,
    columns: Mapping[str, str],
    rows: int = 12,
    month: str = MONTH,
    date_col: str = "full_date",
    lead_in: bool = False,
    avg_fmt: str = "{label}_sales_moving_avg",
    count_fmt: str = "{label}_records_in_window",
) -> DataFrame:
    """Densify the sparse series onto the monthly spine (left join on
    the month), then take ``rows``-row trailing windows. The spine is cut
    to [first, last] before the window, so the first months see a shorter
    look-back; ``lead_in=True`` starts the spine ``rows - 1`` months early
    and trims afterwards, giving the full look-back."""
    start = first
    if lead_in:
        start = cal.shift_months(first, -(rows - 1))
    spine = month_spine(spark, start, last, date_col)
    observed = sparse.select(F.col(month).alias(date_col), *columns.values()).where(
        F.col(date_col).between(cal.lit_date(start), cal.lit_date(last))
    )
    dense = spine.join(observed, date_col, "left")
    w = Window.orderBy(F.asc_nulls_last(date_col)).rowsBetween(-(rows - 1), Window.currentRow)
    out: list[Column] = [F.col(date_col)]
    for label, c in columns.items():
        out.append(_avg_double(F.col(c), w).alias(avg_fmt.format(label=label)))
        out.append(F.count(c).over(w).alias(count_fmt.format(label=label)))
    res = dense.select(*out)
    if lead_in:
        res = res.where(F.col(date_col) >= cal.lit_date(first))
    return order_small(res, date_col)


# ---------------------------------------------------------------- X15-X17
def ytd(
    wide: DataFrame,
    columns: Mapping[str, str],
    how: str = "sum",
    month: str = MONTH,
    name_fmt: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Running sum / mean (rounded 2) / max within each calendar
    year, ordered by month."""
    w = Window.partitionBy(*keys, cal.year_of(month)).orderBy(F.asc_nulls_last(month))
    fmts = {
        "sum": "total_{label}_sales_ytd",
        "avg": "avg_{label}_sales_ytd",
        "max": "max_{label}_sales_ytd",
    }
    if how not in fmts:
        raise ValueError("how must be sum, avg or max")
    fmt = name_fmt or fmts[how]
    out: list[Column] = [*map(F.col, keys), F.col(month)] + [F.col(c) for c in columns.values()]
    for label, c in columns.items():
        if how == "sum":
            e = F.sum(c).over(w).cast(num.MONEY)
        elif how == "avg":
            e = num.round_div(F.sum(c).over(w), F.count(c).over(w), 2)
        else:
            e = F.max(c).over(w)
        out.append(e.alias(fmt.format(label=label)))
    return wide.select(*out)
