"""Registered time-series queries on the driver tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.ordering import order_small
from cadence.operators import growth as gr
from cadence.operators import rolling as ro
from cadence.operators import series as se
from cadence.plans import analogs as A
from cadence.plans import views
from cadence.sources import tables as src

a, b, one = A.LABEL_A, A.LABEL_B, A.LABEL_SINGLE
AM, BM, ONE_M = f"{a}_monthly_sales", f"{b}_monthly_sales", f"{one}_monthly_sales"
PAIR = {a: A.CAT_A, b: A.CAT_B}


def _series(spark: SparkSession, d: str, first: str | None = None, last: str | None = None) -> DataFrame:
    return src.long_series(spark, d, first, last)


def _pair(spark: SparkSession, d: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Two-category monthly pivot (the shared source of the pair analyses)."""
    return se.pivot_categories(_series(spark, d, first, last), PAIR, "month")


def _single(spark: SparkSession, d: str) -> DataFrame:
    """Single-category monthly values over every month of the series."""
    return se.pivot_categories(_series(spark, d), {one: A.CAT_SINGLE}, "month", restrict=False)


def _single_last_year(spark: SparkSession, d: str) -> DataFrame:
    return gr.same_period_last_year(_single(spark, d), ONE_M)


def trend(spark, d):
    return se.trend(_series(spark, d), A.CAT_TREND)


def yearly_total(spark, d):
    return se.rollup(_series(spark, d), "year", [A.CAT_TREND], ordered=True)


def yearly_by_category(spark, d):
    return se.rollup(_series(spark, d), "year", list(A.CATS_THREE), by_category=True)


def yearly_two_categories(spark, d):
    return se.rollup(_series(spark, d), "year", [A.CAT_A, A.CAT_B], by_category=True, ordered=True)


def compare_categories(spark, d):
    return se.compare(_series(spark, d), [A.CAT_A, A.CAT_B])


def pivot_monthly(spark, d):
    return order_small(_pair(spark, d), "sales_month")


def pivot_yearly(spark, d):
    return se.pivot_categories(_series(spark, d), PAIR, "year")


def yearly_gap(spark, d):
    return se.gap(pivot_yearly(spark, d), f"{a}_sales", f"{b}_sales", f"{b}_{a}_sales_diff")


def panel(spark, d):
    return se.panel(_pair(spark, d), a, b)


def index_base(spark, d):
    return se.index_base(_pair(spark, d), a, b)


def index_to_base(spark, d):
    return se.index_to_base(_pair(spark, d), a, b)


def moving_average(spark, d):
    return ro.moving_average(_pair(spark, d), {a: AM, b: BM})


def _sparse(spark, d, *cols, first=A.MONTH_LEAD_FROM):
    """Values that can reach the spine's months: those of the trailing year
    before its first month count too, unless ``first`` says otherwise."""
    return ro.sparse_months(_pair(spark, d, first, A.MONTH_SPINE_TO), A.SPARSE_MONTHS, list(cols))


def sparse_trailing_rows(spark, d):
    return ro.trailing_rows(_sparse(spark, d, BM), A.MONTH_SPINE_FROM, A.MONTH_SPINE_TO, BM)


def rolling_sparse_range(spark, d):
    return ro.rolling_sparse(
        spark,
        _sparse(spark, d, BM),
        A.MONTH_SPINE_FROM,
        A.MONTH_SPINE_TO,
        BM,
        avg_col=f"{b}_sales_moving_avg",
        count_col="records",
    )


def rolling_sparse_window(spark, d):
    return ro.rolling_dense(
        spark, _sparse(spark, d, BM, AM, first=A.MONTH_SPINE_FROM), A.MONTH_SPINE_FROM, A.MONTH_SPINE_TO, {b: BM, a: AM}
    )


def ytd_sum(spark, d):
    return ro.ytd(_pair(spark, d), {a: AM, b: BM}, "sum")


def ytd_avg(spark, d):
    return ro.ytd(_pair(spark, d), {a: AM, b: BM}, "avg")


def ytd_max(spark, d):
    return ro.ytd(_pair(spark, d), {a: AM, b: BM}, "max")


def pivot_single(spark, d):
    return order_small(_single(spark, d), "sales_month")


def prev_month(spark, d):
    return gr.lag_period(_single(spark, d), ONE_M)


def mom_growth(spark, d):
    return gr.growth(_single(spark, d), ONE_M)


def yoy_growth(spark, d):
    yearly = gr.yearly_single(_series(spark, d), A.CAT_SINGLE, one)
    return gr.growth(
        yearly,
        f"{one}_yearly_sales",
        period="sales_year",
        prev_period_col="prev_year",
        prev_value_col="prev_year_sales",
        growth_col="pct_growth_from_prev_year",
        digits=2,
    )


def same_month_last_year(spark, d):
    return _single_last_year(spark, d)


def growth_extremes(spark, d):
    return gr.extremes(_single_last_year(spark, d), "pct_diff")


def overlay_years(spark, d):
    return gr.overlay_years(
        _single_last_year(spark, d), ONE_M, A.OVERLAY_YEARS, A.OVERLAY_FROM, A.OVERLAY_TO
    )


def lag3_same_month(spark, d):
    return gr.lag_same_month(_single_last_year(spark, d), ONE_M, 3, "last_3yrs_sales")


def pct_of_prior3(spark, d):
    return gr.pct_of_prior_mean(_single_last_year(spark, d), ONE_M, 3, "pctage_of_prev_3")


SEGMENT = ("kind_of_business",)


def moving_average_by_segment(spark, d):
    return ro.moving_average(_series(spark, d), {"sale": "sales"}, keys=SEGMENT)


def moving_average_months_by_segment(spark, d):
    """Calendar frames over series with gaps: only some months are kept."""
    sparse = _series(spark, d).where(F.month("sales_month").isin(list(A.SPARSE_MONTHS)))
    return ro.moving_average(sparse, {"sale": "sales"}, frame="months", keys=SEGMENT)


def ytd_by_segment(spark, d):
    return ro.ytd(_series(spark, d), {"segment": "sales"}, "sum", keys=SEGMENT)


def growth_by_segment(spark, d):
    return gr.growth(_series(spark, d), "sales", digits=2, keys=SEGMENT)


def same_month_by_segment(spark, d):
    return gr.same_period_last_year(_series(spark, d), "sales", keys=SEGMENT)


def _view(spark, d):
    views.register(_single_last_year(spark, d), "single_last_year")
    return views.read(spark, "single_last_year")


def extremes_of_view(spark, d):
    return gr.extremes(_view(spark, d), "pct_diff")


def overlay_of_view(spark, d):
    return gr.overlay_years(_view(spark, d), ONE_M, A.OVERLAY_YEARS, A.OVERLAY_FROM, A.OVERLAY_TO)


def rolling_sparse_lead_in(spark, d):
    """The dense form with its look-back before the spine: equals the range form."""
    return ro.rolling_dense(
        spark, _sparse(spark, d, BM, AM), A.MONTH_SPINE_FROM, A.MONTH_SPINE_TO, {b: BM, a: AM}, lead_in=True
    )


QUERIES = {
    "moving_average_by_segment": moving_average_by_segment,
    "moving_average_months_by_segment": moving_average_months_by_segment,
    "ytd_by_segment": ytd_by_segment,
    "growth_by_segment": growth_by_segment,
    "same_month_by_segment": same_month_by_segment,
    "extremes_of_view": extremes_of_view,
    "overlay_of_view": overlay_of_view,
    "rolling_sparse_lead_in": rolling_sparse_lead_in,
    "trend": trend,
    "yearly_total": yearly_total,
    "yearly_by_category": yearly_by_category,
    "yearly_two_categories": yearly_two_categories,
    "compare_categories": compare_categories,
    "pivot_monthly": pivot_monthly,
    "pivot_yearly": pivot_yearly,
    "yearly_gap": yearly_gap,
    "panel": panel,
    "index_base": index_base,
    "index_to_base": index_to_base,
    "moving_average": moving_average,
    "sparse_trailing_rows": sparse_trailing_rows,
    "rolling_sparse_range": rolling_sparse_range,
    "rolling_sparse_window": rolling_sparse_window,
    "ytd_sum": ytd_sum,
    "ytd_avg": ytd_avg,
    "ytd_max": ytd_max,
    "pivot_single": pivot_single,
    "prev_month": prev_month,
    "mom_growth": mom_growth,
    "yoy_growth": yoy_growth,
    "same_month_last_year": same_month_last_year,
    "growth_extremes": growth_extremes,
    "overlay_years": overlay_years,
    "lag3_same_month": lag3_same_month,
    "pct_of_prior3": pct_of_prior3,
}
