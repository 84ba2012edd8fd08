"""Registered cohort queries on the driver tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadence.functions import calendar as cal
from cadence.operators import cohort as co
from cadence.plans import analogs as A
from cadence.sources import tables as src

E, S, END = "id_bioguide", "term_start", "term_end"


def _terms(spark: SparkSession, d: str) -> DataFrame:
    return src.interval_history(spark, d)


def _interval(spark: SparkSession, d: str, **kw) -> DataFrame:
    return co.interval_retention_counts(_terms(spark, d), E, S, END, **kw)


def first_event(spark: SparkSession, d: str) -> DataFrame:
    return co.first_event(_terms(spark, d), E, S)


def retention_counts(spark: SparkSession, d: str) -> DataFrame:
    return co.retention_counts(_terms(spark, d), E, S)


def retention_curve(spark: SparkSession, d: str) -> DataFrame:
    return co.retention_curve(retention_counts(spark, d), digits=2)


def retention_generic(spark: SparkSession, d: str) -> DataFrame:
    ev = src.order_events(spark, d)
    return co.retention_counts(ev, "entity_id", "event_date", "year", count_col="retained", ordered=True)


def retention_events_week(spark: SparkSession, d: str) -> DataFrame:
    ev = src.user_events(spark, d)
    return co.retention_counts(ev, "entity_id", "event_date", "week", count_col="retained", ordered=True)


def retention_generic_month(spark: SparkSession, d: str) -> DataFrame:
    ev = src.order_events(spark, d)
    return co.retention_counts(ev, "entity_id", "event_date", "month", count_col="retained", ordered=True)


def retention_events_month(spark: SparkSession, d: str) -> DataFrame:
    """Months completed to the time of day, on raw timestamps."""
    ev = src.read_table(spark, d, "events").select("user_id", "ts")
    return co.retention_counts(ev, "user_id", "ts", "month", count_col="retained", ordered=True)


def retention_events_day(spark: SparkSession, d: str) -> DataFrame:
    ev = src.user_events(spark, d)
    return co.retention_counts(ev, "entity_id", "event_date", "day", count_col="retained", ordered=True)


def retention_pivot(spark: SparkSession, d: str) -> DataFrame:
    return co.retention_pivot(retention_curve(spark, d), A.PIVOT_PERIODS)


def interval_spine(spark: SparkSession, d: str) -> DataFrame:
    return co.expand_to_spine(_terms(spark, d), E, S, END)


def interval_retention_counts(spark: SparkSession, d: str) -> DataFrame:
    return _interval(spark, d)


def interval_retention_curve(spark: SparkSession, d: str) -> DataFrame:
    return co.retention_curve(_interval(spark, d), digits=4)


def retention_counts_by_year(spark: SparkSession, d: str) -> DataFrame:
    return _interval(
        spark, d, by=["first_year"], derived={"first_year": cal.year_of("first_term")}
    )


def retention_by_year(spark: SparkSession, d: str) -> DataFrame:
    return co.retention_curve(retention_counts_by_year(spark, d), by=["first_year"], digits=None)


def retention_by_century(spark: SparkSession, d: str) -> DataFrame:
    counts = _interval(
        spark, d, by=["first_century"], derived={"first_century": cal.century("first_term")}
    )
    return co.retention_curve(counts, by=["first_century"], digits=4)


def first_attribute(spark: SparkSession, d: str) -> DataFrame:
    return co.first_attribute(_terms(spark, d), E, S, "state", "term_id")


def retention_by_first_attribute(spark: SparkSession, d: str) -> DataFrame:
    counts = _interval(spark, d, by=["first_state"], attribute="state", tiebreak="term_id")
    return co.retention_curve(
        counts,
        by=["first_state"],
        size_col="cohort_size_by_state",
        pct_col="pct_retained_by_state",
        digits=None,
    )


def _by_gender(spark: SparkSession, d: str, **kw) -> DataFrame:
    counts = _interval(
        spark,
        d,
        by=["gender"],
        dimension=src.entity_dimension(spark, d),
        dimension_cols=["gender"],
        **kw,
    )
    return co.retention_curve(
        counts,
        by=["gender"],
        size_col="cohort_size_by_gender",
        pct_col="pct_retained_by_gender",
        digits=None,
    )


def retention_by_dimension(spark: SparkSession, d: str) -> DataFrame:
    return _by_gender(spark, d)


def retention_by_dimension_range(spark: SparkSession, d: str) -> DataFrame:
    return _by_gender(spark, d, cohort_from=A.COHORT_FROM, cohort_to=A.COHORT_TO)


def retention_sparse_multi(spark: SparkSession, d: str) -> DataFrame:
    counts = _interval(
        spark,
        d,
        by=["first_state", "gender"],
        attribute="state",
        tiebreak="term_id",
        dimension=src.entity_dimension(spark, d),
        dimension_cols=["gender"],
        cohort_from=A.COHORT_FROM,
        cohort_to=A.COHORT_TO,
    )
    return co.retention_curve(counts, by=["first_state", "gender"], digits=None)


QUERIES = {
    "first_event": first_event,
    "retention_counts": retention_counts,
    "retention_curve": retention_curve,
    "retention_generic": retention_generic,
    "retention_events_week": retention_events_week,
    "retention_generic_month": retention_generic_month,
    "retention_events_month": retention_events_month,
    "retention_events_day": retention_events_day,
    "retention_pivot": retention_pivot,
    "interval_spine": interval_spine,
    "interval_retention_counts": interval_retention_counts,
    "interval_retention_curve": interval_retention_curve,
    "retention_counts_by_year": retention_counts_by_year,
    "retention_by_year": retention_by_year,
    "retention_by_century": retention_by_century,
    "first_attribute": first_attribute,
    "retention_by_first_attribute": retention_by_first_attribute,
    "retention_by_dimension": retention_by_dimension,
    "retention_by_dimension_range": retention_by_dimension_range,
    "retention_sparse_multi": retention_sparse_multi,
}
