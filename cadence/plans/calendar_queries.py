"""Registered queries over calendars: intervals joined to any dates, trailing
ranges on daily spines, windows over long series, and results from kept
state, kept views and laid-out histories."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions import calendar as cal
from cadence.functions.age import age
from cadence.functions.numeric import cents
from cadence.operators import cohort as co
from cadence.operators import deltas as de
from cadence.operators import growth as gr
from cadence.operators import intervals as iv
from cadence.operators import long_windows as lw
from cadence.operators import maintained as mt
from cadence.operators import series as se
from cadence.plans import analogs as A
from cadence.plans import kept_views
from cadence.sources import layout
from cadence.sources import tables as src
from cadence.sources.date_dim import date_dim
from cadence.sources.staging import staged, staging_dir

E, S, END = "id_bioguide", "term_start", "term_end"


def _terms(spark: SparkSession, d: str) -> DataFrame:
    return src.interval_history(spark, d).select(E, S, END)


def _days(spark: SparkSession) -> DataFrame:
    return date_dim(spark, A.CALENDAR_FROM, A.CALENDAR_TO)


def retention_december_31(spark: SparkSession, d: str) -> DataFrame:
    """Year ends named as the analyses name them: by month name and day."""
    year_ends = _days(spark).where((F.col("month_name") == "December") & (F.col("day_of_month") == 31))
    return iv.retention_at(_terms(spark, d), year_ends, E, S, END, "year")


def retention_month_ends(spark: SparkSession, d: str) -> DataFrame:
    return iv.retention_at(_terms(spark, d), _days(spark).where("is_month_end"), E, S, END, "month")


def intervals_at_quarter_days(spark: SparkSession, d: str) -> DataFrame:
    """Every interval with each quarter's first weekday that it covers, whole rows."""
    weekdays = _days(spark).where("NOT is_weekend AND date <= date_add(first_day_of_quarter, 2)")
    quarters = weekdays.groupBy("first_day_of_quarter").agg(F.min("date").alias("quarter_day"))
    terms = src.interval_history(spark, d).select(E, "term_id", S, END)
    return iv.calendar_join(terms, quarters, S, END, "quarter_day")


def open_at_opening_days(spark: SparkSession, d: str) -> DataFrame:
    """A calendar that the data give: the first day of each month with an order."""
    orders = src.order_events(spark, d)
    opening = orders.groupBy(F.trunc("event_date", "month").alias("month")).agg(F.min("event_date").alias("day"))
    return iv.open_at(_terms(spark, d), opening, E, S, END, "day")


def purchases_after_signup(spark: SparkSession, d: str) -> DataFrame:
    """Per signup the user's purchases within three days, those without any included."""
    events = src.read_table(spark, d, "events")
    day = F.expr("interval 1 day")
    signups = events.where("event_type = 'signup'").select(
        "user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("opened"), (F.col("ts") + 3 * day).alias("closed")
    )
    purchases = events.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("bought"), cents("value").alias("amount")
    )
    met = iv.interval_join(signups, purchases, "opened", "closed", "bought", 3 * iv.MICROS_PER_DAY, keys=["user_id"])
    return met.groupBy("user_id", "signup_id").agg(
        F.count("bought").alias("purchases"),
        F.sum("amount").alias("total_cents"),
    )


def _order_amounts(spark: SparkSession, d: str) -> DataFrame:
    orders = src.read_table(spark, d, "orders")
    return orders.select("o_custkey", "o_orderdate", cents("o_totalprice").alias("amount"))


def trailing_year_by_day(spark: SparkSession, d: str) -> DataFrame:
    """Count and mean of the orders of the last 365 days, for every day."""
    return de.trailing_range(
        _order_amounts(spark, d), "o_orderdate", {"order": "amount"}, A.DAY_SPINE_FROM, A.DAY_SPINE_TO, days=365
    )


def trailing_months_by_day_and_segment(spark: SparkSession, d: str) -> DataFrame:
    """The analyses' range, eleven months back to the day, per segment and day."""
    customer = src.read_table(spark, d, "customer")
    segments = customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    values = _order_amounts(spark, d).join(segments, "o_custkey")
    return de.trailing_range(
        values, "o_orderdate", {"order": "amount"}, A.DAY_SPINE_FROM, A.DAY_SPINE_TO, months=11, keys=["c_mktsegment"]
    )


def _all_orders(spark: SparkSession, d: str, *columns: str, keys: tuple[str, ...] = ()) -> lw.Numbered:
    day = src.as_date("o_orderdate")
    orders = src.read_table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", day.alias("day"), F.year(day).cast("bigint").alias("year"), cents("o_totalprice").alias("amount")
    )
    return lw.numbered(orders.select("o_orderkey", "day", "amount", *columns), ["day", "o_orderkey"], keys)


def moving_average_of_orders(spark: SparkSession, d: str) -> DataFrame:
    """Mean of the last 500 orders, at every order."""
    moved = lw.moving(_all_orders(spark, d), {"order": "amount"}, 500)
    mean = F.try_divide(F.col("order_moving_sum").cast("double"), F.col("order_moving_count"))
    return moved.select("o_orderkey", "day", mean.alias("moving_mean"), F.col("order_moving_count").alias("records"))


def previous_order_of_customer(spark: SparkSession, d: str) -> DataFrame:
    """Every order with the customer's previous one and the change from it."""
    rows = lw.lagged(_all_orders(spark, d, "o_custkey", keys=("o_custkey",)), {"previous_day": "day", "previous_amount": "amount"})
    return rows.select(
        "o_custkey", "o_orderkey", "day", "previous_day", "previous_amount", (F.col("amount") - F.col("previous_amount")).alias("diff")
    )


def orders_to_date(spark: SparkSession, d: str) -> DataFrame:
    """Sum, count and largest amount of the year's orders so far, at every order."""
    series = _all_orders(spark, d, "year")
    done = lw.running(series, {"order": "amount"}, ("sum", "count", "max"), reset=["year"])
    return done.select("o_orderkey", "year", "order_running_sum", "order_running_count", "order_running_max")


def _in_batches(how: mt.Retention, rows: DataFrame, batches: int) -> mt.Kept:
    """State after batches dealt by key, so that many rows come late."""
    part = F.pmod(F.xxhash64("term_id"), F.lit(batches))
    kept = how.begin(rows.where(part == 0))
    for i in range(1, batches):
        kept = how.add(kept, rows.where(part == i), history=rows.where(part < i))
    return kept


def retention_kept_up(spark: SparkSession, d: str) -> DataFrame:
    """R2 from stored first dates and bitmaps, three batches with late rows."""
    how = mt.Retention(E, S, S, "year")
    return how.counts(_in_batches(how, src.interval_history(spark, d), 3))


def interval_retention_kept_up(spark: SparkSession, d: str) -> DataFrame:
    """R9 from stored first dates and bitmaps by first year, two batches with late rows."""
    how = mt.Retention(E, S, "at", "year", {"first_year": cal.year_of("first")}, null_is_zero=True)
    years = F.explode_outer(cal.covered_years(F.col(S), F.col(END)))
    rows = src.interval_history(spark, d).select(E, S, "term_id", years.alias("y"))
    return how.counts(_in_batches(how, rows.select(E, S, "term_id", cal.year_end("y").alias("at")), 2))


def retention_rolled_up(spark: SparkSession, d: str) -> DataFrame:
    """R2 by month of the first date, kept as bitmaps and rolled up to its year without the history."""
    how = mt.Retention(E, S, S, "year", {"first_month": F.trunc("first", "month")})
    kept = how.begin(src.interval_history(spark, d))
    sets = kept.sets.withColumn("first_year", cal.year_of("first_month"))
    return how.counts(mt.Kept(kept.entities, sets, kept.retired), by=["first_year", "period"])


def membership_age(spark: SparkSession, d: str) -> DataFrame:
    """Per entity the time from its first start to its last end, as years, months and days."""
    span = _terms(spark, d).groupBy(E).agg(F.min(S).alias("first"), F.max(END).alias("last"))
    return span.select(E, "first", "last", age("last", "first").alias("a")).select(E, "first", "last", "a.*")


def _kept_view(spark: SparkSession, d: str) -> kept_views.MonthlyView:
    """The series of the analyses as a kept view: built from most orders, the rest
    added as a batch, one year refreshed from the source."""
    segments = src.read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("kind_of_business")
    )
    orders = src.read_table(spark, d, "orders").select("o_custkey", "o_orderdate", cents("o_totalprice").alias("amount"))
    rows = orders.join(segments, "o_custkey").select("o_orderdate", "amount", "kind_of_business")
    late = (F.col("amount") % 4 == 0) & (F.year("o_orderdate") >= 1999)
    view = kept_views.MonthlyView(spark, f"{staging_dir(spark)}/monthly-{uuid.uuid4().hex}")
    view.build(rows.where(~late), "o_orderdate", "amount")
    view.add(rows.where(late), "o_orderdate", "amount")
    view.refresh(rows, "o_orderdate", "amount", [dt.date(1996, m, 1) for m in range(1, 13)])
    return view


def growth_of_kept_view(spark: SparkSession, d: str) -> DataFrame:
    return gr.growth(_kept_view(spark, d).series(), "sales", digits=2, keys=["kind_of_business"])


def extremes_of_kept_view(spark: SparkSession, d: str) -> DataFrame:
    label = A.LABEL_SINGLE
    one = se.pivot_categories(_kept_view(spark, d).series(), {label: A.CAT_SINGLE}, "month", restrict=False)
    return gr.extremes(gr.same_period_last_year(one, f"{label}_monthly_sales"), "pct_diff")


def _at(spark: SparkSession, name: str) -> tuple[str, str]:
    """A table's name and place, new with each call."""
    made = f"{name}_{uuid.uuid4().hex}"
    return made, f"{staging_dir(spark)}/{made}"


def retention_by_dimension_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """R14 over bucketed tables: history and dimension meet bucket by bucket."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    terms = layout.write_bucketed(_terms(spark, d), *_at(spark, "terms"), E, buckets)
    dimension = layout.write_bucketed(src.entity_dimension(spark, d), *_at(spark, "dimension"), E, buckets)
    counts = co.interval_retention_counts(terms, E, S, END, ["gender"], dimension=dimension, dimension_cols=["gender"])
    return co.retention_curve(
        counts, by=["gender"], size_col="cohort_size_by_gender", pct_col="pct_retained_by_gender", digits=None
    )


def retention_from_pruned_years(spark: SparkSession, d: str) -> DataFrame:
    """Retention of the cohorts of some years from a history by year and kept first
    dates: rows from before the cohorts' range are never read."""
    terms = _terms(spark, d)
    path = _at(spark, "history")[1]
    layout.write_by_year(terms, path, S, E)
    firsts = mt.first_dates(terms, E, S).where(F.col("first").between(cal.lit_date(A.COHORT_FROM), cal.lit_date(A.COHORT_TO)))
    later = layout.read_by_year(spark, path, terms.schema, first=A.COHORT_FROM, start=S)
    chosen = later.join(staged(firsts, "firsts").select(E), E, "left_semi")
    return co.interval_retention_counts(chosen, E, S, END)


QUERIES = {
    "retention_december_31": retention_december_31,
    "retention_month_ends": retention_month_ends,
    "intervals_at_quarter_days": intervals_at_quarter_days,
    "open_at_opening_days": open_at_opening_days,
    "purchases_after_signup": purchases_after_signup,
    "trailing_year_by_day": trailing_year_by_day,
    "trailing_months_by_day_and_segment": trailing_months_by_day_and_segment,
    "moving_average_of_orders": moving_average_of_orders,
    "previous_order_of_customer": previous_order_of_customer,
    "orders_to_date": orders_to_date,
    "retention_kept_up": retention_kept_up,
    "interval_retention_kept_up": interval_retention_kept_up,
    "retention_rolled_up": retention_rolled_up,
    "membership_age": membership_age,
    "growth_of_kept_view": growth_of_kept_view,
    "extremes_of_kept_view": extremes_of_kept_view,
    "retention_by_dimension_bucketed": retention_by_dimension_bucketed,
    "retention_from_pruned_years": retention_from_pruned_years,
}
