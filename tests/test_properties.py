"""
driver tables, plus randomized calendar checks against DuckDB's age()."""

import datetime as dt

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cadence.functions import calendar as cal
from cadence.operators import cohort as co
from cadence.operators import rolling as ro
from cadence.plans import analogs as A
from cadence.plans import series_queries
from cadence.sources import tables as src
from tests.conftest import SF01

Q = entry.queries()


def test_pct_is_one_at_lowest_period_and_size_constant(spark):
    curve = Q["retention_by_year"](spark, SF01)
    w = Window.partitionBy("first_year")
    checked = curve.select(
        "first_year",
        "period",
        "pct_retained",
        F.min("period").over(w).alias("p0"),
        F.size(F.collect_set("cohort_size").over(w)).alias("sizes"),
    )
    assert checked.where("period = p0 and pct_retained <> 1.0").count() == 0
    assert checked.where("sizes <> 1").count() == 0


def test_every_entity_counted_at_period_zero(spark):
    """Period 0 of the interval counts is every entity (each first interval
    covers its own start, which is in period 0 or has no year end)."""
    counts = Q["interval_retention_counts"](spark, SF01).where("period = 0").first()["cohort_retained"]
    entities = src.interval_history(spark, SF01).select("id_bioguide").distinct().count()
    assert counts == entities


def test_window_form_equals_self_join_form(spark):
    """R2 via a window over distinct (entity, date) rows equals the literal
    self-join of the first-event aggregate to the history."""
    h = src.interval_history(spark, SF01)
    first = h.groupBy("id_bioguide").agg(F.min("term_start").alias("first_term"))
    literal = (
        first.join(h, "id_bioguide")
        .groupBy(cal.completed_units("year", "first_term", "term_start").alias("period"))
        .agg(F.countDistinct("id_bioguide").alias("cohort_retained"))
    )
    ours = co.retention_counts(h, "id_bioguide", "term_start")
    assert sorted(ours.collect()) == sorted(literal.collect())


def test_explode_form_equals_literal_range_join(spark):
    """R6's per-row year-end expansion equals the range join to a daily
    date dimension filtered to December 31."""
    h = src.interval_history(spark, "/root/testdata/sf0.001")
    ours = co.expand_to_spine(h, "id_bioguide", "term_start", "term_end")
    days = spark.range(1).select(
        F.explode(F.sequence(cal.lit_date("1980-01-01"), cal.lit_date("2030-12-31"))).alias("date")
    ).where((F.month("date") == 12) & (F.dayofmonth("date") == 31))
    first = h.groupBy("id_bioguide").agg(F.min("term_start").alias("first_term"))
    b = h.alias("b")
    literal = (
        first.join(b, "id_bioguide")
        .join(days, (days.date >= F.col("b.term_start")) & (days.date <= F.col("b.term_end")), "left")
        .select(
            "id_bioguide", "first_term", "term_start", "term_end", "date",
            cal.completed_units("year", "first_term", "date").alias("period"),
        )
    )
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(map(tuple, literal.collect()), key=str)


def test_categories_sum_to_total(spark):
    series = src.long_series(spark, SF01)
    by_cat = series.agg(F.sum("sales")).first()[0]
    total = src.read_table(spark, SF01, "orders").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).first()[0]
    assert by_cat == total


def test_ytd_in_december_equals_yearly_total(spark):
    ytd = Q["ytd_sum"](spark, SF01).where(F.month("sales_month") == 12)
    yearly = Q["index_to_base"](spark, SF01)
    dec = {r["sales_month"].year: r["total_men_sales_ytd"] for r in ytd.collect()}
    tot = {r["sales_year"]: r["men_yearly_sales"] for r in yearly.collect()}
    assert dec and all(dec[y] == tot[y] for y in dec)


def test_sparse_range_equals_dense_with_lead_in(spark):
    rng = Q["rolling_sparse_range"](spark, SF01)
    pair = ro.sparse_months(series_queries._pair(spark, SF01), A.SPARSE_MONTHS, ["women_monthly_sales"])
    dense = ro.rolling_dense(
        spark, pair, A.MONTH_SPINE_FROM, A.MONTH_SPINE_TO, {"women": "women_monthly_sales"}, lead_in=True
    )
    r1 = {r["date"]: (r["women_sales_moving_avg"], r["records"]) for r in rng.collect()}
    r2 = {r["full_date"]: (r["women_sales_moving_avg"], r["women_records_in_window"]) for r in dense.collect()}
    assert r1 == r2


_dates = st.dates(min_value=dt.date(1890, 1, 1), max_value=dt.date(2030, 12, 31))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(_dates, _dates), min_size=50, max_size=200))
def test_completed_units_match_duckdb_age(spark, pairs):
    pairs = [(min(a, b), max(a, b)) for a, b in pairs]
    df = spark.createDataFrame(pairs, "a date, b date")
    got = df.select(
        cal.completed_units("year", "a", "b").alias("y"),
        cal.completed_units("month", "a", "b").alias("m"),
        cal.completed_units("day", "a", "b").alias("d"),
    ).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE p (i INTEGER, a DATE, b DATE)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(pairs)])
    want = con.execute(
        "SELECT date_part('year', age(b::TIMESTAMP, a::TIMESTAMP)), "
        "date_part('year', age(b::TIMESTAMP, a::TIMESTAMP)) * 12 + date_part('month', age(b::TIMESTAMP, a::TIMESTAMP)), "
        "b - a FROM p ORDER BY i"
    ).fetchall()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(_dates, st.integers(min_value=0, max_value=3000)), min_size=20, max_size=100))
def test_covered_years_match_day_scan(spark, terms):
    rows = [(s, s + dt.timedelta(days=n)) for s, n in terms]
    df = spark.createDataFrame(rows, "s date, e date")
    got = [r[0] for r in df.select(cal.covered_years("s", "e")).collect()]
    want = [[y for y in range(s.year, e.year + 1) if s <= dt.date(y, 12, 31) <= e] for s, e in rows]
    assert got == want


def _completed_years(a, b):
    """Reference model: whole years from a to b (a <= b), calendar fields."""
    return b.year - a.year - (1 if (b.month, b.day) < (a.month, a.day) else 0)


def _brute_force_first_state_retention(terms):
    """Distinct entities per (first state, period), straight from the
    definition: first term = earliest start, first state = state of the
    earliest (start, tiebreak) row, periods from each Dec 31 an interval
    covers, period 0 for an interval covering none."""
    first = {}
    for e, s, end, state, k in terms:
        if e not in first or (s, k) < first[e][:2]:
            first[e] = (s, k, state)
    cells = {}
    for e, s, end, state, k in terms:
        f_start, _, f_state = first[e]
        ends = [dt.date(y, 12, 31) for y in range(s.year, end.year + 1) if s <= dt.date(y, 12, 31) <= end]
        periods = [_completed_years(f_start, d) for d in ends] or [0]
        for p in periods:
            cells.setdefault((f_state, p), set()).add(e)
    return {key: len(v) for key, v in cells.items()}


_term = st.tuples(
    st.integers(0, 6),
    st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2005, 12, 31)),
    st.integers(-30, 2000),
    st.sampled_from(["NY", "OH", "VA", "TX"]),
)


@settings(max_examples=8, deadline=None)
@given(st.lists(_term, min_size=1, max_size=60))
def test_first_state_retention_matches_brute_force(spark, raw):
    terms = [(e, s, s + dt.timedelta(days=n), state, k) for k, (e, s, n, state) in enumerate(raw)]
    df = spark.createDataFrame(terms, "e long, s date, t date, state string, k long")
    got = co.interval_retention_counts(df, "e", "s", "t", by=["first_state"], attribute="state", tiebreak="k")
    got = {(r["first_state"], r["period"]): r["cohort_retained"] for r in got.collect()}
    assert got == _brute_force_first_state_retention(terms)


def _completed_months(a, b):
    return (b.year - a.year) * 12 + b.month - a.month - (1 if b.day < a.day else 0)


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 8), st.dates(min_value=dt.date(1995, 1, 1), max_value=dt.date(2003, 12, 31))),
        min_size=1,
        max_size=80,
    ),
    st.sampled_from(["year", "month", "week", "day"]),
)
def test_event_retention_matches_brute_force(spark, events, unit):
    first = {}
    for e, d in events:
        first[e] = min(first.get(e, d), d)
    unit_of = {
        "year": _completed_years,
        "month": _completed_months,
        "week": lambda a, b: (b - a).days // 7,
        "day": lambda a, b: (b - a).days,
    }[unit]
    cells = {}
    for e, d in events:
        cells.setdefault(unit_of(first[e], d), set()).add(e)
    want = {p: len(v) for p, v in cells.items()}
    df = spark.createDataFrame(events, "e long, d date")
    got = {r["period"]: r["cohort_retained"] for r in co.retention_counts(df, "e", "d", unit).collect()}
    assert got == want


@settings(max_examples=6, deadline=None)
@given(st.lists(_term, min_size=1, max_size=40), st.integers(1, 5))
def test_spine_expansion_matches_brute_force(spark, raw, rows_per_task):
    terms = [(e, s, s + dt.timedelta(days=n)) for e, s, n, _ in raw]
    terms = terms + terms[: len(terms) // 3]  # duplicate intervals must all survive
    first = {}
    for e, s, _ in terms:
        first[e] = min(first.get(e, s), s)
    want = []
    for e, s, t in terms:
        ends = [dt.date(y, 12, 31) for y in range(s.year, t.year + 1) if s <= dt.date(y, 12, 31) <= t]
        for d in ends or [None]:
            want.append((e, first[e], s, t, d, None if d is None else _completed_years(first[e], d)))
    df = spark.createDataFrame(terms, "e long, s date, t date")
    got = co.expand_to_spine(df, "e", "s", "t", rows_per_task=rows_per_task).collect()
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
