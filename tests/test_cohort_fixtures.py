"""Hand-checked edge cases (FIXTURES.md section 3.1)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cadence.functions import calendar as cal
from cadence.operators import cohort as co

D = dt.date

TERMS = [
    ("e1", D(1900, 3, 1), D(1902, 3, 1), "NY", 1),
    ("e1", D(1902, 3, 1), D(1904, 2, 28), "OH", 2),
    ("e2", D(1901, 1, 3), D(1901, 6, 30), "NY", 3),
    ("e3", D(1996, 2, 29), D(2000, 2, 28), "VA", 4),
    ("e3", D(2000, 2, 29), D(2001, 2, 28), "VA", 5),
    ("e4", D(1920, 3, 4), D(1921, 12, 31), "TX", 6),
    ("e4", D(1920, 3, 4), D(1922, 3, 3), "CA", 7),
]
DIM = [("e1", "M"), ("e2", "F"), ("e3", "F"), ("e4", "M"), ("e5", "F")]
E, S, END = "id_bioguide", "term_start", "term_end"


@pytest.fixture(scope="module")
def h(spark):
    return spark.createDataFrame(
        TERMS, "id_bioguide string, term_start date, term_end date, state string, term_id long"
    )


@pytest.fixture(scope="module")
def d(spark):
    return spark.createDataFrame(DIM, "id_bioguide string, gender string")


def _counts(df, keys=()):
    out = {}
    for r in df.collect():
        k = tuple(r[x] for x in keys)
        out.setdefault(k, {})[r["period"]] = r["cohort_retained"]
    return {k: [v[p] for p in sorted(v)] for k, v in out.items()}


def test_first_event(h):
    rows = co.first_event(h, E, S).collect()
    assert [(r[E], r["first_term"]) for r in rows] == [
        ("e1", D(1900, 3, 1)),
        ("e2", D(1901, 1, 3)),
        ("e4", D(1920, 3, 4)),
        ("e3", D(1996, 2, 29)),
    ]


def test_retention_counts_and_curve(h):
    counts = co.retention_counts(h, E, S)
    assert {r["period"]: r["cohort_retained"] for r in counts.collect()} == {0: 4, 2: 1, 4: 1}
    curve = co.retention_curve(counts).orderBy("period").collect()
    assert [r["pct_retained"] for r in curve] == [1.0, 0.25, 0.25]
    assert {r["cohort_size"] for r in curve} == {4}


def test_retention_pivot(h):
    pivot = co.retention_pivot(co.retention_curve(co.retention_counts(h, E, S))).first()
    assert pivot.asDict() == {"cohort_size": 4, "yr_0": 1.0, "yr_2": 0.25, "yr_4": 0.25, "yr_6": None}


def test_expand_to_spine(h):
    rows = co.expand_to_spine(h, E, S, END).collect()
    assert len(rows) == 14
    assert sum(r["date"] is not None for r in rows) == 13
    nulls = [r for r in rows if r["date"] is None]
    assert nulls[0][E] == "e2" and nulls[0]["period"] is None


def test_interval_counts(h):
    got = _counts(co.interval_retention_counts(h, E, S, END))
    assert got == {(): [4, 3, 2, 2, 1]}


def test_by_century(h):
    counts = co.interval_retention_counts(
        h, E, S, END, by=["first_century"], derived={"first_century": cal.century("first_term")}
    )
    curve = co.retention_curve(counts, by=["first_century"], digits=4).collect()
    by = {}
    for r in curve:
        by.setdefault(r["first_century"], []).append((r["period"], r["cohort_size"], r["pct_retained"]))
    assert sorted(by[19]) == [(0, 1, 1.0), (1, 1, 1.0), (2, 1, 1.0), (3, 1, 1.0)]
    assert [p for _, _, p in sorted(by[20])] == [1.0, 0.6667, 0.3333, 0.3333, 0.3333]
    assert {s for _, s, _ in by[20]} == {3}


def test_first_attribute_tiebreak(h):
    rows = co.first_attribute(h, E, S, "state", "term_id").collect()
    assert {r[E]: r["first_state"] for r in rows} == {"e1": "NY", "e2": "NY", "e3": "VA", "e4": "TX"}


def test_by_dimension(h, d):
    counts = co.interval_retention_counts(h, E, S, END, by=["gender"], dimension=d, dimension_cols=["gender"])
    assert _counts(counts, ["gender"]) == {("F",): [2, 1, 1, 1, 1], ("M",): [2, 2, 1, 1]}


def test_by_dimension_range(h, d):
    counts = co.interval_retention_counts(
        h, E, S, END, by=["gender"], dimension=d, dimension_cols=["gender"],
        cohort_from="1917-01-01", cohort_to="1999-12-31",
    )
    assert _counts(counts, ["gender"]) == {("F",): [1, 1, 1, 1, 1], ("M",): [1, 1]}


def test_sparse_multi(h, d):
    counts = co.interval_retention_counts(
        h, E, S, END, by=["first_state", "gender"], attribute="state", tiebreak="term_id",
        dimension=d, dimension_cols=["gender"], cohort_from="1917-01-01", cohort_to="1999-12-31",
    )
    assert _counts(counts, ["first_state", "gender"]) == {("TX", "M"): [1, 1], ("VA", "F"): [1, 1, 1, 1, 1]}


def test_unrounded_curve_and_size(h, d):
    counts = co.interval_retention_counts(h, E, S, END, by=["gender"], dimension=d, dimension_cols=["gender"])
    curve = co.retention_curve(counts, by=["gender"], digits=None).where(F.col("gender") == "F").orderBy("period")
    assert [r["pct_retained"] for r in curve.collect()] == [1.0, 0.5, 0.5, 0.5, 0.5]


def test_null_period_sorts_last(spark):
    """A NULL period must not become the cohort size (NULLs sort last)."""
    counts = spark.createDataFrame([(None, 9), (0, 5), (1, 4)], "period long, cohort_retained long")
    rows = co.retention_curve(counts).collect()
    assert {r["cohort_size"] for r in rows} == {5}


def test_null_start_forms_null_period(spark):
    h = spark.createDataFrame(
        [("a", D(2000, 1, 1)), ("a", None), ("b", D(2001, 5, 1)), (None, D(1999, 1, 1))],
        "id string, ts date",
    )
    got = {r["period"]: r["cohort_retained"] for r in co.retention_counts(h, "id", "ts").collect()}
    assert got == {0: 2, None: 1}


def test_hot_entity_is_bounded_before_window(spark):
    """One entity holding most rows: the per-entity step sees one row per
    distinct date, so the result is the same as for its distinct dates."""
    rows = [("hot", D(2000, 1, 1 + i % 20)) for i in range(5000)] + [("x", D(2001, 3, 1))]
    h = spark.createDataFrame(rows, "id string, ts date")
    got = {r["period"]: r["cohort_retained"] for r in co.retention_counts(h, "id", "ts", "day").collect()}
    assert got == {**{p: 1 for p in range(1, 20)}, 0: 2}


def test_null_entity_keeps_its_group_in_stand_alone_first_rows(spark):
    rows = [(None, dt.date(2000, 1, 2), "b", 2), (None, dt.date(2000, 1, 1), "a", 1), (7, dt.date(2001, 1, 1), "c", 3)]
    h = spark.createDataFrame(rows, "id int, d date, label string, tie int")
    assert sorted(map(tuple, co.first_event(h, "id", "d").collect()), key=str) == [
        (7, dt.date(2001, 1, 1)),
        (None, dt.date(2000, 1, 1)),
    ]
    got = co.first_attribute(h, "id", "d", "label", "tie").collect()
    assert {r["id"]: r["first_label"] for r in got} == {None: "a", 7: "c"}


def test_terms_beyond_any_fixed_year_are_expanded(spark):
    rows = [(1, dt.date(2003, 1, 1), dt.date(2008, 6, 1)), (2, dt.date(2006, 3, 1), dt.date(2009, 1, 1))]
    h = spark.createDataFrame(rows, "id int, s date, e date")
    counts = co.interval_retention_counts(h, "id", "s", "e").collect()
    assert {r["period"]: r["cohort_retained"] for r in counts} == {0: 2, 1: 2, 2: 2, 3: 1, 4: 1}


def test_copies_travel_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(co, "COPIES_PER_CHUNK", 3)
    rows = [(1, dt.date(2000, 1, 1), dt.date(2001, 6, 1))] * 10 + [(1, dt.date(1999, 5, 1), dt.date(1999, 6, 1))]
    h = spark.createDataFrame(rows, "id int, s date, e date")
    out = co.expand_to_spine(h, "id", "s", "e", rows_per_task=4).collect()
    assert len(out) == 11 and sum(r["date"] is None for r in out) == 1
    assert {r["first_term"] for r in out} == {dt.date(1999, 5, 1)}


def test_timestamps_complete_months_by_the_time_of_day(spark):
    import duckdb

    from tests.harness import duck_connect  # noqa: F401 - same engine as the oracles

    times = [
        (1, dt.datetime(2000, 1, 31, 10)), (1, dt.datetime(2000, 2, 29, 11)), (1, dt.datetime(2001, 1, 31, 9)),
        (1, dt.datetime(2001, 1, 31, 10)), (2, dt.datetime(2000, 6, 1, 10)), (2, dt.datetime(2001, 6, 1, 8)),
    ]
    h = spark.createDataFrame(times, "id int, ts timestamp")
    for unit, expr in (
        ("year", "date_part('year', age(ts, f))"),
        ("month", "date_part('year', age(ts, f)) * 12 + date_part('month', age(ts, f))"),
    ):
        con = duckdb.connect()
        values = ", ".join(f"({i}, TIMESTAMP '{t}')" for i, t in times)
        want = con.execute(
            f"SELECT {expr} p, count(DISTINCT id) FROM (SELECT *, min(ts) OVER (PARTITION BY id) f "
            f"FROM (VALUES {values}) v(id, ts)) GROUP BY 1"
        ).fetchall()
        got = co.retention_counts(h, "id", "ts", unit).collect()
        assert sorted(map(tuple, got)) == sorted(want)
