"""Trailing ranges by event deltas: against the literal range join, month ends, plans."""

import datetime as dt
import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadence.operators import deltas

FIRST, LAST = "2000-02-10", "2001-04-05"


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    rows = [
        (
            rng.choice(["a", "b", None]),
            None if rng.random() < 0.03 else dt.date(1999, 1, 1) + dt.timedelta(days=rng.randint(0, 1000)),
            None if rng.random() < 0.1 else rng.randint(-500, 500),
            rng.randint(0, 9),
        )
        for _ in range(400)
    ]
    rows += [("c", dt.date(1999, 1, 31), 1, 1), ("d", dt.date(2003, 1, 1), 5, 5)]
    con = duckdb.connect()
    con.execute("CREATE TABLE v (k VARCHAR, d DATE, x BIGINT, y BIGINT)")
    con.executemany("INSERT INTO v VALUES (?, ?, ?, ?)", rows)
    con.execute(
        f"CREATE TABLE spine AS SELECT CAST(t AS DATE) AS date FROM generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 DAY) g(t)"
    )
    return spark.createDataFrame(rows, "k string, d date, x long, y long"), con


def literal(start, keys=False):
    columns = ", ".join(
        f"CAST(sum(v.{c}) AS BIGINT) AS {n}_sum, count(v.{c}) AS {n}_count, CAST(sum(v.{c}) AS DOUBLE) / count(v.{c}) AS {n}_mean"
        for n, c in (("left", "x"), ("right", "y"))
    )
    if not keys:
        return f"SELECT s.date, {columns} FROM spine s LEFT JOIN v ON v.d BETWEEN {start} AND s.date GROUP BY s.date"
    return f"""
WITH g AS (SELECT DISTINCT v.k FROM v JOIN spine s ON v.d BETWEEN {start} AND s.date)
SELECT g.k, s.date, {columns} FROM spine s CROSS JOIN g
LEFT JOIN v ON v.k IS NOT DISTINCT FROM g.k AND v.d BETWEEN {start} AND s.date GROUP BY g.k, s.date"""


RANGES = [
    ({"days": 1}, "s.date"),
    ({"days": 90}, "s.date - 89"),
    ({"days": 800}, "s.date - 799"),
    ({"months": 0}, "s.date"),
    ({"months": 1}, "CAST(s.date - INTERVAL 1 MONTH AS DATE)"),
    ({"months": 11}, "CAST(s.date - INTERVAL 11 MONTH AS DATE)"),
]


@pytest.mark.parametrize("keys", [False, True])
@pytest.mark.parametrize("given_range,start", RANGES)
def test_equals_the_literal_range_join(tables, given_range, start, keys):
    values, con = tables
    got = deltas.trailing_range(
        values, "d", {"left": "x", "right": "y"}, FIRST, LAST, keys=["k"] if keys else (), **given_range
    )
    rel = con.sql(literal(start, keys))
    assert sorted(map(tuple, got.select(*rel.columns).collect()), key=str) == sorted(rel.fetchall(), key=str)


@settings(max_examples=200, deadline=None)
@given(st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)), st.integers(0, 40))
def test_first_day_out_of_a_month_range(entered, months):
    """The rule of ``leaves_after_months``, in plain dates: the first day whose look-back begins after the value."""

    def back(d, n):
        k = d.year * 12 + d.month - 1 - n
        first = dt.date(k // 12, k % 12 + 1, 1)
        last = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        return first.replace(day=min(d.day, last.day))

    after = entered + dt.timedelta(days=1)
    there = back(after, -months)
    leaves = there if there.day == after.day else there + dt.timedelta(days=1)
    assert back(leaves, months) > entered
    assert back(leaves - dt.timedelta(days=1), months) <= entered


def test_no_values_leave_an_empty_spine(tables):
    values, _ = tables
    none = values.where("false")
    got = deltas.trailing_range(none, "d", {"v": "x"}, FIRST, LAST, days=30).collect()
    assert len(got) == (dt.date.fromisoformat(LAST) - dt.date.fromisoformat(FIRST)).days + 1
    assert all(r["v_sum"] is None and r["v_count"] == 0 and r["v_mean"] is None for r in got)
    assert deltas.trailing_range(none, "d", {"v": "x"}, FIRST, LAST, days=30, keys=["k"]).count() == 0


def test_arguments_are_checked(tables):
    values, _ = tables
    for bad in ({}, {"days": 3, "months": 1}, {"days": 0}, {"months": -1}):
        with pytest.raises(ValueError):
            deltas.trailing_range(values, "d", {"v": "x"}, FIRST, LAST, **bad)
    with pytest.raises(ValueError):
        deltas.trailing_range(values, "d", {"v": "k"}, FIRST, LAST, days=3)


def test_shuffled_rows_do_not_depend_on_the_width(spark, tables):
    """At most two rows per value and day leave the scan's stage, whatever the range."""
    values, _ = tables
    plans = [
        deltas.trailing_range(values, "d", {"v": "x"}, FIRST, LAST, days=n)._jdf.queryExecution().optimizedPlan().toString()
        for n in (7, 700)
    ]
    shapes = [[line.split("(")[0].split("#")[0].strip(" +-:") for line in p.splitlines()] for p in plans]
    assert [s.split(" ")[0] for s in shapes[0]] == [s.split(" ")[0] for s in shapes[1]]
    assert all("sequence" not in p.split("Aggregate", 1)[1] for p in plans)
