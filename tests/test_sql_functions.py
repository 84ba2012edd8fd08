"""SQL users: the calendar helpers as Spark SQL functions, and analyses
written as SQL in the reference's shape give the operators' results."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from cadence.functions import sql as sqlf
from cadence.sources import tables as src
from tests.conftest import SF001, SF01

D = dt.date


@pytest.fixture(scope="module")
def registered(spark):
    sqlf.register(spark)
    return spark


def test_scalars(registered):
    r = registered.sql(
        "select age_years(date'1997-02-28', date'1996-02-29') a, age_years(date'2000-02-29', date'1996-02-29') b, "
        "age_months(date'2000-03-30', date'2000-01-31') c, age_years(date'1999-07-01', date'2001-06-01') d, "
        "date_century(date'1900-06-01') e, date_century(date'1901-01-01') f, date_century(date'2001-01-01') g, "
        "month_name_padded(date'2020-05-01') h"
    ).first()
    assert tuple(r) == (0, 4, 1, -1, 19, 20, 21, "May      ")


def test_sql_functions_are_inlined(registered):
    plan = registered.sql("select age_years(current_date(), date'2000-01-01') x")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_completed_years_in_sql_equal_operator(registered):
    src.interval_history(registered, SF01).createOrReplaceTempView("orders_as_terms")
    counted = registered.sql(
        """
        select years, count(distinct who) as n
        from (select id_bioguide as who, age_years(term_start, min(term_start) over (partition by id_bioguide)) as years
              from orders_as_terms)
        group by years
        """
    )
    ours = entry.queries()["retention_counts"](registered, SF01)
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, ours.collect()))


def test_century_cohorts_in_sql_equal_operator(registered):
    """Year ends generated per interval with SQL, against the operator."""
    src.interval_history(registered, SF001).createOrReplaceTempView("orders_as_terms")
    counted = registered.sql(
        """
        select date_century(opened) as century,
               coalesce(age_years(make_date(y, 12, 31), opened), 0) as years,
               count(distinct who) as n
        from (select who, opened, y
              from (select id_bioguide as who, term_start, term_end,
                           min(term_start) over (partition by id_bioguide) as opened
                    from orders_as_terms)
              lateral view outer explode(filter(
                  sequence(year(term_start), year(term_end)),
                  x -> make_date(x, 12, 31) between term_start and term_end)) as y)
        group by 1, 2
        """
    )
    ours = entry.queries()["retention_by_century"](registered, SF001).select(
        "first_century", "period", "cohort_retained"
    )
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, ours.collect()))
