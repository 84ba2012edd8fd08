"""The calendar helpers as Spark SQL functions, for users who write SQL.

``register(spark)`` creates session-scoped SQL functions (SQL-bodied, so
Catalyst inlines them into the plan like any built-in expression; no
Python runs per row):

* ``age_years(later, earlier)``   completed years, PostgreSQL's
  ``date_part('year', age(later, earlier))``
* ``age_months(later, earlier)``  completed months (years * 12 + months of
  the same interval)
* ``age_parts(later, earlier)``   the difference as a struct of years, months
  and days, PostgreSQL's ``age(later, earlier)``
* ``date_century(d)``             PostgreSQL's ``date_part('century', d)``
* ``month_name_padded(d)``        ``to_char(d, 'Month')``

They compute the same values as ``calendar.completed_units``,
``calendar.century`` and ``calendar.padded_month_name``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _forward(unit: str, a: str, b: str) -> str:
    if unit == "year":
        return (
            f"year({b}) - year({a}) - CASE WHEN month({b}) * 100 + day({b}) "
            f"< month({a}) * 100 + day({a}) THEN 1 ELSE 0 END"
        )
    return (
        f"(year({b}) - year({a})) * 12 + month({b}) - month({a}) "
        f"- CASE WHEN day({b}) < day({a}) THEN 1 ELSE 0 END"
    )


def _age(unit: str) -> str:
    fwd = _forward(unit, "earlier", "later")
    back = _forward(unit, "later", "earlier")
    return (
        "(later DATE, earlier DATE) RETURNS BIGINT RETURN "
        f"CAST(CASE WHEN earlier <= later THEN {fwd} ELSE -({back}) END AS BIGINT)"
    )


_LO, _HI = "least(later, earlier)", "greatest(later, earlier)"
_SHORT = f"CASE WHEN day({_HI}) < day({_LO}) THEN 1 ELSE 0 END"
_MONTHS = f"((year({_HI}) - year({_LO})) * 12 + month({_HI}) - month({_LO}) - {_SHORT})"
_SIGN = "CASE WHEN later < earlier THEN -1 ELSE 1 END"
_AGE_PARTS = (
    "(later DATE, earlier DATE) RETURNS STRUCT<years: BIGINT, months: BIGINT, days: BIGINT> RETURN "
    "CASE WHEN later IS NOT NULL AND earlier IS NOT NULL THEN named_struct("
    f"'years', CAST(({_SIGN}) * ({_MONTHS} div 12) AS BIGINT), "
    f"'months', CAST(({_SIGN}) * ({_MONTHS} % 12) AS BIGINT), "
    f"'days', CAST(({_SIGN}) * (day({_HI}) - day({_LO}) + ({_SHORT}) * day(last_day({_LO}))) AS BIGINT)) END"
)

FUNCTIONS = {
    "age_parts": _AGE_PARTS,
    "age_years": _age("year"),
    "age_months": _age("month"),
    "date_century": "(d DATE) RETURNS BIGINT RETURN CAST(floor((year(d) + 99) / 100) AS BIGINT)",
    "month_name_padded": "(d DATE) RETURNS STRING RETURN rpad(date_format(d, 'MMMM'), 9, ' ')",
}


def register(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions; returns their names."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(FUNCTIONS)
