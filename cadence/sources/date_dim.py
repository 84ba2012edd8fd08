"""The date dimension: one row per day, with the columns that calendars filter by."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_dim(spark: SparkSession, first: str | _dt.date, last: str | _dt.date) -> DataFrame:
    """Days from ``first`` to ``last`` inclusive. Names are English; weeks and
    days of the week count as in ISO 8601 (Monday is 1). Its size is set by
    the bounds, not by any data: generated where it is needed, never stored."""
    begin, end = (_dt.date.fromisoformat(str(d)) for d in (first, last))
    days = spark.range(max(0, (end - begin).days + 1))
    d = F.col("date")
    return days.select(F.date_add(F.lit(begin), F.col("id").cast("int")).alias("date")).select(
        "date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.trunc(d, "month").alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        F.trunc(d, "quarter").alias("first_day_of_quarter"),
        F.trunc(d, "year").alias("first_day_of_year"),
        (d == F.last_day(d)).alias("is_month_end"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )
