"""Interval joins: each interval with the points inside it, without a nested loop.

``calendar_join`` is for a calendar: any DataFrame of dates, filtered by any of
its columns. Its distinct dates are numbered; a day table tells how many lie
before and up to each day. The bounds of an interval so become a range of
numbers, which is exploded and joined to the calendar by number: exactly one
row per match, no residual test, and every join is an equi-join to a table
that only the calendar makes large. Histories are not shuffled while Spark's
size check lets the calendar be broadcast.

``interval_join`` is for points of any number, with or without keys. Distinct
intervals and points fall into bins, meet by an equi-join on (keys, bin) and
pass the exact test; what was found returns to the intervals by an outer join
on (keys, start, end), so an interval without a point is there once, and copies
of an interval are compared once. Both sides of the binned join are plain shuffles, so AQE splits a bin
that holds very many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import calendar as cal
from cadence.functions.ordering import order_small

MICROS_PER_DAY = 86_400_000_000
# A bin of the next level is this many bins wide; an interval covers at most one more than this.
LEVEL_FACTOR = 16


def _distinct_names(left: DataFrame, right: Sequence[str]) -> None:
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")


def _is_timed(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName().startswith("timestamp")


def calendar_join(
    intervals: DataFrame,
    calendar: DataFrame,
    start: str,
    end: str,
    date: str = "date",
    how: str = "left",
) -> DataFrame:
    """``intervals LEFT JOIN calendar ON date BETWEEN start AND end`` (``how``:
    left or inner), all columns of both.

    The calendar may have gaps and several rows per date; null dates match
    nothing. An interval with a null bound, with its end before its start or
    without any date stays once with nulls (left). Timestamps as bounds are
    compared with midnight of the dates. Column names must differ."""
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    if calendar.schema[date].dataType.typeName() != "date":
        raise ValueError(f"{date} must be a date")
    _distinct_names(intervals, calendar.columns)
    rows = calendar.where(F.col(date).isNotNull())
    dates = rows.select(F.col(date).cast("date").alias("_day")).distinct()
    span = dates.agg(F.min("_day").alias("_lo"), F.max("_day").alias("_hi"))
    every = span.select(F.explode(F.sequence("_lo", "_hi")).alias("_day"))
    # Calendar-sized: one row per day between the first and the last date. A union and an
    # aggregate, as a join would make Spark's estimate of its size a product.
    numbered = (
        dates.withColumn("_hit", F.lit(1))
        .union(every.withColumn("_hit", F.lit(0)))
        .groupBy("_day")
        .agg(F.max("_hit").alias("_hit"))
        .withColumn("_upto", F.sum("_hit").over(Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)))
        .select("_day", (F.col("_upto") - F.col("_hit")).alias("_before"), "_upto", "_hit")
    )
    first, last = span.select("_lo").scalar(), span.select("_hi").scalar()
    from_day = F.to_date(start)
    if _is_timed(intervals, start):
        from_day = F.when(F.col(start) > from_day, F.date_add(from_day, 1)).otherwise(from_day)
    to_day = F.to_date(end)
    inside = (F.col(start) <= F.col(end)) & (from_day <= last) & (to_day >= first)
    bounded = intervals.withColumns(
        {
            "_from": F.when(inside, F.greatest(from_day, first)),
            "_to": F.when(inside, F.least(to_day, last)),
        }
    )
    at_start = numbered.select(F.col("_day").alias("_from"), "_before")
    at_end = numbered.select(F.col("_day").alias("_to"), "_upto")
    placed = bounded.join(at_start, "_from", "left").join(at_end, "_to", "left")
    numbers = F.when(F.col("_upto") > F.col("_before"), F.sequence(F.col("_before") + 1, F.col("_upto")))
    explode = F.explode_outer if how == "left" else F.explode
    matched = placed.select(*intervals.columns, explode(numbers).alias("_number"))
    days = numbered.where("_hit = 1").select(F.col("_upto").alias("_number"), "_day")
    # By number to the date, by date to the calendar's rows: the calendar itself keeps its own size.
    joined = matched.join(days, "_number", how).join(rows, F.col("_day") == F.col(date), how)
    return joined.select(*intervals.columns, *calendar.columns)


def _axis(df: DataFrame, c: str) -> Column:
    """A bound or point as a bigint whose order is the column's."""
    name = df.schema[c].dataType.typeName()
    if name == "date":
        return F.unix_date(c).cast("bigint")
    if name.startswith("timestamp"):
        return F.unix_micros(F.col(c).cast("timestamp"))
    if name in ("byte", "short", "integer", "long"):
        return F.col(c).cast("bigint")
    raise ValueError(f"{c} must be a date, a timestamp or an integer, not {name}")


def interval_join(
    intervals: DataFrame,
    points: DataFrame,
    start: str,
    end: str,
    at: str,
    bin_width: int,
    keys: Sequence[str] = (),
    how: str = "left",
    levels: int = 1,
) -> DataFrame:
    """``intervals LEFT JOIN points ON keys equal AND at BETWEEN start AND
    end`` (``how``: left or inner), all columns of both, ``keys`` once.

    ``bin_width`` is in the bounds' own unit (days of dates, microseconds of
    timestamps, else units); a good one is near a common interval's length. With
    intervals of very unlike lengths, ``levels`` above 1 puts an interval of
    more than 16 bins on bins 16, 256, ... times as wide; every point then is on each
    level once. Results never depend on either. Bounds and points must be
    of one type. Null keys, bounds or points match nothing; an
    interval without a match stays once with nulls (left). Copies stay."""
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    if bin_width < 1 or levels < 1:
        raise ValueError("bin_width and levels must be 1 or more")
    kinds = {intervals.schema[start].dataType, intervals.schema[end].dataType, points.schema[at].dataType}
    if len(kinds) > 1:
        raise ValueError(f"start, end and at must be of one type, not {sorted(k.simpleString() for k in kinds)}")
    keys = list(keys)
    carried = [c for c in points.columns if c not in keys]
    _distinct_names(intervals, carried)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()

    spans = intervals.where(known & (F.col(start) <= F.col(end))).select(*keys, start, end).distinct()
    lo, hi = _axis(intervals, start), _axis(intervals, end)

    level = F.lit(levels - 1)
    for n in reversed(range(levels - 1)):
        level = F.when(_bin(hi, bin_width, n) - _bin(lo, bin_width, n) <= LEVEL_FACTOR, n).otherwise(level)
    widths = [bin_width * LEVEL_FACTOR**n for n in range(levels)]
    width = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in widths]), F.col("_level") + 1)
    binned = (
        spans.withColumn("_level", level.cast("int"))
        .withColumns({"_first": _div(lo, width), "_last": _div(hi, width)})
        .select(*keys, start, end, "_level", F.explode(F.sequence("_first", "_last")).alias("_bin"))
    )
    x = _axis(points, at)
    places = F.array(*[F.struct(F.lit(n).alias("_level"), _bin(x, bin_width, n).alias("_bin")) for n in range(levels)])
    placed = points.where(known & F.col(at).isNotNull()).select(*keys, *carried, F.explode(places).alias("_place"))
    placed = placed.select(*keys, *carried, "_place._level", "_place._bin")
    found = binned.join(placed, [*keys, "_level", "_bin"]).where(F.col(at).between(F.col(start), F.col(end)))
    found = found.select(*keys, start, end, *carried)
    return intervals.join(found, [*keys, start, end], how).select(*intervals.columns, *carried)


def _div(x: Column, width: Column) -> Column:
    """floor(x / width) of bigints (Spark's ``div`` alone cuts towards zero)."""
    return F.call_function("div", x - F.pmod(x, width), width)


def _bin(x: Column, bin_width: int, level: int) -> Column:
    return _div(x, F.lit(bin_width * LEVEL_FACTOR**level).cast("bigint"))


def retention_at(
    history: DataFrame,
    calendar: DataFrame,
    entity: str,
    start: str,
    end: str,
    unit: str = "month",
    date: str = "date",
    period_col: str = "period",
    count_col: str = "cohort_retained",
) -> DataFrame:
    """Distinct entities per completed ``unit``s from their first start to the
    calendar's dates that their intervals cover: ``(period, count)``.
    Intervals covering no date count in period 0, as do null bounds.

    The matches are reduced map-side to one row per (entity, date) with
    the smallest start, so an entity reaches its window as no more rows
    than the calendar has dates, plus one."""
    if unit not in cal.UNITS:
        raise ValueError(f"unit must be one of {cal.UNITS}")
    terms = history.where(F.col(entity).isNotNull()).select(entity, start, end)
    days = calendar.select(F.col(date).alias("_date")).distinct()
    per_date = calendar_join(terms, days, start, end, "_date").groupBy(entity, "_date").agg(F.min(start).alias("_start"))
    first = F.min("_start").over(Window.partitionBy(entity))
    timeline = per_date.select(entity, cal.completed_units(unit, first, F.col("_date")).alias(period_col))
    period = F.coalesce(period_col, F.lit(0).cast("bigint")).alias(period_col)
    return timeline.select(entity, period).groupBy(period_col).agg(F.countDistinct(entity).alias(count_col))


def open_at(
    history: DataFrame,
    calendar: DataFrame,
    entity: str,
    start: str,
    end: str,
    date: str = "date",
    count_col: str = "active",
    ordered: bool = True,
) -> DataFrame:
    """Per date of the calendar the distinct entities with an interval open on
    it: ``(date, count)``; dates without any count 0."""
    days = calendar.where(F.col(date).isNotNull()).select(F.col(date).alias("_date")).distinct()
    terms = history.where(F.col(entity).isNotNull()).select(entity, start, end)
    met = calendar_join(terms, days, start, end, "_date", how="inner").groupBy("_date").agg(
        F.countDistinct(entity).alias("_n")
    )
    out = days.join(met, "_date", "left").select(
        F.col("_date").alias(date), F.coalesce("_n", F.lit(0)).cast("bigint").alias(count_col)
    )
    return order_small(out, date) if ordered else out
