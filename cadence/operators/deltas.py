"""Trailing ranges on fine spines by event deltas.

The sum over all values of the last year, for every day, needs no row per
(value, day): a value adds itself on the day it enters the range and takes
itself away on the day it leaves it. Two rows per value, summed map-side per
day, and one running sum over the spine give every day's total and count. What is
shuffled does not depend on the width of the range, and the running sum
sees the spine's rows only (one per day and series, set by the bounds).

Sums are of whole numbers (cents, say), so that what leaves a range cancels
exactly what entered it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import calendar as cal

WHOLE = ("byte", "short", "integer", "long", "decimal")


def leaves_after_days(entered: Column, days: int) -> Column:
    """First day d on which ``entered`` is not in (d - ``days``, d]."""
    return F.date_add(entered, days)


def leaves_after_months(entered: Column, months: int) -> Column:
    """First day d with d - ``months`` months > ``entered``, where months back
    from a day that the target month lacks end on its last day."""
    after = F.date_add(entered, 1)
    there = F.add_months(after, months)
    return F.when(F.dayofmonth(there) == F.dayofmonth(after), there).otherwise(F.date_add(there, 1))


def trailing_range(
    values: DataFrame,
    date: str,
    columns: Mapping[str, str],
    first: str,
    last: str,
    days: int | None = None,
    months: int | None = None,
    keys: Sequence[str] = (),
    date_col: str = "date",
    sum_fmt: str = "{label}_sum",
    count_fmt: str = "{label}_count",
    mean_fmt: str = "{label}_mean",
) -> DataFrame:
    """For every day d of the spine [``first``, ``last``] and every series
    (``keys``; series are those with a value that reaches the spine): sum,
    count and mean of the non-null values of each ``label -> column`` whose
    date lies in the trailing range. That is (d - ``days``, d] or, with ``months``,
    [d - ``months`` months, d]. Give one of the two.

    Values from before the spine count while they are in range; days without
    any value have a count of 0 and null sum and mean. Null dates are left
    out; null keys are a series. Without keys, the spine is there even if
    there is no value. Columns must be of whole numbers or decimals. The mean
    is the double quotient of sum and count."""
    if (days is None) == (months is None) or (days is not None and days < 1) or (months is not None and months < 0):
        raise ValueError("give days (1 or more) or months (0 or more)")
    for c in columns.values():
        if values.schema[c].dataType.typeName() not in WHOLE:
            raise ValueError(f"{c} must be of whole numbers or decimals, so that sums are exact")
    keys = list(keys)
    lo, hi = cal.lit_date(first), cal.lit_date(last)
    entered = F.to_date(date)
    left = leaves_after_days(entered, days) if days is not None else leaves_after_months(entered, months)
    # The raw dates are bounded on their own, so that the bounds reach the scan.
    reach = F.date_sub(lo, days - 1) if days is not None else F.add_months(lo, -months)
    near = values.where((F.col(date) < F.date_add(hi, 1)) & (F.col(date) >= reach))
    names = {label: (f"_s{i}", f"_n{i}") for i, label in enumerate(columns)}
    parts = []
    for label, c in columns.items():
        s, n = names[label]
        parts += [F.col(c).alias(s), F.col(c).isNotNull().cast("bigint").alias(n)]
    flat = [x for pair in names.values() for x in pair]
    moments = F.array(
        F.struct(F.greatest(entered, lo).alias("_day"), F.lit(1).alias("_sign")),
        F.struct(left.alias("_day"), F.lit(-1).alias("_sign")),
    )
    per_day = (
        near.where(left > lo)
        .select(*keys, *parts, F.explode(moments).alias("_at"))
        .where(F.col("_at._day") <= hi)
        .groupBy(*keys, F.col("_at._day").alias("_day"))
        .agg(*[F.sum(F.col(x) * F.col("_at._sign")).alias(x) for x in flat])
    )
    spine = F.explode(F.sequence(lo, hi)).alias("_day")
    if keys:
        series = per_day.select(*keys).distinct().select(*keys, spine)
        same = F.col("a._day") == F.col("b._day")
        for k in keys:
            same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        dense = series.alias("a").join(per_day.alias("b"), same, "left")
        dense = dense.select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col("a._day"), *[F.col(f"b.{x}") for x in flat])
    else:
        dense = values.sparkSession.range(1).select(spine).join(per_day, "_day", "left")
    run = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out: list[Column] = [*map(F.col, keys), F.col("_day").alias(date_col)]
    for label in columns:
        s, n = (F.coalesce(F.sum(x).over(run), F.lit(0)) for x in names[label])
        total = F.when(n > 0, s)
        out += [
            total.alias(sum_fmt.format(label=label)),
            n.cast("bigint").alias(count_fmt.format(label=label)),
            F.try_divide(total.cast("double"), n).alias(mean_fmt.format(label=label)),
        ]
    return dense.select(*out)
