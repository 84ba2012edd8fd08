"""Cohort and retention operators.

Vocabulary: an *entity* (customer, member, user) has a history of events
or of intervals (start, end). Its *cohort* is derived from its first
event: the first date itself, its year or century, the attribute of the
first interval, or an attribute from a separate dimension table. The
*period* of an event is the number of completed units (years by default)
from the entity's first event to it.

Plan shape (why it holds at scale)
----------------------------------
* First events are a ``groupBy(entity).agg(min)``: partial aggregation
  combines map-side, so a hot entity costs one row per map task.
* Before any per-entity step the history is reduced, map-side combined,
  to distinct ``(entity, date)`` rows (R2/R4) or to one row per
  ``(entity, covered year)`` (R7-R16). The calendar bounds how many such
  rows one entity can have, so no task ever receives an unbounded group
  even if one entity holds a third of all rows.
* The interval-to-calendar range join is replaced by exploding each
  interval into the years whose Dec 31 it covers (``covered_years``): one row
  per covered year instead of a nested-loop join against a day table.
* ``count(distinct entity)`` runs on data already hash-partitioned by the
  entity, so its de-duplication step needs no extra shuffle; the final
  count per (cohort, period) is again partially aggregated.
* Windows that compute cohort sizes run on the per-(cohort, period)
  result, whose size is bounded by cohorts x periods, not by the data.
* The one operator that must keep every history row (R6) joins the
  per-entity first date back with ``skew.split_join``, which spreads an
  entity with very many rows over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import calendar as cal
from cadence.functions import numeric as num
from cadence.functions.ordering import order_small
from cadence.operators import skew

# Copies of one interval that one row stands for, at most.
COPIES_PER_CHUNK = 1 << 16


def _asc(c: str) -> Column:
    # PostgreSQL (and DuckDB) sort NULLs last ascending; Spark first.
    return F.asc_nulls_last(c)


# ---------------------------------------------------------------- R1, R12
def first_event(
    history: DataFrame, entity: str, ts: str, first_col: str = "first_term", ordered: bool = True
) -> DataFrame:
    """Earliest ``ts`` per entity: ``(entity, first_col)``. Rows without
    an entity form a group of their own."""
    out = history.groupBy(entity).agg(F.min(ts).alias(first_col))
    return out.orderBy(_asc(first_col), _asc(entity)) if ordered else out


def first_attribute(
    history: DataFrame,
    entity: str,
    ts: str,
    attribute: str,
    tiebreak: str,
    first_col: str = "first_term",
    attr_col: str | None = None,
) -> DataFrame:
    """One row per entity with its first date and the attribute of
    its earliest row; ties on the date are broken by ``tiebreak`` (a
    unique key), which makes the result deterministic."""
    attr_col = attr_col or f"first_{attribute}"
    # The smallest (start-is-NULL, start, tiebreak, attribute) struct is the
    # first row: NULL starts sort last as in PostgreSQL, the unique tiebreak
    # settles equal starts. One aggregate, combined map-side.
    first_row = F.min(F.struct(F.col(ts).isNull(), F.col(ts), F.col(tiebreak), F.col(attribute)))
    return (
        history.groupBy(entity)
        .agg(F.min(ts).alias(first_col), first_row.alias("_first_row"))
        .select(entity, first_col, F.col("_first_row")[attribute].alias(attr_col))
    )


# ---------------------------------------------------------------- R2, R4
def retention_counts(
    history: DataFrame,
    entity: str,
    ts: str,
    unit: str = "year",
    period_col: str = "period",
    count_col: str = "cohort_retained",
    ordered: bool = False,
) -> DataFrame:
    """Distinct entities per completed ``unit``s since their first
    event: ``(period, count)``. A NULL event date forms a NULL period.

    For a timestamp column years and months also need the time of day to be
    reached; weeks and days count dates. Its history is reduced to one row per
    (entity, date) with the earliest and latest time: between two times of one
    date at most one year or month is completed, so these two decide all
    periods of that date."""
    if unit not in cal.UNITS:
        raise ValueError(f"unit must be one of {cal.UNITS}")
    dated = history.where(F.col(entity).isNotNull()).select(entity, ts)
    timed = dated.schema[ts].dataType.typeName().startswith("timestamp")
    w = Window.partitionBy(entity)
    if timed and unit in ("year", "month"):
        days = dated.groupBy(entity, F.to_date(ts).alias("_day")).agg(
            F.min(ts).alias("_lo"), F.max(ts).alias("_hi")
        )
        first = F.min("_lo").over(w)
        both = F.array(*[cal.completed_units(unit, first, F.col(c), timed=True) for c in ("_lo", "_hi")])
        timeline = days.select(entity, both.alias("_both")).select(
            entity, F.explode(F.array_distinct("_both")).alias(period_col)
        )
    else:
        # Distinct (entity, date): bounded rows per entity before the window.
        days = dated.select(entity, F.to_date(ts).alias(ts) if timed else F.col(ts)).distinct()
        first = F.min(ts).over(w)
        timeline = days.select(entity, cal.completed_units(unit, first, F.col(ts)).alias(period_col))
    out = timeline.groupBy(period_col).agg(F.countDistinct(entity).alias(count_col))
    return order_small(out, period_col) if ordered else out


# ---------------------------------------------------------------- R3, R8, R10
def retention_curve(
    counts: DataFrame,
    by: Sequence[str] = (),
    period_col: str = "period",
    count_col: str = "cohort_retained",
    size_col: str = "cohort_size",
    pct_col: str = "pct_retained",
    digits: int | None = 2,
) -> DataFrame:
    """Add the cohort size (count at the lowest present period of the
    cohort) and the retained share, rounded to ``digits`` or unrounded
    (``None``), both as double.

    ``counts`` has one row per (cohort, period), so the window's input is
    bounded by cohorts x periods.
    """
    w = Window.partitionBy(*by).orderBy(_asc(period_col)) if by else Window.orderBy(_asc(period_col))
    size = F.first(count_col).over(w)
    if digits is None:
        pct = num.double_ratio(count_col, size)
    else:
        pct = num.round_div(count_col, size, digits, integral=True)
    return counts.select(
        *by, period_col, size.alias(size_col), count_col, pct.alias(pct_col)
    )


# ---------------------------------------------------------------- R5
def retention_pivot(
    curve: DataFrame,
    periods: Sequence[int] = (0, 2, 4, 6),
    period_col: str = "period",
    size_col: str = "cohort_size",
    pct_col: str = "pct_retained",
    prefix: str = "yr_",
) -> DataFrame:
    """A single row with the cohort size and the share retained at
    each of ``periods`` (NULL when the period is absent)."""
    cells = [
        F.max(F.when(F.col(period_col) == p, F.col(pct_col))).alias(f"{prefix}{p}") for p in periods
    ]
    return curve.agg(F.max(size_col).alias(size_col), *cells)


# ---------------------------------------------------------------- R6
def expand_to_spine(
    history: DataFrame,
    entity: str,
    start: str,
    end: str,
    spine_from: str | None = None,
    spine_to: str | None = None,
    first_col: str = "first_term",
    date_col: str = "date",
    period_col: str = "period",
    rows_per_task: int = skew.ROWS_PER_TASK,
) -> DataFrame:
    """Every interval joined to its first-event date and expanded to
    each year end inside [start, end] (and inside the spine bounds). An
    interval covering no year end yields one row with NULL date and period.

    The output keeps every interval row (duplicates included), so the
    per-entity first date has to reach every row. Identical intervals are
    first collapsed map-side into one row with a multiplicity, which is cut
    into chunks of at most ``COPIES_PER_CHUNK`` copies. The chunks are joined
    to the first dates with ``skew.split_join`` (an entity with more than
    ``rows_per_task`` rows is spread over several tasks, one much repeated
    interval included), and each chunk's copies are restored at the end by a
    narrow explode.
    """
    distinct_terms = (
        history.where(F.col(entity).isNotNull())
        .groupBy(entity, start, end)
        .agg(F.count(F.lit(1)).alias("_mult"))
    )
    first = distinct_terms.groupBy(entity).agg(F.min(start).alias(first_col), F.sum("_mult").alias("_n"))
    # Copies travel as chunks of bounded size, which the join deals over tasks.
    chunk = min(COPIES_PER_CHUNK, rows_per_task)
    last = F.expr(f"(_mult - 1) div {chunk}")
    chunks = distinct_terms.select(
        entity, start, end, "_mult", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_chunk")
    ).withColumn("_mult", F.least(F.lit(chunk).cast("long"), F.col("_mult") - F.col("_chunk") * chunk))
    joined = skew.split_join(chunks, first, entity, "_n", rows_per_task)
    years = cal.covered_years(F.col(start), F.col(end), spine_from, spine_to)
    exploded = joined.select(
        entity, first_col, start, end, "_mult", F.explode_outer(years).alias("_y")
    ).select(entity, first_col, start, end, "_y", F.explode(F.sequence(F.lit(1), F.col("_mult"))))
    d = cal.year_end("_y")
    return exploded.select(
        entity,
        first_col,
        start,
        end,
        d.alias(date_col),
        cal.completed_units("year", F.col(first_col), d).alias(period_col),
    )


# ---------------------------------------------------------------- R7, R9, R11, R13-R16
def interval_retention_counts(
    history: DataFrame,
    entity: str,
    start: str,
    end: str,
    by: Sequence[str] = (),
    *,
    attribute: str | None = None,
    tiebreak: str | None = None,
    attr_col: str | None = None,
    dimension: DataFrame | None = None,
    dimension_cols: Sequence[str] = (),
    cohort_from: str | None = None,
    cohort_to: str | None = None,
    spine_from: str | None = None,
    spine_to: str | None = None,
    derived: dict[str, Column] | None = None,
    first_col: str = "first_term",
    period_col: str = "period",
    count_col: str = "cohort_retained",
) -> DataFrame:
    """R7 and its keyed forms: distinct entities per (cohort keys, period)
    where a period is the completed years from the entity's first start to
    a year end its intervals cover; intervals covering none count in
    period 0.

    ``by`` lists the cohort key columns, taken from: ``derived`` (name ->
    expression over ``first_col`` / ``attr_col``, e.g. year or century of
    the first date), the first-interval attribute (``attribute`` with
    ``tiebreak``) and ``dimension`` (one row per entity, joined on the
    entity key; entities without a dimension row drop out).
    ``cohort_from``/``cohort_to`` restrict cohorts by first start date.

    Every interval is exploded to the years it covers (one covering none
    keeps one NULL-year row) and reduced map-side, in a hash aggregate, to one
    row per (entity, year) with the smallest start. Every interval lands in
    some (entity, year) row, so a window over the entity's rows -- at most one
    per calendar year plus one, however many intervals the entity has --
    yields its first start without a self-join. A first attribute comes from
    the unexploded rows, reduced to one row per entity, and joins by entity,
    as which both sides are already partitioned.
    """
    if attribute is not None and tiebreak is None:
        raise ValueError("a unique tiebreak column is required with an attribute")
    attr_col = attr_col or (f"first_{attribute}" if attribute else None)
    h = history.where(F.col(entity).isNotNull())
    years = cal.covered_years(F.col(start), F.col(end), spine_from, spine_to)
    # Fixed-width buffers only over the exploded rows: a hash aggregate.
    per_year = h.select(entity, start, F.explode_outer(years).alias("_y")).groupBy(entity, "_y").agg(
        F.min(start).alias("_min_start")
    )
    w = Window.partitionBy(entity)
    timeline = per_year.select(entity, "_y", F.min("_min_start").over(w).alias(first_col))
    if attribute:
        # The first row's attribute comes from the rows before they are exploded, one row per entity.
        firsts = first_attribute(h, entity, start, attribute, tiebreak, "_first", attr_col)
        timeline = timeline.join(firsts.select(entity, attr_col), entity)
    if cohort_from is not None or cohort_to is not None:
        cond = F.lit(True)
        if cohort_from is not None:
            cond = cond & (F.col(first_col) >= cal.lit_date(cohort_from))
        if cohort_to is not None:
            cond = cond & (F.col(first_col) <= cal.lit_date(cohort_to))
        timeline = timeline.where(cond)
    for name, expr in (derived or {}).items():
        timeline = timeline.withColumn(name, expr)
    if dimension is not None:
        dim = dimension.select(entity, *dimension_cols).where(F.col(entity).isNotNull())
        timeline = timeline.join(dim, entity)
    period = F.coalesce(
        cal.completed_units("year", F.col(first_col), cal.year_end("_y")), F.lit(0).cast("bigint")
    )
    return (
        timeline.select(entity, *by, period.alias(period_col))
        .groupBy(*by, period_col)
        .agg(F.countDistinct(entity).alias(count_col))
    )
