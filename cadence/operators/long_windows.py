"""Windows over series of any length: no series, and no key, is one task.

A Spark window sends each partition key to one task; without a key that is
every row. Here a series is ranged once by (keys, order), its ranges are
fixed by writing them, and prefix sums of their row counts number all rows.
Then:

* frames of neighbouring rows (moving sums, lags) run in blocks of a fixed number
  of rows. A block gets, as its *halo*, the last rows of the block before it,
  as many as the frame reaches back. Blocks hold equally many rows whatever
  the keys' sizes are;
* running totals run within ranges, and every range starts from the totals of
  the ranges before it: one row per (range, key) is all that is brought
  together.

Results equal the plain window over (partition by keys order by order), row
for row, for a total order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.sources.staging import staged

ROWS_PER_BLOCK = 1_000_000
# How the total of the ranges before and a range's own total make one.
JOINED = {
    "sum": lambda x, y: x + y,
    "count": lambda x, y: x + y,
    "max": F.greatest,
    "min": F.least,
}


@dataclass(frozen=True)
class Numbered:
    """A series with ``_range`` and ``_row`` (numbers from 0 over all rows in the order of keys, then order)."""

    rows: DataFrame
    columns: tuple[str, ...]
    keys: tuple[str, ...]


def _unlike(df: DataFrame) -> None:
    taken = [c for c in df.columns if c.startswith("_")]
    if taken:
        raise ValueError(f"column names must not begin with an underscore: {taken}")


def numbered(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), ranges: int | None = None) -> Numbered:
    """Range ``df`` by (``keys``, ``order``), nulls last, and number its rows.

    ``order`` should be total within a key (end it with a unique column); rows
    that tie are numbered in an order that is fixed here once and for all.
    Equal sort keys stay in one range; a unique column also spreads equal times. ``ranges`` defaults to Spark's number of
    shuffle partitions. Two columns are added and written with the rows."""
    _unlike(df)
    by = [F.asc_nulls_last(c) for c in (*keys, *order)]
    ranged = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    placed = (
        ranged.sortWithinPartitions(*by)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    fixed = staged(placed, "numbered")
    # One row per range: how many rows lie before it.
    sizes = fixed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # As many rows as there are ranges, never more: safe to broadcast.
    rows = fixed.join(F.broadcast(offsets), "_range").withColumn("_row", F.col("_offset") + F.col("_place"))
    return Numbered(rows.select(*df.columns, "_range", "_row"), tuple(df.columns), tuple(keys))


def _blocks(series: Numbered, reach: int, rows_per_block: int) -> DataFrame:
    """Rows with ``_block``; the last ``reach`` rows of a block are in the next one too, as ``_halo``."""
    size = max(rows_per_block, reach, 1)
    block = F.call_function("div", F.col("_row"), F.lit(size))
    own = F.struct(block.alias("_block"), F.lit(False).alias("_halo"))
    lent = F.struct((block + 1).alias("_block"), F.lit(True).alias("_halo"))
    places = F.when(F.col("_row") % size >= size - reach, F.array(own, lent)).otherwise(F.array(own))
    return series.rows.select(*series.columns, "_row", F.explode(places).alias("_at")).select(
        *series.columns, "_row", "_at._block", "_at._halo"
    )


def _frames(
    series: Numbered, reach: int, made: Mapping[str, Column], window: Window, rows_per_block: int
) -> DataFrame:
    out = _blocks(series, reach, rows_per_block).select(
        *series.columns, "_halo", *[c.over(window).alias(name) for name, c in made.items()]
    )
    return out.where(~F.col("_halo")).drop("_halo")


def moving(
    series: Numbered,
    columns: Mapping[str, str],
    rows: int,
    sum_fmt: str = "{label}_moving_sum",
    count_fmt: str = "{label}_moving_count",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """All columns, and per ``label -> column`` the sum and the count of
    non-null values over the row and the ``rows`` - 1 rows before it in its
    key's series. Sums of whole numbers are exact; divide as needed."""
    if rows < 1:
        raise ValueError("rows must be 1 or more")
    frame = Window.partitionBy("_block", *series.keys).orderBy("_row").rowsBetween(1 - rows, Window.currentRow)
    made = {}
    for label, c in columns.items():
        made[sum_fmt.format(label=label)] = F.sum(c)
        made[count_fmt.format(label=label)] = F.count(c)
    return _frames(series, rows - 1, made, frame, rows_per_block)


def lagged(
    series: Numbered, columns: Mapping[str, str], rows: int = 1, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """All columns, and per ``name -> column`` its value ``rows`` rows before
    in the key's series (null where there is none)."""
    if rows < 1:
        raise ValueError("rows must be 1 or more")
    frame = Window.partitionBy("_block", *series.keys).orderBy("_row")
    return _frames(series, rows, {name: F.lag(c, rows) for name, c in columns.items()}, frame, rows_per_block)


def running(
    series: Numbered,
    columns: Mapping[str, str],
    how: Sequence[str] = ("sum",),
    reset: Sequence[str] = (),
    fmt: str = "{label}_running_{how}",
) -> DataFrame:
    """All columns, and per ``label -> column`` and each of ``how`` (sum,
    count, max, min) the running total from the first row of the key's series
    to this one.

    ``reset`` names columns that have totals of their own for each of their
    values (the year, for totals to date). Nulls are passed over: a sum of
    nulls only is null, a count 0."""
    if not how or set(how) - set(JOINED):
        raise ValueError(f"how must be of {sorted(JOINED)}")
    group = [*series.keys, *reset]
    made = [(fmt.format(label=label, how=h), h, c) for label, c in columns.items() for h in how]
    totals = series.rows.groupBy("_range", *group).agg(
        *[getattr(F, h)(c).alias(f"_t{i}") for i, (_, h, c) in enumerate(made)]
    )
    # One row per (range, key): small beside the rows.
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col("_range").alias("_r"),
        *[F.col(g).alias(f"_g{j}") for j, g in enumerate(group)],
        *[(F.sum if h == "count" else getattr(F, h))(f"_t{i}").over(before).alias(f"_b{i}") for i, (_, h, _) in enumerate(made)],
    )
    same = F.col("_range") == F.col("_r")
    for j, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{j}"))
    within = Window.partitionBy("_range", *group).orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = []
    for i, (name, h, c) in enumerate(made):
        own, start = getattr(F, h)(c).over(within), F.col(f"_b{i}")
        out.append(F.coalesce(JOINED[h](own, start), own, start).alias(name))
    return series.rows.join(starts, same).select(*series.columns, *out)
