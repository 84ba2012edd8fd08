"""Views whose result is kept: monthly partial sums that refresh month by month.

The analyses read one view of monthly sales many times. Kept as partial sums,
one directory a month, it is read instead of scan, join and aggregate. New rows
are added to the months they fall in, changed months are computed anew from
their source, and no other directory is touched.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.numeric import WHOLE, from_cents
from cadence.sources.staging import staged

MONTH = "sales_month"


class MonthlyView:
    """Sums of whole cents and row counts per (month, category) under ``path``."""

    def __init__(self, spark: SparkSession, path: str, category: str = "kind_of_business"):
        self.spark, self.path, self.category = spark, path, category
        self.schema = f"`{category}` string, cents {WHOLE}, rows bigint, {MONTH} date"

    def _partials(self, rows: DataFrame, date: str, cents: str) -> DataFrame:
        month = F.trunc(F.to_date(date), "month").alias(MONTH)
        dated = rows.where(F.col(date).isNotNull())
        return dated.groupBy(F.col(self.category), month).agg(
            F.sum(F.col(cents).cast("decimal(28,0)")).cast(WHOLE).alias("cents"), F.count(F.lit(1)).alias("rows")
        )

    def _write(self, partials: DataFrame) -> None:
        # Calendar-sized: a month's rows, one per category, go to one file.
        months = partials.select(self.category, "cents", "rows", MONTH).repartition(MONTH)
        writer = months.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(MONTH).parquet(self.path)

    def stored(self) -> DataFrame:
        """What is kept: (category, ``cents``, ``rows``, month)."""
        return self.spark.read.schema(self.schema).parquet(self.path)

    def build(self, rows: DataFrame, date: str, cents: str) -> None:
        """Keep the sums of ``rows`` (columns ``date``, ``cents`` and the
        category); months that were kept before and occur in ``rows`` are replaced. Null
        dates are left out, a null category is one of its own."""
        self._write(self._partials(rows, date, cents))

    def add(self, batch: DataFrame, date: str, cents: str) -> list[_dt.date]:
        """Add new rows to the months they fall in; returns these months.
        Only their directories are read and written."""
        new = staged(self._partials(batch, date, cents), "partials")
        months = [r[MONTH] for r in new.select(MONTH).distinct().collect()]  # calendar-sized
        if months:
            both = self.stored().where(F.col(MONTH).isin(months)).unionByName(new)
            merged = both.groupBy(self.category, MONTH).agg(
                F.sum("cents").cast(WHOLE).alias("cents"), F.sum("rows").alias("rows")
            )
            self._write(staged(merged, "merged"))
        return sorted(months)

    def refresh(self, rows: DataFrame, date: str, cents: str, months: Iterable[_dt.date]) -> None:
        """Compute ``months`` (their first days) anew from the source ``rows``,
        whose scan is bounded by them. A month without rows any more is kept empty."""
        wanted = sorted(set(months))
        if not wanted:
            return
        inside = F.lit(False)
        for first, last in _runs(wanted):
            inside = inside | ((F.col(date) >= F.lit(first)) & (F.col(date) < F.lit(last)))
        found = self._partials(rows.where(inside), date, cents)
        asked = self.spark.createDataFrame([(m,) for m in wanted], f"{MONTH} date")
        empty = asked.select(
            F.lit(None).cast("string").alias(self.category),
            F.lit(None).cast(WHOLE).alias("cents"),
            F.lit(0).cast("bigint").alias("rows"),
            MONTH,
        )
        self._write(staged(found.unionByName(empty), "refreshed"))

    def series(self) -> DataFrame:
        """(month, category, ``sales``): what the series operators read."""
        kept = self.stored().where("rows > 0")
        return kept.select(MONTH, self.category, from_cents("cents").alias("sales"))


def _runs(months: list[_dt.date]) -> list[tuple[_dt.date, _dt.date]]:
    """[first day, first day after) of runs of neighbouring months."""
    out: list[tuple[_dt.date, _dt.date]] = []
    for m in months:
        after = _dt.date(m.year + m.month // 12, m.month % 12 + 1, 1)
        if out and out[-1][1] == m:
            out[-1] = (out[-1][0], after)
        else:
            out.append((m, after))
    return out
