"""Final ordering of results.

Results keyed by calendar periods (years, months, periods since a first
event) have a size fixed by the calendar, never by the input volume. They
are sorted in one partition: ``repartition(1)`` moves the finished result
(a few hundred rows) into a single partition, which satisfies the sort's
distribution, so there is no range-partitioning exchange and no sampling
job. It is a shuffle rather than ``coalesce(1)`` on purpose: a coalesce is
narrow and would also pull the stage that computes the result (e.g. the
final aggregate reading every partial aggregate) into one task. Results
that grow with the data (one row per entity) use the distributed
``orderBy``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_small(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Sort a calendar-bounded result (NULLs last, as in PostgreSQL)."""
    keys = [F.asc_nulls_last(c) if isinstance(c, str) else c for c in cols]
    return df.repartition(1).orderBy(*keys)
