"""Histories laid out for pruning and for joins without shuffles.

``write_by_year`` puts a history into one directory per year of its start, each
clustered by entity: a bound on dates reads only the directories it needs, and
a search for some entities only few row groups of a file.

``write_bucketed`` puts tables into equally many buckets by entity. Aggregates,
windows and joins by entity then need no exchange: a history, its dimension
and its kept-up state meet bucket by bucket.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

YEAR = "start_year"


def write_by_year(history: DataFrame, path: str, start: str, entity: str) -> None:
    """Write ``history`` under ``path``, by year of ``start`` and clustered by
    ``entity``; years that are there already are replaced, others stay. Null
    starts have a directory of their own. An entity with very many rows in a
    year is spread by its dates over that year's files."""
    if YEAR in history.columns:
        raise ValueError(f"{YEAR} is the layout's own column")
    dated = history.withColumn(YEAR, F.year(start))
    # Ranges over all years' rows: large years get more files, and no key is one task.
    years = dated.repartitionByRange(YEAR, entity, start).sortWithinPartitions(YEAR, entity, start)
    writer = years.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy(YEAR).parquet(path)


def read_by_year(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    first: str | _dt.date | None = None,
    last: str | _dt.date | None = None,
    start: str = "term_start",
) -> DataFrame:
    """The rows of a history under ``path`` that start from ``first`` to ``last``:
    the bounds prune whole years, and filter within the years at the ends."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(YEAR, T.IntegerType())])).parquet(path)
    lo, hi = (None if d is None else _dt.date.fromisoformat(str(d)) for d in (first, last))
    if lo is not None:
        rows = rows.where((F.col(YEAR) >= lo.year) & (F.col(start) >= F.lit(lo)))
    if hi is not None:
        rows = rows.where((F.col(YEAR) <= hi.year) & (F.col(start) <= F.lit(hi)))
    return rows.drop(YEAR)


def write_bucketed(df: DataFrame, table: str, path: str, entity: str, buckets: int) -> DataFrame:
    """Write ``df`` as the table ``table`` (replaced) under ``path``, in ``buckets``
    buckets by ``entity``, one file each, sorted; returns the table. Tables that
    are to meet need one number of buckets and one type of entity."""
    writer = df.repartition(buckets, entity).write.mode("overwrite").option("path", path)
    writer.option("compression", "zstd").bucketBy(buckets, entity).sortBy(entity).saveAsTable(table)
    return df.sparkSession.table(table)
