"""Readers for the canonical tables the analyses are written against, for
users who hold them directly (rather than the test analogs).

Schemas are explicit (never inferred); Parquet and CSV (with a header
row) are supported. Column names are those the operators default to, so
for example ``cohort.interval_retention_counts(read(spark,
"legislators_terms", path), "id_bioguide", "term_start", "term_end")``
runs as is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMAS: dict[str, T.StructType] = {
    # one row per (month, category)
    "retail_sales": T.StructType(
        [
            T.StructField("sales_month", T.DateType(), False),
            T.StructField("kind_of_business", T.StringType(), False),
            T.StructField("sales", T.DecimalType(18, 2), True),
        ]
    ),
    # one row per (entity, interval)
    "legislators_terms": T.StructType(
        [
            T.StructField("id_bioguide", T.StringType(), False),
            T.StructField("term_start", T.DateType(), False),
            T.StructField("term_end", T.DateType(), False),
            T.StructField("state", T.StringType(), True),
            T.StructField("term_id", T.StringType(), True),
        ]
    ),
    # one row per entity
    "legislators": T.StructType(
        [
            T.StructField("id_bioguide", T.StringType(), False),
            T.StructField("gender", T.StringType(), True),
        ]
    ),
    # one row per (entity, event)
    "events": T.StructType(
        [
            T.StructField("entity_id", T.StringType(), False),
            T.StructField("event_date", T.DateType(), False),
        ]
    ),
}


def read(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Read canonical table ``name`` from ``path`` (``fmt``: parquet or csv)."""
    if name not in SCHEMAS:
        raise ValueError(f"unknown canonical table {name!r}; known: {sorted(SCHEMAS)}")
    reader = spark.read.schema(SCHEMAS[name])
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "csv":
        return reader.option("header", "true").option("mode", "FAILFAST").csv(path)
    raise ValueError("fmt must be 'parquet' or 'csv'")
