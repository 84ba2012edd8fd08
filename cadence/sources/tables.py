"""Explicit-schema readers for the input tables and adapters onto the
canonical shapes the operators are written against.

Canonical shapes (column names follow the analyses they come from):

* interval history  ``(id_bioguide, term_start, term_end, state, term_id)``
* entity dimension  ``(id_bioguide, gender)``
* event history     ``(entity_id, event_date)``
* long series       ``(sales_month, kind_of_business, sales)``

Readers never infer schemas; Parquet column pruning and filter pushdown
apply because every adapter selects only the columns it uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions.numeric import cents, from_cents, sum_cents

# Physical schemas of the driver tables that the operators read.
SCHEMAS: dict[str, T.StructType] = {
    "orders": T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.TimestampNTZType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    ),
    "customer": T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_nationkey", T.IntegerType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    ),
    "events": T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    ),
}

# Length of an order's "term" in the interval-history adapter (days).
TERM_DAYS = 730


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; a known schema is applied, never inferred."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name not in SCHEMAS:
        raise ValueError(f"unknown table {name!r}; known are {sorted(SCHEMAS)}")
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def as_date(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(T.DateType())


def interval_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an interval history: customer = entity, order date =
    term start, term start + 730 days = term end, priority = state and
    the order key as a unique tie-break."""
    orders = read_table(spark, sf_dir, "orders")
    start = as_date("o_orderdate")
    return orders.select(
        F.col("o_custkey").alias("id_bioguide"),
        start.alias("term_start"),
        F.date_add(start, TERM_DAYS).alias("term_end"),
        F.col("o_orderpriority").alias("state"),
        F.col("o_orderkey").alias("term_id"),
    )


def entity_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the entity dimension (market segment = attribute)."""
    customer = read_table(spark, sf_dir, "customer")
    return customer.select(
        F.col("c_custkey").alias("id_bioguide"),
        F.col("c_mktsegment").alias("gender"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as plain (entity, event date) pairs."""
    orders = read_table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_custkey").alias("entity_id"), as_date("o_orderdate").alias("event_date")
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click-stream table as (entity, event date) pairs."""
    events = read_table(spark, sf_dir, "events")
    return events.select(F.col("user_id").alias("entity_id"), as_date("ts").alias("event_date"))


def long_series(
    spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Monthly sales per market segment: one row per (month, category); if
    given, only of the months from ``first`` to ``last`` (month starts). These
    bounds are compared with the raw order date, so they reach the scan.

    Amounts are summed exactly in whole cents (``numeric.cents``, equal to
    casting to decimal(18,2) first; ``numeric.sum_cents``), so sums do not
    depend on the order partial sums are combined in, and have no ceiling.

    Plan: orders join customers on the key, then aggregate to (month,
    segment) with map-side partial aggregation, so only the small result
    is shuffled for the aggregate. The join strategy is Spark's size-checked
    choice: a broadcast of the customer side when its estimated size is
    under ``spark.sql.autoBroadcastJoinThreshold`` (no shuffle of orders at
    all), otherwise a sort-merge join with a single shuffle of the projected
    orders, whose skewed partitions (a customer with a large share of all
    orders) AQE splits across tasks (``spark.sql.adaptive.skewJoin``).
    Pre-aggregating per (customer, month) first would add a second shuffle
    of about the same volume whenever customers order at most once a month.
    """
    orders = read_table(spark, sf_dir, "orders")
    if first is not None:
        orders = orders.where(F.col("o_orderdate") >= F.lit(first).cast("date"))
    if last is not None:
        orders = orders.where(F.col("o_orderdate") < F.add_months(F.lit(last).cast("date"), 1))
    customer = read_table(spark, sf_dir, "customer")
    amounts = orders.select(
        F.col("o_custkey").alias("custkey"),
        F.trunc(as_date("o_orderdate"), "month").alias("sales_month"),
        cents("o_totalprice").alias("amount"),
    )
    segments = customer.select(
        F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("kind_of_business")
    )
    return (
        amounts.join(segments, "custkey")
        .groupBy("sales_month", "kind_of_business")
        .agg(from_cents(sum_cents("amount")).alias("sales"))
    )
