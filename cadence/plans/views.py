"""Named results (V1): register any operator output as a temporary view
and drop it again. A view is a named logical plan: every use re-plans it
with the consumer's filters and projections pushed through."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(df: DataFrame, name: str, global_scope: bool = False) -> DataFrame:
    """``create or replace view name as <df>``; returns ``df``."""
    if global_scope:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createOrReplaceTempView(name)
    return df


def drop(spark: SparkSession, name: str, global_scope: bool = False) -> bool:
    """``drop view if exists name``; True when a view was dropped."""
    if global_scope:
        return spark.catalog.dropGlobalTempView(name)
    return spark.catalog.dropTempView(name)


def read(spark: SparkSession, name: str) -> DataFrame:
    """``select * from name``."""
    return spark.table(name)
