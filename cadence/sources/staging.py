"""Tables written between the steps of an operator, where every executor can read them."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def staging_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``. Only a
    ``local[...]`` session, whose driver and executors are one process, may go
    without it and then gets a folder of its own."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {SETTING} to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="cadence-staging-")
    spark.conf.set(SETTING, folder)
    return folder


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet and read back: its rows, and what they say about
    their partitions, are fixed, and a lost executor costs no recomputation.
    The retention of the shared folder clears old tables."""
    path = os.path.join(staging_dir(df.sparkSession), f"{label}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
