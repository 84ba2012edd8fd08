"""Shared helpers: reading tables, written intermediate tables, exact prefix
sums without a single-task window, columns whose names cannot clash."""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Words are maximal runs of characters other than ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder of intermediate tables: the cluster's ``spark.checkpoint.dir``.
    Only a local[...] session, whose driver and executors are one process,
    may go without it and then gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = os.path.join(tempfile.gettempdir(), f"cadence-{os.getuid()}-{os.getpid()}")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut,
    the rows are fixed, and every executor can read them again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def compact(df: DataFrame, label: str) -> DataFrame:
    """``written``, of rows that are narrow beside the documents: in a sixteenth of
    the shuffle's partitions, or one for each core where that is more. A file
    costs a task and, in a local folder, some short-lived processes that set its
    mode; those share the executor's memory and count as much again meanwhile."""
    spark = df.sparkSession
    files = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16)
    return written(df.coalesce(files), label)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its literal name (dots and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def worker_state() -> dict:
    """A dict that lives as long as the worker process: task functions are
    shipped by value, so a module's own globals start anew with each task."""
    name = "_cadence_llm_worker"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__


def tidy(task: Callable) -> Callable:
    """``task`` (for mapInArrow) in a worker process that outlives it: what an
    operator of another module has left in ``worker_state`` goes before it, and what
    it has freed itself goes back to the system after it. An allocator else keeps
    that for the worker's next task, and it counts as the executor's memory even
    while the worker is idle."""
    owner = task.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state()
        if state.get("owner") != owner:
            for name in [name for name in state if not name.startswith("__")]:
                del state[name]
            state["owner"] = owner
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
                trim(0)

    return run


class Shared:
    """A value broadcast by value and unpacked once per worker process.
    ``make`` then builds what the worker keeps with it (caches, say)."""

    def __init__(self, spark: SparkSession, value: object, make: Callable = lambda value: value):
        self.token = uuid.uuid4().hex
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self.make = make

    def get(self) -> object:
        kept = worker_state().setdefault("shared", {})
        if self.token not in kept:
            kept.clear()  # a worker serves one operator at a time
            kept[self.token] = self.make(cloudpickle.loads(self.sent.value))
        return kept[self.token]

    def close(self) -> None:
        """Free the value once everything that reads it is written."""
        self.sent.destroy()


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def with_prefix(df: DataFrame, order: list[Column], sums: dict[str, str], row: str | None = None) -> DataFrame:
    """Add, per entry (new column -> summed column) of ``sums``, the sum over
    all rows that come before in ``order``, and the row number from 0 as
    ``row``. Rows are range-partitioned; per-partition totals (one row per
    partition) give each partition its offset, so no task sees all rows.
    ``order`` should be total for a repeatable result."""
    spark = df.sparkSession
    part, pos = fresh(df, "part_", "pos_")
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(part, F.spark_partition_id())
        .withColumn(pos, F.monotonically_increasing_id())
    )
    fixed = written(ranged, "prefix")
    totals = fixed.groupBy(part).agg(
        F.count(F.lit(1)).alias("n_"), *[F.sum(c).alias(f"t{i}_") for i, c in enumerate(sums.values())]
    )
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(part).alias("p_"),
        F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("n0_"),
        *[F.coalesce(F.sum(f"t{i}_").over(before), F.lit(0)).alias(f"o{i}_") for i in range(len(sums))],
    )
    joined = fixed.join(offsets, fixed[part] == offsets["p_"])
    within = Window.partitionBy(part).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    out = joined.select(
        *[col(c) for c in df.columns],
        *([(F.col("n0_") + F.coalesce(F.count(F.lit(1)).over(within), F.lit(0))).alias(row)] if row else []),
        *[
            (F.col(f"o{i}_") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(name)
            for i, (name, c) in enumerate(sums.items())
        ],
    )
    return out
