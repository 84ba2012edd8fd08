"""Exact hot-key splitting for joins of many rows per key to one row per key.

AQE splits skewed sort-merge-join partitions only when both join inputs
are plain shuffle stages; a per-key aggregate joined back to the rows it
was computed from is not (its output is already partitioned by the key),
so a key holding a third of all rows would land in a single task. This
module splits such keys explicitly:

* the per-key side carries the key's row count ``n``;
* the ``MOST_HOT`` largest keys with ``n > rows_per_task`` are *hot*; they
  get ``ceil(n / rows_per_task)`` buckets. The (key, buckets) table is
  broadcast; it holds ``MOST_HOT`` rows at most. A key beyond them has at
  most ``total_rows / MOST_HOT`` rows, a small share of any input, and stays
  in one task (the result is the same);
* every row of a hot key is assigned a bucket from a hash of the row's own
  values (deterministic, so a re-executed task after an executor loss
  produces the same assignment); rows of other keys use bucket 0;
* the per-key row is replicated once per bucket, and the join runs on
  (key, bucket): a hot key's rows spread over its buckets' tasks.

Identical rows hash to the same bucket, so callers pass distinct rows
(collapsing duplicates map-side into a multiplicity column beforehand,
as ``cohort.expand_to_spine`` does) and restore copies afterwards.

Nothing is dropped or sampled; the result equals the plain equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET = "_bucket"
ROWS_PER_TASK = 1_000_000
MOST_HOT = 10_000


def split_join(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    count_col: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Inner join ``rows`` (any number per key) to ``per_key`` (one row per
    key, with its row count in ``count_col``) on ``key``, splitting hot
    keys across ``ceil(count / rows_per_task)`` tasks. ``count_col`` is not
    part of the output."""
    buckets = F.greatest(F.lit(1), F.ceil(F.col(count_col) / F.lit(rows_per_task))).cast("int")
    hot = (
        per_key.where(F.col(count_col) > rows_per_task)
        .orderBy(F.col(count_col).desc(), key)
        .limit(MOST_HOT)
        .select(key, buckets.alias("_buckets"))
    )
    tagged = rows.join(F.broadcast(hot), key, "left")
    bucket = F.when(F.col("_buckets").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.col("_buckets"))
    )
    left = tagged.select(*rows.columns, bucket.cast("int").alias(BUCKET))
    known = per_key.join(F.broadcast(hot), key, "left")
    right = known.select(
        *[c for c in per_key.columns if c != count_col],
        F.explode(F.sequence(F.lit(0), F.coalesce("_buckets", F.lit(1)) - 1)).alias(BUCKET),
    )
    return left.join(right, [key, BUCKET]).drop(BUCKET)
