"""Exact distinct counts that merge: bitmaps over dense entity numbers.

A distinct count cannot be added up; the set it counts can. Each set is stored as
bitmaps of 4 KiB for 32,768 entity numbers each, as rows (keys, bucket, bits):
built map-side, merged by OR, counted at the end. Sets by fine keys roll up
to coarse ones without the history, and a new batch is one more OR.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "_bucket", "_bits"


def bitmaps_of(rows: DataFrame, number: str, by: Sequence[str] = ()) -> DataFrame:
    """Sets of the numbers (from 1) per ``by``: (by, ``_bucket``, ``_bits``). Null numbers are in no set."""
    known = rows.where(F.col(number).isNotNull())
    return known.groupBy(*by, F.bitmap_bucket_number(number).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS)
    )


def merged(bitmaps: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """The union of the sets of several tables, per ``by``: fewer keys than the tables have roll them up."""
    parts = [b.select(*by, BUCKET, BITS) for b in bitmaps]
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    return every.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counts(
    bitmaps: DataFrame, by: Sequence[str] = (), count_col: str = "n", without: DataFrame | None = None
) -> DataFrame:
    """Numbers per ``by``, not counting those of the set ``without``
    (``_bucket``, ``_bits``): what is in A and not in R is what A or R has
    beyond R. Keys whose numbers are all left out have no row."""
    sets = merged([bitmaps], by)
    if without is None:
        n = F.bitmap_count(BITS)
    else:
        left_out = without.select(F.col(BUCKET).alias("_b"), F.col(BITS).alias("_r"))
        sets = sets.join(left_out, F.col(BUCKET) == F.col("_b"), "left")
        both = F.explode(F.when(F.col("_r").isNull(), F.array(BITS)).otherwise(F.array(BITS, "_r"))).alias("_x")
        sets = sets.select(*by, BUCKET, "_r", both).groupBy(*by, BUCKET).agg(
            F.bitmap_or_agg("_x").alias(BITS), F.coalesce(F.max(F.bitmap_count("_r")), F.lit(0)).alias("_gone")
        )
        n = F.bitmap_count(BITS) - F.col("_gone")
    out = sets.groupBy(*by).agg(F.sum(n).cast("bigint").alias(count_col))
    return out.where(F.col(count_col) > 0) if by else out.withColumn(count_col, F.coalesce(count_col, F.lit(0).cast("bigint")))
