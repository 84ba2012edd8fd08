"""Exact top-k search by distributed histogram selection.

Vectors become integers, scores are integer inner products. Every row is
scored against a block of queries; tasks report, per query, histograms of the
scores that could still matter (those from the task's own k-th best up), which
are summed. The histogram's bin that holds the global k-th score is refined
until it is a single score. A last pass keeps what lies above it, and of the
rows that tie with it the smallest ids, at most k per query and task.

Queries come in blocks of ``query_block`` rows (a stated query set against all
rows); a block travels to the tasks, which hold one block of scores at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Shared, col, written

SCORES = 1 << 22  # scores held at once in a task
FIRST_BITS = 12  # the first histogram's bins are this many bits wide


def integer_vectors(df: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """(``vec_id`` long, ``v`` array of long) with floor(scale * x) of each
    component as double; rows that have a null id, vector or component, or a
    component that is not finite, take no part."""
    whole = F.transform(col(vector), lambda x: x.cast("double"))
    fine = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(col(vec_id).isNotNull() & col(vector).isNotNull() & fine).select(
        col(vec_id).cast("long").alias("vec_id"),
        F.transform(whole, lambda x: F.floor(x * F.lit(float(scale)))).alias("v"),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _scored(batches: Iterator[pa.RecordBatch], queries: np.ndarray, largest: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores by query) of blocks of rows. Products run in floating
    point where every sum is exact there, else in 64-bit integers."""
    dim = queries.shape[1]
    bound = largest * float(np.abs(queries).max(initial=0)) * dim
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    left = queries.astype(kind)
    step = max(1, SCORES // max(1, len(queries)))
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ids, rows = batch["vec_id"].to_numpy(zero_copy_only=False), _matrix(batch["v"])
        if rows.shape[1] != dim:
            raise ValueError("vectors of one search must have one length")
        for lo in range(0, len(ids), step):
            yield ids[lo : lo + step], left @ rows[lo : lo + step].astype(kind).T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``scores`` (queries by candidates) the k first by score
    descending, then id; ``ids`` ascending or as wide as ``scores``."""
    n = scores.shape[1]
    if ids.ndim == 1:
        ids = np.broadcast_to(ids, scores.shape)
    if n > 4 * k:
        kth = np.partition(scores, n - k, axis=1)[:, n - k]
        above = scores >= kth[:, None]
        wide = int(above.sum(axis=1).max())
        if wide <= n // 2:
            # The few at or above the k-th score, moved to the left.
            order = np.argsort(~above, axis=1, kind="stable")[:, :wide] if wide > 4 * k else None
            if order is None:
                q, c = np.nonzero(above)
                at = np.arange(len(q)) - np.repeat(np.searchsorted(q, np.arange(len(scores))), np.bincount(q, minlength=len(scores)))
                s = np.full((len(scores), wide), -np.inf if scores.dtype.kind == "f" else np.iinfo(np.int64).min, dtype=scores.dtype)
                i = np.full((len(scores), wide), np.iinfo(np.int64).max)
                s[q, at], i[q, at] = scores[q, c], ids[q, c]
                scores, ids = s, i
            else:
                scores, ids = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: float = 256.0,
    query_block: int = 1 << 13,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: per row of
    ``queries`` the k highest scores among the rows of ``vectors`` other than
    itself (all, if fewer), ties to the smaller id.

    ``queries`` holds rows of ``vectors``; each leaves out one row that has
    its id and score with itself. Rows with a null id or vector, or a null or
    non-finite component, take no part. Repeated rows are candidates, and
    queries, each. Empty tables give an empty result; other columns are
    ignored."""
    spark = vectors.sparkSession
    rows = written(integer_vectors(vectors, vec_id, vector, scale), "vectors")
    asked = written(
        integer_vectors(queries, vec_id, vector, scale).groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("times")),
        "queries",
    )
    largest = float(rows.agg(F.max(F.array_max(F.transform("v", F.abs))).alias("m")).first()["m"] or 0)
    total = asked.count()
    out = None
    blocks = max(1, -(-total // query_block))
    for b in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)) == b).orderBy("vec_id", "v").collect()
        if not mine:
            continue
        found = _search_block(rows, mine, largest, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return out


def _search_block(rows: DataFrame, mine: list, largest: float, k: int) -> DataFrame:
    spark = rows.sparkSession
    matrix = np.array([r["v"] for r in mine], dtype=np.int64).reshape(len(mine), -1)
    q_ids = np.array([r["vec_id"] for r in mine])
    # One more than k, as a query's own row is taken out at the end.
    need = k + 1

    def histogram(prefix: np.ndarray | None, bits: int) -> np.ndarray:
        """Bin (score >> bits) that holds each query's ``need``-th score; the
        smallest bin there is where fewer rows exist. With ``prefix`` (the
        coarser bins already found) only scores in or above them count."""
        sent = Shared(spark, (matrix, prefix))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            queries, prefix = sent.get()
            best: np.ndarray | None = None
            for ids, scores in _scored(batches, queries, largest):
                top, _ = _best(scores, ids, need)
                best = top if best is None else _best(np.concatenate([best, top], axis=1), np.zeros(top.shape[1] + best.shape[1], np.int64), need)[0]
            if best is None:
                return
            bins = best.astype(np.int64) >> bits
            q = np.repeat(np.arange(len(bins)), bins.shape[1])
            flat = bins.ravel()
            if prefix is not None:
                at = (flat << bits) >> FIRST_BITS >= prefix[q]
                q, flat = q[at], flat[at]
            pairs, counts = np.unique(np.c_[q, flat], axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(counts.astype(np.int64))], names=["q", "bin", "n"]
            )

        bins = rows.mapInArrow(count, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        above = Window.partitionBy("q").orderBy(F.col("bin").desc())
        kth = (
            bins.withColumn("upto", F.sum("n").over(above))
            .groupBy("q")
            .agg(F.coalesce(F.max(F.when(F.col("upto") >= need, F.col("bin"))), F.min("bin")).alias("bin"))
            .collect()
        )
        edge = np.zeros(len(matrix), dtype=np.int64)
        for r in kth:
            edge[r["q"]] = r["bin"]
        return edge

    coarse = histogram(None, FIRST_BITS)
    edge = histogram(coarse, 0)
    sent = Shared(spark, (matrix, edge))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, edge = sent.get()
        best = None
        for ids, scores in _scored(batches, queries, largest):
            order = np.argsort(ids, kind="stable")
            top = _best(scores[:, order], ids[order], need)
            best = top if best is None else _best(*[np.concatenate(x, axis=1) for x in zip(best, top)], need)
        if best is None:
            return
        s, i = best
        s = s.astype(np.int64)
        at = s >= edge[:, None]
        q = np.nonzero(at)[0]
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i[at]), pa.array(s[at])], names=["q", "vec_id", "score"])

    first = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    ranked = rows.mapInArrow(keep, "q long, vec_id long, score long").withColumn("place", F.row_number().over(first))
    own = (matrix * matrix).sum(axis=1)
    queries = spark.createDataFrame(
        [(i, int(q_ids[i]), int(own[i]), int(r["times"])) for i, r in enumerate(mine)],
        "q_ long, query_id long, self_ long, times long",
    )
    joined = ranked.join(queries, ranked["q"] == F.col("q_"))
    # The first row that has the query's id and its score with itself is its own.
    mine_ = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("self_"))
    own_at = F.min(F.when(mine_, F.col("place"))).over(Window.partitionBy("q"))
    rest = joined.withColumn("own_at", F.coalesce(own_at, F.lit(need + 1))).where(F.col("place") != F.col("own_at"))
    rank = (F.col("place") - F.when(F.col("place") > F.col("own_at"), 1).otherwise(0)).cast("int")
    return (
        rest.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .withColumn("copy_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        .select("query_id", "rank", "vec_id", "score")
    )
