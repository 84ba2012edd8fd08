"""Importance resampling of documents towards a target distribution.

Features are all runs of 1 to ``width`` consecutive words, hashed by CRC-32
into ``buckets``. A bucket's gain is the log ratio of its smoothed share among
the target's features and among the documents'. A document's weight is the sum
of its features' gains; seeded Gumbel noise added to it turns "highest scores"
into a draw without replacement.

CRC-32 is linear over XOR: byte ``b`` with ``d`` bytes after it always adds
``POSITIONS[d, b]``, and a message of ``n`` bytes adds a constant of its length.
So the checksums of all features of a chunk are one gather from that table and
one ``bitwise_xor.reduceat`` over the features' spans. Spans longer than
``BLOCK`` fold blockwise: the register so far enters the next block as if it
were XORed to that block's first four bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .common import Shared, col, fresh, with_prefix, written

# Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
BLOCK = 64
ONES = np.uint32(0xFFFFFFFF)

# Words and spans handled at once; bounds of a task's arrays.
CHUNK_WORDS = 20_000
CHUNK_SPANS = 16_384

# A-Z in lower case, every ASCII byte that is no letter or digit as a blank.
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def _position_table() -> np.ndarray:
    """[d, b]: what byte b adds to a CRC register when d bytes follow it."""
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & 1, (row >> 1) ^ np.uint32(POLYNOMIAL), row >> 1)
    out = [row]
    while len(out) < BLOCK:
        out.append((out[-1] >> 8) ^ row[out[-1] & 255])
    return np.array(out, dtype=np.uint32)


POSITIONS = _position_table()


def _length_constants() -> np.ndarray:
    """The register that starts as all ones, after 0 to BLOCK zero bytes."""
    out = [ONES]
    for _ in range(BLOCK):
        out.append((out[-1] >> np.uint32(8)) ^ POSITIONS[0][out[-1] & np.uint32(255)])
    return np.array(out, dtype=np.uint32)


STARTED = _length_constants()


def _blocks(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XOR of the position table's entries over each span [start, start + length), lengths 1 to BLOCK."""
    ends = np.cumsum(lengths)
    offsets = ends - lengths
    flat = np.arange(int(ends[-1]), dtype=np.int64)
    byte = data[flat + np.repeat(starts - offsets, lengths)]
    after = np.repeat(ends - 1, lengths) - flat
    return np.bitwise_xor.reduceat(POSITIONS.ravel().take((after << 8) + byte), offsets)


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 (as zlib's) of each non-empty span of the bytes ``data``."""
    if not len(starts):
        return np.empty(0, dtype=np.uint32)
    first = (ends - starts - 1) % BLOCK + 1
    register = _blocks(data, starts, first) ^ STARTED[first]
    at = starts + first
    live = np.flatnonzero(at < ends)
    while live.size:
        before = register[live]
        block = _blocks(data, at[live], np.full(live.size, BLOCK))
        for k in range(4):
            block ^= POSITIONS[BLOCK - 1 - k][(before >> np.uint32(8 * k)) & np.uint32(255)]
        register[live] = block
        at[live] += BLOCK
        live = live[at[live] < ends[live]]
    return register ^ ONES


def feature_buckets(bodies: list[bytes | None], width: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For n = 1 to ``width``: (document, bucket) of every run of n words, in
    text order, and the documents' word counts."""
    words: list[bytes] = []
    counts = np.zeros(len(bodies), dtype=np.int64)
    for i, body in enumerate(bodies):
        if body:
            own = body.translate(NORMAL).split()
            counts[i] = len(own)
            words += own
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    owner = np.repeat(np.arange(len(bodies)), counts)
    for n in range(1, width + 1):
        last = np.arange(n - 1, len(words))
        whole = owner[last] == owner[last - (n - 1)] if len(last) else last == 0
        last = last[whole]
        found = np.empty(len(last), dtype=np.int64)
        for a in range(0, len(last), CHUNK_SPANS):
            part = last[a : a + CHUNK_SPANS]
            found[a : a + CHUNK_SPANS] = crc32_spans(data, starts[part - (n - 1)], ends[part]) % np.uint32(buckets)
        yield owner[last], found, counts


def chunked(bodies: list[bytes | None]) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts) of consecutive rows, at about CHUNK_WORDS words a chunk (never less than one row)."""
    first, size = 0, 0
    for i, body in enumerate(bodies):
        size += len(body or b"")
        if size >= 6 * CHUNK_WORDS or i + 1 == len(bodies):
            yield first, bodies[first : i + 1]
            first, size = i + 1, 0


def bucket_counts(docs: DataFrame, text: str = "text", width: int = 3, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket; buckets without any have no row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, bodies in chunked(batch.column(0).to_pylist()):
                for _, found, _ in feature_buckets(bodies, width, buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    parts = docs.select(col(text).cast("binary").alias("text_")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", width: int = 3, buckets: int = 10_000) -> np.ndarray:
    """Gain of each bucket in thousandths: floor(1000 * ln of the ratio of
    the add-one shares among the target's features and among the documents').
    One row a bucket comes to the driver, however large the tables are."""
    own = bucket_counts(docs, text, width, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    wanted = bucket_counts(target, text, width, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    s, t = np.zeros(buckets), np.zeros(buckets)
    for row in own.union(wanted).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():
        s[row["bucket"]], t[row["bucket"]] = row["s"], row["t"]
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(
    docs: DataFrame,
    gain: np.ndarray,
    text: str = "text",
    width: int = 3,
    keep: list[str] | None = None,
    names: tuple[str, str, str] = ("n_words", "n_features", "weight"),
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if None) and, per row, its
    words, its features and the sum of their gains under ``names``.

    A null or empty text, or one without words, has no features and weight 0.
    Repeated rows stay; an empty table gives an empty one; columns named like
    one of ``names`` are replaced."""
    taken = {n.lower() for n in names}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
    sent = Shared(docs.sparkSession, gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.get()
        for batch in batches:
            bodies = batch.column(batch.num_columns - 1).to_pylist()
            n_words, n_features, weight = (np.zeros(len(bodies), dtype=np.int64) for _ in range(3))
            for first, part in chunked(bodies):
                for owner, found, counts in feature_buckets(part, width, len(gain)):
                    run = np.concatenate(([0], np.cumsum(gain[found])))
                    each = np.bincount(owner, minlength=len(part))
                    until = np.cumsum(each)
                    rows = slice(first, first + len(part))
                    n_words[rows] = counts
                    n_features[rows] += each
                    weight[rows] += run[until] - run[until - each]
            rest = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(n_words), pa.array(n_features), pa.array(weight)],
                names=[f"c{i}" for i in range(len(rest))] + ["n_words", "n_features", "weight"],
            )

    # Inside, columns go by position names, so that none can clash.
    ready = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(kept)], col(text).cast("binary").alias("text_"))
    schema = StructType(ready.schema.fields[:-1])
    for name in ("n_words", "n_features", "weight"):
        schema = schema.add(name, LongType())
    done = ready.mapInArrow(score, schema)
    return done.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)],
        *[F.col(c).alias(name) for c, name in zip(("n_words", "n_features", "weight"), names)],
    )


def gumbel(doc_id: Column, seed: int) -> Column:
    """Seeded Gumbel noise of an id in thousandths; a null id counts as an empty string."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(
    weighed: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    seed: int = 42,
    doc_id: str = "doc_id",
    n_words: str = "n_words",
    weight: str = "weight",
    names: tuple[str, str] = ("score", "rank"),
) -> DataFrame:
    """Every row with its score (weight plus noise) and, if it is drawn, its
    rank from 1: of the rows with ``least_words`` words or more, ``percent``
    per cent (rounded down) with the highest scores are; the others' is null.

    Ties go to the smaller id, null ids last, then to the earlier row, so
    equal ids never share one range by force. Ranks come from range partitions
    and prefix sums of their sizes; only the number of rows reaches the driver."""
    score, rank = names
    kept = [c for c in weighed.columns if c.lower() not in {score.lower(), rank.lower()}]
    place, scored = fresh(weighed.select(*[col(c) for c in kept]), "place_", "scored_")
    rows = written(
        weighed.select(
            *[col(c) for c in kept],
            (col(weight) + gumbel(col(doc_id), seed)).alias(scored),
            F.monotonically_increasing_id().alias(place),
        ),
        "scored",
    )
    large = col(n_words) >= least_words
    drawn = percent * rows.where(large).count() // 100
    (number,) = fresh(rows, "number_")
    order = [F.col(scored).desc(), col(doc_id).asc_nulls_last(), F.col(place).asc()]
    ranked = with_prefix(rows.where(large), order, {}, row=number)
    where = F.when(F.col(number) < drawn, F.col(number) + 1)
    out = [col(c) for c in kept] + [F.col(scored).alias(score)]
    small = rows.where(~F.coalesce(large, F.lit(False)))
    return ranked.select(*out, where.cast("long").alias(rank)).union(small.select(*out, F.lit(None).cast("long").alias(rank)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns: a sample whose
    n-grams are distributed like those of ``target`` (read in its column ``text``)."""
    rank, score, n_words, n_features, weight = fresh(docs, "rank_", "score_", "n_words_", "n_features_", "weight_")
    weighed = weigh(docs, gains(docs, target, text), text, names=(n_words, n_features, weight))
    found = draw(weighed, percent, least_words, seed, doc_id, n_words, weight, (score, rank))
    return found.where(F.col(rank).isNotNull()).select(*[col(c) for c in docs.columns])
