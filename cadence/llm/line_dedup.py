"""Line dedup by content-defined line chunks.

A text's lines are hashed, and a rolling hash over the last ``window`` line
hashes decides after which lines a chunk ends. Boundaries depend on nearby
lines only, so inserted or missing lines elsewhere do not shift them. Chunks
hold ``least`` lines or more, always two at least. A text is chunked once per
seed; the chunkings differ in their boundaries, and a repeated passage that
one of them cuts badly another may cut well.

Where whole passages are to be found, every line is a boundary: a chunk of
``least`` lines begins at each line, so that equal neighbouring lines share a
chunk whatever surrounds them, and the chunks of a repeated run overlap and
cover it from its first line to its last.

A chunk that occurs more than once in the corpus is removed everywhere but at
its first place (smallest doc_id, then row order, then line). Equal hashes only
propose this: the bytes of all occurrences are compared first, and chunks of
one hash that differ stay.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import col, compact, fresh, tidy, written

PRIME = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def chunks(hashes: Sequence[int], seed: int, window: int, divisor: int, least: int) -> list[tuple[int, int]]:
    """Line ranges [a, b) of the chunks of a text with these line hashes. A
    rest of fewer than ``least`` lines belongs to the chunk before it; a text
    of one line has none."""
    out: list[tuple[int, int]] = []
    start = 0
    out_of_window = pow(PRIME, window, 1 << 64)
    roll = 0
    for i, h in enumerate(hashes):
        roll = (roll * PRIME + h) & MASK
        if i >= window:
            roll = (roll - hashes[i - window] * out_of_window) & MASK
        mixed = ((roll ^ (seed * 0xD6E8FEB86659FD93 & MASK)) * PRIME & MASK) >> 32
        if mixed % divisor == 0 and i + 1 - start >= least:
            out.append((start, i + 1))
            start = i + 1
    if start < len(hashes):
        if len(hashes) - start >= least:
            out.append((start, len(hashes)))
        elif out:
            out[-1] = (out[-1][0], len(hashes))
    return out


def windows(lines: int, least: int) -> list[tuple[int, int]]:
    """Line ranges of the chunks of a text of so many lines where every line is a boundary."""
    return [(a, a + least) for a in range(lines - least + 1)]


def remove_repeated(
    docs: DataFrame,
    seeds: Sequence[int] = (1, 2),
    window: int = 2,
    divisor: int = 3,
    least: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    removed: str = "removed_lines",
    whole: bool = False,
) -> DataFrame:
    """``docs`` with repeated multi-line chunks taken out of ``text`` (lines
    are what ``\\n`` separates; those kept are joined again) and the number of
    lines taken out of each row as ``removed``.

    With ``whole``, every run of ``least`` or more lines that occurs before
    goes to its full length; ``seeds``, ``window`` and ``divisor`` then do not
    count. Without it, those chunks of a run go that its copies share.

    Null texts stay null and empty ones empty; a text all of whose lines go
    becomes empty. Repeated rows: the first keeps its text. Null ids come
    last in the order of first places. Rows are kept one for one; an empty
    table gives an empty result; a column named like ``removed`` is replaced.
    ``docs`` is read more than once and must give its rows in the same order
    each time, as a scan of files does."""
    least = max(2, least)
    keep = [c for c in docs.columns if c.lower() != removed.lower()]
    uid, ranges, owner = fresh(docs, "uid_", "ranges_", "owner_")
    rows = docs.select(*[col(c) for c in keep]).withColumn(uid, F.monotonically_increasing_id())
    id_field = StructField("id_", docs.schema[doc_id].dataType)

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: list[int] = []
            found: list[tuple[bytes, int, int]] = []
            for row, value in enumerate(batch["text_"]):
                body = value.as_py()
                if not body:
                    continue
                lines = body.encode().split(b"\n")
                if len(lines) < 2:
                    continue
                if whole:
                    spans = windows(len(lines), least)
                else:
                    hashes = [xxhash.xxh3_64_intdigest(line) for line in lines]
                    spans = {span for seed in seeds for span in chunks(hashes, seed, window, divisor, least)}
                for a, b in sorted(spans):
                    found.append((xxhash.xxh3_128_digest(b"\n".join(lines[a:b])), a, b))
                    at.append(row)
            if at:
                h, a, b = zip(*found)
                where = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h, pa.binary()),
                        batch["uid_"].take(where),
                        batch["id_"].take(where),
                        pa.array(a, pa.int64()),
                        pa.array(b, pa.int64()),
                    ],
                    names=["h", "uid_", "id_", "a", "b"],
                )

    fields = [StructField("h", BinaryType()), StructField("uid_", LongType()), id_field]
    schema = StructType([*fields, StructField("a", LongType()), StructField("b", LongType())])
    places = written(
        rows.select(F.col(uid).alias("uid_"), col(doc_id).alias("id_"), col(text).alias("text_")).mapInArrow(cut, schema),
        "chunks",
    )
    place = F.struct(F.col("id_").isNull().alias("n"), "id_", "uid_", "a")
    repeated = compact(
        places.groupBy("h")
        .agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("first"))
        .where("times > 1")
        .select("h", F.col("first.uid_").alias("first_uid"), F.col("first.a").alias("first_a")),
        "repeated",
    )
    mine = (
        places.join(repeated, "h")
        .withColumn("go", ~((F.col("uid_") == F.col("first_uid")) & (F.col("a") == F.col("first_a"))))
        .groupBy(F.col("uid_").alias(owner))
        .agg(F.collect_list(F.struct("a", "b", "h", "go")).alias(ranges))
    )
    joined = written(rows.join(mine, rows[uid] == mine[owner], "left").drop(owner), "marked")

    @tidy
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = set()
            for body, spans in zip(batch["text_"].to_pylist(), batch["ranges_"].to_pylist()):
                lines = body.encode().split(b"\n")
                met.update((s["h"], b"\n".join(lines[s["a"] : s["b"]])) for s in spans)
            hashes, bodies = zip(*met) if met else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.binary()), pa.array(bodies, pa.binary())], names=["h", "bytes"]
            )

    # Byte comparison: all occurrences of a hash are equal if the least and the greatest are.
    differ = written(
        joined.where(F.col(ranges).isNotNull())
        .select(col(text).alias("text_"), F.col(ranges).alias("ranges_"))
        .mapInArrow(texts, "h binary, bytes binary")
        .groupBy("h")
        .agg(F.min("bytes").alias("least"), F.max("bytes").alias("greatest"))
        .where("least != greatest")
        .select("h"),
        "differ",
    )
    if differ.limit(1).count():  # two texts of one 128-bit hash: take their ranges out again
        spans = joined.select(F.col(uid).alias("u_"), F.explode(ranges).alias("s")).join(
            differ, F.col("s.h") == F.col("h"), "left_anti"
        )
        good = spans.groupBy(F.col("u_").alias(owner)).agg(F.collect_list("s").alias(ranges))
        joined = joined.drop(ranges).join(good, F.col(uid) == F.col(owner), "left").drop(owner)
    going = F.transform(F.filter(F.col(ranges), lambda s: s["go"]), lambda s: F.struct(s["a"], s["b"]))

    @tidy
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, counts = [], []
            for body, spans in zip(batch["text_"].to_pylist(), batch["ranges_"].to_pylist()):
                gone = {i for s in spans or () for i in range(s["a"], s["b"])}
                if gone:
                    body = "\n".join([line for i, line in enumerate(body.split("\n")) if i not in gone])
                bodies.append(body)
                counts.append(len(gone))
            rest = batch.drop_columns(["text_", "ranges_"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(bodies, pa.string()), pa.array(counts, pa.int64())],
                names=[*rest.schema.names, "text_", "removed_"],
            )

    others = [c for c in keep if c != text]
    # Inside, columns go by position names, so that none can clash.
    ready = joined.select(
        *[col(c).alias(f"c{i}") for i, c in enumerate(others)],
        col(text).alias("text_"),
        going.cast("array<struct<a:bigint,b:bigint>>").alias("ranges_"),
    )
    schema = StructType(ready.schema.fields[:-2]).add("text_", "string").add("removed_", "long")
    done = ready.mapInArrow(strip, schema)
    at = {c: f"c{i}" for i, c in enumerate(others)} | {text: "text_"}
    return done.select(*[F.col(at[c]).alias(c) for c in keep], F.col("removed_").alias(removed))
