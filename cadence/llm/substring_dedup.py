"""Substring dedup by super-k-mer partitioning of word windows.

A window is ``width`` consecutive words. Its minimiser is the run of ``SEED``
words in it with the smallest hash (the leftmost of equal ones). Consecutive
windows with one minimiser at one place form a super-k-mer: their words, once,
as one string. Equal windows have equal minimisers, so a window that occurs
twice lies in two super-k-mers of one bucket (the minimiser's hash), and never
twice in one super-k-mer.

Buckets that get one super-k-mer only hold no repeated window; a count of
light rows (hash, text, place) finds the others, and their super-k-mers alone
travel as strings. Copies of a string met in one slice of a task travel once, with
their number. In its bucket, a task sorts the windows themselves and counts
them. Buckets of more than ``bucket_windows`` windows (common phrases, edges of
passages that many texts share) are spread further: their windows are dealt by
128-bit hashes to a partial and a final aggregate.

The words of all windows that occur twice or more go, at every place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cadence.operators.skew import ROWS_PER_TASK, split_join

from .common import col, fresh, written

SEED = 6
PRIME = np.uint64(0x9E3779B97F4A7C15)
MIXER = np.uint64(0xD6E8FEB86659FD93)
# Bounds of a task's arrays: text bytes cut at once, bytes of strings sent at once, windows sorted at once.
CUT_BYTES = 256 << 10
SENT_BYTES = 8 << 20
SORT_WINDOWS = 50_000


def super_kmers(words: list[bytes], counts: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, minimiser hash) of the super-k-mers of
    texts whose words stand one after another, ``counts`` words each."""
    n = len(words)
    seed = min(SEED, width)
    if n < width:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    grams = hashes[: n - seed + 1].copy()
    for j in range(1, seed):
        grams = grams * PRIME + hashes[j : n - seed + 1 + j]
    grams = (grams ^ (grams >> np.uint64(32))) * MIXER
    grams ^= grams >> np.uint64(29)

    # Leftmost smallest of each ``span`` grams, by doubling.
    span, value, place = 1, grams, np.arange(len(grams))
    reach = width - seed + 1

    def joined(shift: int) -> tuple[np.ndarray, np.ndarray]:
        left = value[:-shift] <= value[shift:]
        return np.where(left, value[:-shift], value[shift:]), np.where(left, place[:-shift], place[shift:])

    while span * 2 <= reach:
        value, place = joined(span)
        span *= 2
    if span < reach:
        value, place = joined(reach - span)

    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts)), counts)[: n - width + 1]
    inside = np.arange(n - width + 1) + width <= ends[owner]
    fresh_run = inside.copy()
    fresh_run[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    first = np.flatnonzero(fresh_run)
    # A run ends where the next begins or where its text has no more windows.
    after = np.append(first[1:], n)
    windows = np.minimum(after, ends[owner[first]] - width + 1) - first
    return owner[first], first - (ends - counts)[owner[first]], windows, value[first].view(np.int64)


def count_windows(strings: list[list[bytes]], times: np.ndarray, width: int) -> list[list[tuple[int, int]]]:
    """Per string (its words), the ranges [a, b) of its windows that occur twice or
    more in all strings together, where string i counts ``times[i]`` times."""
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for s in strings for w in s], dtype=np.int32)
    lengths = np.array([len(s) for s in strings])
    starts = np.cumsum(lengths) - lengths
    windows = lengths - width + 1
    owner = np.repeat(np.arange(len(strings)), windows)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    rows = np.lib.stride_tricks.sliding_window_view(ids, width)[starts[owner] + at]
    keys = np.ascontiguousarray(rows).view(np.dtype((np.void, 4 * width))).ravel()
    _, same = np.unique(keys, return_inverse=True)
    twice = np.bincount(same, weights=times[owner])[same] >= 2
    out: list[list[tuple[int, int]]] = [[] for _ in strings]
    edge = twice & np.append(True, ~(twice[:-1] & (owner[1:] == owner[:-1])))
    last = twice & np.append(~(twice[1:] & (owner[1:] == owner[:-1])), True)
    for i, j in zip(np.flatnonzero(edge), np.flatnonzero(last)):
        out[owner[i]].append((int(at[i]), int(at[j]) + 1))
    return out


RANGES = "array<struct<lo:long,hi:long>>"


def _rows(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def remove_repeated(
    docs: DataFrame,
    width: int = 35,
    text: str = "text",
    words: str = "n_words",
    removed: str = "n_removed",
    bucket_windows: int = 100_000,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``docs`` with every word taken out of ``text`` that a repeated window
    covers (the words kept are joined by one blank), and the numbers of words
    before (``words``) and taken out (``removed``). Windows are judged on the
    input: all copies of a passage go, none is kept.

    Null texts stay null (0 words); texts of fewer than ``width`` words lose
    nothing. Rows, ids and other columns stay as they are, repeated rows
    count as texts of their own, and columns named like ``words`` or
    ``removed`` are replaced. An empty table gives an empty one. ``docs`` is
    read more than once and must give its rows in the same order each time, as
    a scan of files does. Strings are told apart by 128-bit hashes where
    their results return to the texts."""
    taken = {words.lower(), removed.lower()}
    keep = [c for c in docs.columns if c.lower() not in taken]
    others = [c for c in keep if c != text]
    (uid,) = fresh(docs, "uid_")
    numbered = docs.withColumn(uid, F.monotonically_increasing_id())
    bodies = numbered.select(F.col(uid).alias("uid"), col(text).cast("binary").alias("text_"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, texts = batch["uid"].to_numpy(), batch["text_"].to_pylist()
            held: list[bytes] = []
            counts: list[int] = []
            rows: list[int] = []
            size = 0
            for i, body in enumerate(texts):
                own = (body or b"").split()
                if len(own) >= width:
                    held += own
                    counts.append(len(own))
                    rows.append(i)
                    size += len(body)
                if rows and (size >= CUT_BYTES or i + 1 == len(texts)):
                    owner, first, windows, gram = super_kmers(held, np.array(counts), width)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram), pa.array(uids[np.array(rows)[owner]]), pa.array(first), pa.array(windows)],
                        names=["gram", "uid", "first", "windows"],
                    )
                    held, counts, rows, size = [], [], [], 0

    light = bodies.mapInArrow(cut, "gram long, uid long, first long, windows long")
    shared = written(light.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "minimisers")
    places = split_join(light, shared, "gram", "times", rows_per_task)
    wanted = places.groupBy("uid").agg(F.collect_list(F.struct("first", "windows", "gram")).alias("spans"))

    def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            z = [None if b is None else zip_(b) for b in batch["text_"].to_pylist()]
            yield batch.set_column(batch.schema.names.index("text_"), "text_", pa.array(z, pa.binary()))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor().decompress
        met: dict[bytes, int] = {}
        out: dict[str, list] = {}

        def clear() -> None:
            met.clear()
            out.update({name: [] for name in ("gram", "string", "uid", "first", "windows", "times", "words")})

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            made = _rows({name: (v, t) for (name, v), t in zip(out.items(), kinds)})
            clear()
            return made

        clear()
        size = 0
        for batch in batches:
            for u, z, spans in zip(batch["uid"].to_pylist(), batch["text_"].to_pylist(), batch["spans"]):
                own = unzip(z).split()
                for span in spans.as_py():
                    a, n = span["first"], span["windows"]
                    string = b" ".join(own[a : a + n + width - 1])
                    name = xxhash.xxh3_128_digest(string)
                    seen = met.get(name)
                    if seen is None:
                        met[name] = len(out["uid"])
                        size += len(string)
                    else:
                        out["times"][seen] += 1
                    size += 64
                    for key, value in zip(
                        out, (span["gram"], name, u, a, n, int(seen is None), string if seen is None else None)
                    ):
                        out[key].append(value)
                    if size >= SENT_BYTES:
                        yield batch_of()
                        size = 0
        yield batch_of()

    zipped = bodies.where(F.length("text_") >= 2 * width - 1).mapInArrow(pack_texts, bodies.schema)
    sent = written(
        zipped.join(wanted, "uid").mapInArrow(
            send, "gram long, string binary, uid long, first long, windows long, times long, words binary"
        ),
        "superkmers",
    )
    strings = sent.where("words is not null").select("gram", "string", "windows", "times", "words")
    hot = written(
        strings.groupBy("gram").agg(F.sum("windows").alias("n")).where(F.col("n") > bucket_windows).select("gram"), "hot"
    )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole buckets one after another, some at once, equal strings side by side."""
        gram, size = None, 0
        names: list[bytes] = []
        bodies: list[list[bytes]] = []
        times: list[int] = []

        def counted() -> pa.RecordBatch:
            found = count_windows(bodies, np.array(times), width) if names else []
            some = [i for i, r in enumerate(found) if r]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([names[i] for i in some], pa.binary()),
                    pa.array([times[i] for i in some], pa.int64()),
                    pa.array(
                        [[{"lo": a, "hi": b} for a, b in found[i]] for i in some],
                        pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])),
                    ),
                ],
                names=["string", "times", "ranges"],
            )

        for batch in batches:
            for g, name, n, body in zip(*(batch[c].to_pylist() for c in ("gram", "string", "times", "words"))):
                if names and names[-1] == name:
                    times[-1] += n
                    continue
                if g != gram and size >= SORT_WINDOWS:
                    yield counted()
                    names.clear(), bodies.clear(), times.clear()
                    size = 0
                gram = g
                names.append(name)
                bodies.append(body.split())
                times.append(n)
                size += len(bodies[-1]) - width + 1
        yield counted()

    result = f"string binary, times long, ranges {RANGES}"
    cool = strings.join(hot, "gram", "left_anti").select("gram", "string", "times", "words")
    found = cool.repartition("gram").sortWithinPartitions("gram", "string").mapInArrow(sort, result)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, n, body in zip(*(batch[c].to_pylist() for c in ("string", "times", "words"))):
                own = body.split()
                at = range(len(own) - width + 1)
                yield _rows(
                    {
                        "window": ([xxhash.xxh3_128_digest(b" ".join(own[i : i + width])) for i in at], pa.binary()),
                        "string": ([name] * len(at), pa.binary()),
                        "times": ([n] * len(at), pa.int64()),
                        "at": (list(at), pa.int64()),
                    }
                )

    whole = strings.join(hot, "gram", "left_semi").groupBy("string")
    whole = whole.agg(F.sum("times").alias("times"), F.max("words").alias("words"))
    dealt = written(whole.mapInArrow(deal, "window binary, string binary, times long, at long"), "windows")
    twice = dealt.groupBy("window").agg(F.sum("times").alias("n"), F.count(F.lit(1)).alias("rows")).where("n > 1")
    spread = split_join(dealt, written(twice.select("window", "rows"), "twice"), "window", "rows", rows_per_task)
    spread = spread.groupBy("string", "times").agg(
        F.collect_list(F.struct(F.col("at").alias("lo"), (F.col("at") + 1).alias("hi"))).alias("ranges")
    )
    found = written(found.union(spread.select("string", "times", "ranges")), "ranges")

    back = split_join(sent.select("string", "uid", "first"), found, "string", "times", rows_per_task)
    moved = F.transform(
        "ranges", lambda r: F.struct((r["lo"] + F.col("first")).alias("lo"), (r["hi"] + F.col("first") + width - 1).alias("hi"))
    )
    (owner,) = fresh(numbered, "owner_")
    going = back.groupBy(F.col("uid").alias(owner)).agg(F.flatten(F.collect_list(moved)).alias("ranges_"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts, before, gone = [], [], []
            for z, ranges in zip(batch["text_"].to_pylist(), batch["ranges_"]):
                own = unzip(z).split() if z is not None else []
                flags = np.ones(len(own), dtype=bool)
                for r in ranges.as_py() or ():
                    flags[r["lo"] : r["hi"]] = False
                kept = own if flags.all() else [w for w, k in zip(own, flags.tolist()) if k]
                texts.append(None if z is None else b" ".join(kept).decode())
                before.append(len(own))
                gone.append(len(own) - len(kept))
            rest = batch.drop_columns(["text_", "ranges_"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(texts, pa.string()), pa.array(before, pa.int64()), pa.array(gone, pa.int64())],
                names=[*rest.schema.names, "text_", "words_", "removed_"],
            )

    # Inside, columns go by position names, so that none can clash; texts travel compressed.
    rows = numbered.select(
        *[col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(uid).alias("uid"), col(text).cast("binary").alias("text_")
    )
    rows = rows.mapInArrow(pack_texts, rows.schema)
    ready = rows.join(going, rows["uid"] == going[owner], "left").drop("uid", owner)
    schema = StructType(ready.schema.fields[:-2]).add("text_", "string").add("words_", "long").add("removed_", "long")
    done = ready.mapInArrow(strip, schema)
    at = {c: f"c{i}" for i, c in enumerate(others)} | {text: "text_"}
    return done.select(
        *[F.col(at[c]).alias(c) for c in keep], F.col("words_").alias(words), F.col("removed_").alias(removed)
    )
