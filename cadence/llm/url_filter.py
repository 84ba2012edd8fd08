"""URL filter: Bloom filter cascades over the corpus's complete key universe.

Rules and blocked hosts are *listed keys*: a host followed by a path prefix
(``example.com/en/``). A URL can only fit a rule whose key is one of the URL's
own candidate keys: a suffix of its host at a label boundary plus a prefix of
its path. The distinct candidate keys of the whole corpus are the key
universe. For each list a cascade is built: level 1 encodes the listed keys,
level 2 those universe keys that pass level 1 without being listed, level 3
the listed keys that pass level 2, and so on until no key is left to confuse.
Membership of every key of the universe is then exact, and a URL is judged
from the filters alone, without a join.

Filters travel to the tasks; their size is set by the lists (about
``bits_per_key`` bits per listed key or false positive) and checked against
``max_filter_bytes``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .common import col, fresh, written

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and all its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str  # allow | block

    @property
    def key(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for a null url or one without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, labels: Sequence[int], lengths: Sequence[int]) -> Column:
    """Keys of a URL that a list with hosts of ``labels`` label counts and
    paths of ``lengths`` code points could hold, longest first; of equally
    long ones the one with the longer host first."""
    parts = F.split(host, r"\.")
    options = []
    for n in sorted(labels, reverse=True):
        suffix = F.concat_ws(".", F.slice(parts, -n, n))
        for size in sorted(lengths, reverse=True):
            key = F.concat(suffix, F.substring(path, 1, size))
            fits = (F.size(parts) >= n) & (F.length(path) >= size) & (host != "")
            options.append(
                F.when(
                    fits,
                    F.struct((-F.length(key)).alias("l"), (-F.length(suffix)).alias("h"), key.alias("k")),
                )
            )
    found = F.filter(F.array(*options), lambda x: x.isNotNull())
    return F.transform(F.array_sort(found), lambda x: x["k"])


@dataclass(frozen=True)
class Bloom:
    """``words`` holds ``m`` bits; a key sets ``k`` of them."""

    words: np.ndarray
    m: int
    k: int
    seed: int

    def positions(self, key: str) -> list[int]:
        return _positions(key, self.m, self.k, self.seed)

    def has(self, key: str) -> bool:
        words = self.words
        return all(int(words[p >> 6]) >> (p & 63) & 1 for p in self.positions(key))


def _positions(key: str, m: int, k: int, seed: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass"), seed=seed)
    a, b = h & 0xFFFFFFFFFFFFFFFF, (h >> 64) | 1
    return [((a + i * b) & 0xFFFFFFFFFFFFFFFF) % m for i in range(k)]


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Bloom, ...]

    def has(self, key: str) -> bool:
        """Exact for every key of the universe it was built over."""
        for i, level in enumerate(self.levels):
            if not level.has(key):
                return i % 2 == 1
        return len(self.levels) % 2 == 1


def build_bloom(keys: DataFrame, n: int, bits_per_key: float, seed: int, max_filter_bytes: int) -> Bloom:
    """Bloom filter of ``keys`` (one column ``key``, ``n`` rows): tasks set
    bits for their rows, 64-bit words are OR-ed by word number, and only the
    filter itself comes to the driver."""
    m = max(64, math.ceil(n * bits_per_key))
    if m > 8 * max_filter_bytes:
        raise ValueError(f"a filter of {n} keys needs {m // 8} bytes; max_filter_bytes is {max_filter_bytes}")
    k = max(1, round(bits_per_key * math.log(2)))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.array([p for key in batch["key"].to_pylist() for p in _positions(key, m, k, seed)], dtype=np.int64)
            if len(at):
                at = np.unique(at)
                word = at >> 6
                starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                ored = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word[starts]), pa.array(ored.view(np.int64))], names=["word", "bits"]
                )

    rows = keys.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()
    words = np.zeros((m + 63) // 64, dtype=np.uint64)
    for r in rows:
        words[r["word"]] = np.int64(r["bits"]).view(np.uint64)
    return Bloom(words, m, k, seed)


def build_cascade(
    universe: DataFrame, listed: DataFrame, bits_per_key: float = 10.0, max_filter_bytes: int = 1 << 26
) -> Cascade:
    """Cascade of ``listed`` exact over ``universe`` (both one column ``key``,
    universe distinct). Levels get fewer keys each time, by the false-positive
    rate, so a handful ends the loop."""
    marked = written(
        universe.select("key", F.lit(0).alias("listed"))
        .unionByName(listed.select("key", F.lit(1).alias("listed")))
        .groupBy("key")
        .agg(F.max("listed").alias("listed")),
        "keys",
    )
    inside, outside = marked.where("listed = 1").select("key"), marked.where("listed = 0").select("key")
    levels: list[Bloom] = []
    while (n := inside.count()) or not levels:
        level = build_bloom(inside, n, bits_per_key, len(levels), max_filter_bytes)
        levels.append(level)

        def passing(batches: Iterator[pa.RecordBatch], level: Bloom = level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([level.has(k) for k in batch["key"].to_pylist()], pa.bool_()))

        inside, outside = outside.mapInArrow(passing, "key string"), inside
    return Cascade(tuple(levels))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    blocked_hosts: DataFrame,
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` to every row of ``pages``.

    The longest fitting rule decides (of equally long ones that with the
    longer host); else ``block`` where the host or a domain above it is among
    ``blocked_hosts`` (one column ``host``, any number of rows, nulls
    ignored), else ``default``. A null URL or one without ``://`` has empty
    host and path and gets ``default``. Rows are kept one for one, repeated
    ones too; an empty table gives an empty result. Columns of ``pages``
    named like a new one are replaced."""
    spark = pages.sparkSession
    blocked = blocked_hosts.where("host is not null").select(F.translate("host", _UPPER, _UPPER.lower()).alias("key"))
    of_rules = sorted({(r.host.count(".") + 1, len(r.path)) for r in rules})
    of_hosts = [
        r["n"] for r in blocked.select(F.size(F.split("key", r"\.")).alias("n")).distinct().orderBy("n").collect()
    ]
    labels = sorted({n for n, _ in of_rules} | set(of_hosts))
    lengths = sorted({size for _, size in of_rules} | {0})
    keep = [c for c in pages.columns if c.lower() not in {"host", "path", "rule", "verdict"}]
    (keys,) = fresh(pages, "keys_")
    parsed = pages.select(
        *[col(c) for c in keep], host_of(col(url)).alias("host"), path_of(col(url)).alias("path")
    ).withColumn(keys, candidate_keys(F.col("host"), F.col("path"), labels or [1], lengths))
    universe = written(parsed.select(F.explode(keys).alias("key")).distinct(), "universe")
    lists = {
        verdict: spark.createDataFrame([(r.key,) for r in rules if r.verdict == verdict], "key string")
        for verdict in ("allow", "block")
    }
    allow = build_cascade(universe, lists["allow"])
    block = build_cascade(universe, lists["block"])
    hosts = build_cascade(universe, blocked)

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rule, verdict = [], []
            for found in batch[keys].to_pylist():
                hit = next(((k, v) for k in found or () for v, c in (("allow", allow), ("block", block)) if c.has(k)), None)
                rule.append(hit[0] if hit else None)
                verdict.append(hit[1] if hit else "block" if any(hosts.has(k) for k in found or ()) else default)
            i = batch.schema.get_field_index(keys)
            batch = batch.remove_column(i)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=[*batch.schema.names, "rule", "verdict"],
            )

    schema = StructType([f for f in parsed.schema.fields if f.name != keys]).add("rule", StringType()).add("verdict", StringType())
    return parsed.mapInArrow(verdicts, schema)
