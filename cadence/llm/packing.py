"""Packing: concatenate and cut.

All documents, each followed by an end id, form one stream in scan order. The
first pass tokenizes, writes the ids, and gives every document its place
within its partition. Token totals per partition (one row each) are summed to
partition offsets; with them the second pass knows every document's global
offset and cuts it at the borders of fixed windows. Each cut is a boundary
record (a *piece*): where it lies in its document and in its sequence. No
token is shuffled; only the last window needs padding.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from .common import Shared, col, tidy, worker_state, written

# Bounds of one worker's caches and of one batch of output ids.
CACHED_WORDS = 600_000
BATCH_BYTES = 8 << 20

PIECE_FIELDS = ("start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32")


class WordTokenizer:
    """Ids of a tokenizer file with word-internal BPE (lower case, white space
    dropped), equal to encoding the whole text at once.

    White space always ends a word there, so texts are split into the file's
    own word pieces and each distinct piece is encoded once per worker. That
    is done here for plain Latin text; a white-space chunk holding anything
    else (other scripts, combining or control characters, special tokens)
    goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        kinds = [(c, unicodedata.category(chr(c))) for c in range(0x21, 0x250)]
        plain = [c for c, k in kinds if k[0] not in "CZ" and c != 0x130]
        letters = "".join(chr(c) for c in plain if unicodedata.category(chr(c))[0] == "L")
        numbers = "".join(chr(c) for c in plain if unicodedata.category(chr(c))[0] == "N")
        others = "".join(re.escape(chr(c)) for c in plain if unicodedata.category(chr(c))[0] not in "LN")
        self.pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[{others}]+").findall
        self.unusual = re.compile(f"[^ \t\n\r\x0b\x0c{letters}{numbers}{others}]|<\\|").search
        # Bytes that stand for themselves in byte-level BPE; the others take code points from 256 on.
        same = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        rest = iter(range(256, 512))
        shown = {b: chr(b) if b in same else chr(next(rest)) for b in range(256)}
        self.shown = {c: "".join(shown[b] for b in chr(c).encode()) for c in range(0x80, 0x250)}
        self.known: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() else piece.translate(self.shown)
        ids = np.array([t.id for t in self.tokenizer.model.tokenize(text)], dtype=self.width).tobytes()
        if len(self.known) >= CACHED_WORDS:
            self.known.clear()
        self.known[piece] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        if not self.unusual(chunk):
            return self._plain(chunk)
        if (ids := self.chunks.get(chunk)) is None:
            ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype=self.width).tobytes()
            if len(self.chunks) >= CACHED_WORDS // 8:
                self.chunks.clear()
            if len(chunk) < 200:
                self.chunks[chunk] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        known, own = self.known.get, self._piece
        return b"".join([known(p) or own(p) for p in self.pieces(text.lower())])

    def ids(self, text: str) -> bytes:
        """The text's ids, little-endian, ``width`` each."""
        if self.unusual(text):
            return b"".join(map(self._chunk, re.split(r"[ \t\n\r\x0b\x0c]+", text)))
        return self._plain(text)


def tokenizer_at(path: str) -> WordTokenizer:
    """One tokenizer, with its caches, per worker process and file."""
    made = worker_state().setdefault("tokenizers", {})
    if path not in made:
        made[path] = WordTokenizer(path)
    return made[path]


def tokenize(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """First pass, written to the shared folder: per document ``part`` (its
    partition), ``place`` (tokens before it there), ``doc_tokens`` and
    ``ids`` (little-endian, 2 or 4 bytes each as the vocabulary needs)."""
    id_type = docs.schema[doc_id].dataType

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part, place = tokenizer_at(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype=tok.width).tobytes()
        for batch in batches:
            first, held, ids, places, counts = 0, 0, [], [], []

            def out(first: int, n: int) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * n, pa.int32()),
                        pa.array(places, pa.int64()),
                        batch[0].slice(first, n),
                        pa.array(counts, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["part", "place", "doc_id", "doc_tokens", "ids"],
                )

            for value in batch[1]:
                one = tok.ids(value.as_py() or "") + end
                n = len(one) // len(end)
                ids.append(one)
                places.append(place)
                counts.append(n)
                place += n
                held += len(one)
                if held >= BATCH_BYTES:
                    yield out(first, len(ids))
                    first, held, ids, places, counts = first + len(ids), 0, [], [], []
            if ids:
                yield out(first, len(ids))

    schema = StructType(
        [
            StructField("part", IntegerType()),
            StructField("place", LongType()),
            StructField("doc_id", id_type),
            StructField("doc_tokens", LongType()),
            StructField("ids", BinaryType()),
        ]
    )
    return written(docs.select(col(doc_id), col(text)).mapInArrow(run, schema), "ids")


def pack(
    docs: DataFrame,
    path: str,
    end_id: int,
    length: int = 4096,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents of ``docs`` in sequences of ``length`` tokens.

    Per piece: ``doc_id``, ``start`` (its document's ids before it),
    ``length``, ``doc_tokens`` (the document's ids with the end id),
    ``sequence_id``, ``offset`` (in the sequence, gapless from 0),
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit) and ``ids``
    (those bytes). Every id lies in exactly one piece. A null or empty text
    is its end id alone; a null id stays null; repeated rows are packed each;
    an empty table gives no pieces. Other columns are ignored.
    """
    spark = docs.sparkSession
    tokens = tokenize(docs, path, end_id, doc_id, text)
    # One row per partition of the scan: as many as the driver schedules anyway.
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n")).orderBy("part").collect()
    base, offsets = 0, {}
    for r in totals:
        offsets[r["part"]] = base
        base += r["n"]
    sent = Shared(spark, offsets)
    placed = tokens.select("doc_id", "part", "place", "doc_tokens", "ids")
    id_field = StructField("doc_id", docs.schema[doc_id].dataType)

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets = sent.get()
        for batch in batches:
            rows: list[tuple] = []
            source: list[int] = []
            held = 0
            parts, places, counts = (batch[c].to_pylist() for c in ("part", "place", "doc_tokens"))
            for i, (part, place, n, raw) in enumerate(zip(parts, places, counts, batch["ids"])):
                at, raw = offsets[part] + place, raw.as_buffer()
                wide = np.frombuffer(raw, dtype="<u2" if raw.size == 2 * n else "<u4").astype("<u4").tobytes()
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(n - start, length - offset)
                    one = wide[4 * start : 4 * (start + size)]
                    rows.append((start, size, n, sequence, offset, zlib.crc32(one), one))
                    source.append(i)
                    start += size
                    held += len(one)
                    if held >= BATCH_BYTES:
                        yield pieces(batch, source, rows)
                        rows, source, held = [], [], 0
            if rows:
                yield pieces(batch, source, rows)

    def pieces(batch: pa.RecordBatch, source: list[int], rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"].take(pa.array(source, pa.int64())),
                *[pa.array(c, pa.int64()) for c in columns[:-1]],
                pa.array(columns[-1], pa.binary()),
            ],
            names=["doc_id", *PIECE_FIELDS, "ids"],
        )

    schema = StructType([id_field, *[StructField(c, LongType()) for c in PIECE_FIELDS], StructField("ids", BinaryType())])
    return placed.mapInArrow(cut, schema)


def sequences(pieces: DataFrame, length: int = 4096, pad_id: int = 0) -> DataFrame:
    """Whole sequences from pieces: ``sequence_id``, ``ids`` (array of int,
    padded to ``length`` unless its size is a power of two), ``n_tokens`` and
    ``pieces`` (doc_id, start, length by offset). A group holds ``length``
    ids at most."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by("offset")
        ids = np.frombuffer(b"".join(x.as_py() for x in group["ids"]), dtype="<u4").astype(np.int32)
        n = len(ids)
        padded = ids if n & (n - 1) == 0 else np.r_[ids, np.full(length - n, pad_id, np.int32)]
        spans = pa.StructArray.from_arrays(
            [group[c].combine_chunks() for c in ("doc_id", "start", "length")], names=["doc_id", "start", "length"]
        )
        return pa.table(
            {
                "sequence_id": pa.array([key[0].as_py()], pa.int64()),
                "n_tokens": pa.array([n], pa.int64()),
                "ids": pa.array([padded], pa.list_(pa.int32())),
                "pieces": pa.ListArray.from_arrays(pa.array([0, len(spans)], pa.int32()), spans),
            }
        )

    kind = pieces.schema["doc_id"].dataType.simpleString()
    schema = (
        f"sequence_id long, n_tokens long, ids array<int>, pieces array<struct<doc_id:{kind},start:long,length:long>>"
    )
    return pieces.groupBy("sequence_id").applyInArrow(run, schema)
