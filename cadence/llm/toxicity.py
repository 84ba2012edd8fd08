"""Toxicity: support vector machine on a subsequence string kernel with
Nyström landmarks.

The kernel of two words counts the three-character subsequences they share,
each weighted by ``DECAY`` to the length it spans (gaps up to ``REACH``
characters), normalised to 1 for equal words. Gapped and inserted characters
thus lower it only a little, and no value is too small to count. A word with
other characters than letters in it is read without them too. Nyström features of a word's kernel values with
the landmarks feed a linear support vector machine. It is trained on labelled
sentences, each seen through its words (runs of single characters count as
one word too): all words of a clean sentence are clean, and of a toxic one
the word with the largest margin is toxic. A sentence, and so a document, has
the margin of its worst word; that, the number of words beyond the margin 0
and the length give a document's probability.

Landmarks, machine and calibration come from a bounded, documented sample
(``Bounds``) of labelled documents; every text is scored whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import Shared, col, compact, fresh, tidy, written

DECAY, REACH = 0.7, 4
NEAR = 0.5  # sentences with a word of such a kernel value are trained on
LONGEST = 32  # longer words are read in overlapping windows
CACHED_WORDS = 600_000
BLOCK = 4_096  # words at a time, in training and in scoring
CHUNK_CHARS = 4 << 20
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„’…–—"
SENTENCES = re.compile(r"[\n\r]+|(?<=[.!?])\s+").split
SPACED = re.compile(r"(?<!\S)\S(?:\s+\S(?!\S)){2,}").findall


@dataclass(frozen=True)
class Bounds:
    docs_per_label: int = 2_500
    landmarks: int = 96
    contrasts: int = 48  # landmarks among words of clean documents
    sentences: int = 40_000


@dataclass
class Kernel:
    """Kernel values of any words with fixed landmark words."""

    landmarks: tuple[str, ...]
    chars: np.ndarray = field(init=False)
    table: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)  # by triple, its landmarks and their weights
    owners: np.ndarray = field(init=False)
    shares: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        letters = sorted({c for w in self.landmarks for c in w})
        n = len(letters) + 1
        self.chars = np.zeros(0x110000 if letters and ord(letters[-1]) > 0xFFFF else 0x10000, dtype=np.int64)
        for i, c in enumerate(letters):
            self.chars[ord(c)] = i + 1
        self.table = np.full(n**3, -1, dtype=np.int32)
        word, triple, weight, _ = self._triples(self.landmarks)
        codes, at = np.unique(triple, return_inverse=True)
        self.table[codes] = np.arange(len(codes))
        cells, where = np.unique(at * max(1, len(self.landmarks)) + word, return_inverse=True)
        of, self.owners = np.divmod(cells, max(1, len(self.landmarks)))
        sums = np.bincount(where, weight, len(cells))
        norms = np.sqrt(np.bincount(self.owners, sums**2, len(self.landmarks)))
        self.shares = sums / np.maximum(norms, 1e-9)[self.owners]
        self.starts = np.searchsorted(of, np.arange(len(codes) + 1))

    def _triples(self, words: tuple[str, ...] | list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word number, code over the landmarks' characters, weight, exact code) of every occurrence."""
        joined = ("\n".join(words) + "\n" * (REACH + 1)).encode("utf-32-le", "surrogatepass")
        raw = np.frombuffer(joined, dtype="<u4").astype(np.int64)
        ends = raw == 10
        number = np.cumsum(ends) - ends
        inside = raw < len(self.chars)
        c = np.where(inside, self.chars[np.where(inside, raw, 0)], 0)
        n = int(self.chars.max()) + 1
        parts = []
        last = len(raw) - REACH
        for b in range(2, REACH + 1):
            same = np.flatnonzero((number[:last] == number[b : b + last]) & ~ends[b : b + last])
            for a in range(1, b):
                parts.append(
                    (
                        number[same],
                        (c[same] * n + c[same + a]) * n + c[same + b],
                        np.full(len(same), DECAY ** (b + 1)),
                        (raw[same] << 42) | (raw[same + a] << 21) | raw[same + b],
                    )
                )
        return tuple(np.concatenate(x) for x in zip(*parts))

    def values(self, words: list[str]) -> dict[int, np.ndarray]:
        """By position in ``words``, kernel values with all landmarks, of those with one over 0."""
        if not words or not self.landmarks:
            return {}
        word, triple, weight, exact = self._triples(words)
        hit = self.table[triple]
        found = hit >= 0
        at = np.flatnonzero(np.bincount(word[found], minlength=len(words)))
        if not len(at):
            return {}
        row = np.full(len(words), -1)
        row[at] = np.arange(len(at))
        mine = row[word] >= 0
        # Norms need occurrences of one triple in one word summed first.
        order = np.lexsort((exact[mine], row[word[mine]]))
        r, e, w = row[word[mine]][order], exact[mine][order], weight[mine][order]
        starts = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (e[1:] != e[:-1])])
        norm = np.sqrt(np.bincount(r[starts], np.add.reduceat(w, starts) ** 2, len(at)))
        both = mine & found
        k = np.zeros((len(at), len(self.landmarks)), dtype=np.float32)
        rows, hits, ws = row[word[both]], hit[both], weight[both]
        order = np.argsort(rows, kind="stable")
        rows, hits, ws = rows[order], hits[order], ws[order]
        n = len(self.landmarks)
        for lo in range(0, len(rows), 100_000):
            h, sizes = hits[lo : lo + 100_000], self.starts[hits[lo : lo + 100_000] + 1] - self.starts[hits[lo : lo + 100_000]]
            one = np.repeat(np.arange(len(h)), sizes)
            at_entry = np.arange(len(one)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.starts[h][one]
            r = rows[lo : lo + 100_000]
            first, last = r[0], r[-1] + 1
            cells = (r[one] - first) * n + self.owners[at_entry]
            sums = np.bincount(cells, ws[lo : lo + 100_000][one] * self.shares[at_entry], (last - first) * n)
            k[first:last] += sums.reshape(-1, n)
        k /= norm[:, None]
        return {int(at[i]): k[i] for i in np.flatnonzero(k.any(axis=1))}


def bare(token: str) -> list[str]:
    """A token's word without marks at its ends, and its letters alone where it has more; long ones as windows."""
    word = token.strip(EDGES)
    readings = [word] if word.isalpha() else [word, "".join(filter(str.isalpha, word))]
    out, half = [], LONGEST // 2
    for w in readings:
        if len(w) > LONGEST:
            out += [w[i : i + LONGEST] for i in range(0, len(w) - half, half)]
        elif len(w) >= 3:
            out.append(w)
    return out


def spaced(low: str, tokens: list[str]) -> list[str]:
    """Words written with white space between their characters."""
    if sum(len(t) == 1 for t in tokens) < 3:
        return []
    return ["".join(run.split()) for run in SPACED(low)]


class Reader:
    """What texts say to a kernel; ``note`` makes of a word's kernel values
    what is remembered of it. Words without any value are only known as dull."""

    def __init__(self, kernel: Kernel, note: Callable = lambda values: values):
        self.kernel, self.note, self.dull, self.telling = kernel, note, set(), {}

    def learn(self, tokens: set[str]) -> None:
        new = list(tokens - self.dull - self.telling.keys())
        if len(self.dull) + len(self.telling) + len(new) > CACHED_WORDS:
            self.dull.clear()
            self.telling.clear()
            new = list(tokens)
        for lo in range(0, len(new), BLOCK):
            self._learn(new[lo : lo + BLOCK])

    def _learn(self, new: list[str]) -> None:
        words, owner = [], []
        for i, token in enumerate(new):
            for w in bare(token):
                words.append(w)
                owner.append(i)
        values: dict[int, np.ndarray] = {}
        for at, v in self.kernel.values(words).items():
            i = owner[at]
            values[i] = np.maximum(values[i], v) if i in values else v
        self.telling.update((new[i], self.note(v)) for i, v in values.items())
        self.dull.update(t for i, t in enumerate(new) if i not in values)

    def read(self, texts: list[str | None]) -> Iterator[tuple[str, list[str]]]:
        """Per text its lower case and its words, which are then known."""
        chunk: list[tuple[str, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            low = (text or "").lower()
            tokens = low.split()
            tokens += spaced(low, tokens)
            chunk.append((low, tokens))
            size += len(low)
            if size >= CHUNK_CHARS or i + 1 == len(texts):
                self.learn(set().union(*[t for _, t in chunk]))
                yield from chunk
                chunk, size = [], 0


@dataclass(frozen=True)
class Model:
    kernel: Kernel
    direction: np.ndarray  # weights on kernel values: Nyström map and machine in one
    bias: float
    fit: tuple[float, float, float, float]  # of margin, log words beyond 0, log words, 1

    def margin(self, values: np.ndarray) -> float:
        return float(values @ self.direction) + self.bias

    def features(self, tokens: list[str], margins: dict[str, float]) -> tuple[float, float, float, float]:
        found = [m for t in tokens if (m := margins.get(t)) is not None]
        beyond = sum(m > 0 for m in found)
        return max([self.bias, *found]), math.log1p(beyond), math.log1p(len(tokens)), 1.0

    def probability(self, tokens: list[str], margins: dict[str, float]) -> float:
        z = sum(a * b for a, b in zip(self.fit, self.features(tokens, margins)))
        return 1.0 / (1.0 + math.exp(-min(30.0, max(-30.0, z))))


def _svm(x: np.ndarray, at: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss on the rows ``at`` of ``x``, by Newton steps in the primal."""
    w = np.zeros(x.shape[1] + 1)
    for _ in range(25):
        square, side = np.diag(np.r_[np.ones(x.shape[1]), 1e-6]), np.zeros(len(w))
        for lo in range(0, len(at), BLOCK):
            some = slice(lo, lo + BLOCK)
            a = np.c_[x[at[some]].astype(float), np.ones(len(at[some]))]
            active = y[some] * (a @ w) < 1
            left = a[active] * cost[some][active, None]
            square += left.T @ a[active]
            side += left.T @ y[some][active]
        new = np.linalg.solve(square, side)
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def _logistic(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a probability from features."""
    w = np.zeros(a.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w)), a.T @ (y - p) - 1e-2 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(labelled: DataFrame, bounds: Bounds = Bounds(), texts: DataFrame | None = None) -> Model:
    """Fit on rows (``id_``, ``text_``, ``toxic_`` 0 or 1) without nulls in
    ``toxic_``. Where a label has more than ``docs_per_label`` rows, those are
    taken whose id hashes below its share. Without both labels every text
    gets the share of label 1.

    With ``texts`` (``id_``, ``text_``), ``labelled`` need not have texts: the
    sample is chosen first, and only its few ids go to the texts."""
    sizes = {r["toxic_"]: r["n"] for r in labelled.groupBy("toxic_").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(1.0)
    for label, n in sizes.items():
        share = F.when(F.col("toxic_") == label, F.lit(min(1.0, bounds.docs_per_label / n))).otherwise(share)
    chosen = F.pmod(F.xxhash64(F.lit(11), F.col("id_")), F.lit(1 << 30)) < F.floor(share * (1 << 30))
    picked = labelled.where(chosen)
    if texts is None:
        sample = written(picked.select("id_", "text_", "toxic_"), "labelled")
    else:
        # About ``docs_per_label`` ids a label, whatever the tables' sizes are.
        ids = compact(picked.select("id_", "toxic_").distinct(), "sample")
        sample = written(texts.join(F.broadcast(ids), "id_").select("id_", "text_", "toxic_"), "labelled")
    rate = sizes.get(1, 0) / max(1, sum(sizes.values()))
    none = Model(Kernel(()), np.zeros(0), 0.0, (0.0, 0.0, 0.0, math.log((rate + 1e-3) / (1 - rate + 1e-3))))
    if not sizes.get(0) or not sizes.get(1):
        return none
    used = {r["toxic_"]: r["n"] for r in sample.groupBy("toxic_").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = used.get(1, 0), used.get(0, 0)
    words = compact(
        sample.select(
            "toxic_",
            F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text_"), F.lit(r"(\p{L}{3,32})"), 1))).alias("word"),
        )
        .groupBy("word")
        .agg(F.sum("toxic_").alias("bad"), F.sum(1 - F.col("toxic_")).alias("good")),
        "words",
    )
    odds = F.log((F.col("bad") + 0.1) / (n1 + 1)) - F.log((F.col("good") + 0.5) / (n0 + 1))
    telling = (
        words.where("bad >= 3")
        .withColumn("odds", odds)
        .where("odds > 2")
        .orderBy((F.col("odds") * F.sqrt("bad")).desc(), "word")
        .limit(bounds.landmarks)
        .collect()
    )
    if not telling:
        return none
    marks = [r["word"] for r in telling]
    usual = [
        r["word"]
        for r in words.where("good >= 2").where(odds < 0.5).orderBy(F.col("good").desc(), "word").limit(20_000).collect()
    ]
    near = Kernel(tuple(marks)).values(usual)
    contrasts = sorted(near, key=lambda i: (-float(near[i].max()), usual[i]))[: bounds.contrasts]
    kernel = Kernel((*marks, *[usual[i] for i in contrasts]))
    wanted = set(marks)

    @tidy
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per sentence with a word near to a landmark: its telling words, and whether one of them is a landmark insult."""
        reader = Reader(kernel, lambda values: float(values.max()))
        for batch in batches:
            labels = batch["toxic_"].to_pylist()
            ids, ys, strong, zs = [], [], [], []
            for i, (low, tokens) in enumerate(reader.read(batch["text_"].to_pylist())):
                if not any(reader.telling.get(t, 0.0) >= NEAR for t in tokens):
                    continue
                for sentence in SENTENCES(low):
                    words = sentence.split()
                    words += spaced(sentence, words)
                    found = {t for t in words if t in reader.telling}
                    if any(reader.telling[t] >= NEAR for t in found):
                        ids.append(i)
                        ys.append(labels[i])
                        strong.append(any(w in wanted for t in found for w in bare(t)))
                        zs.append(" ".join(sorted(found)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id_"].take(pa.array(ids, pa.int64())),
                    pa.array(ys, pa.int32()),
                    pa.array(strong, pa.bool_()),
                    pa.array(zs, pa.string()),
                ],
                names=["id_", "toxic_", "strong", "z"],
            )

    kind = sample.schema["id_"].dataType.simpleString()
    sentences = written(
        sample.select("id_", "text_", F.col("toxic_").cast("int")).mapInArrow(
            read, f"id_ {kind}, toxic_ int, strong boolean, z string"
        ),
        "sentences",
    ).where("toxic_ = 0 or strong")
    share = min(1.0, bounds.sentences / max(1, sentences.count()))
    rows = (
        sentences.where(F.pmod(F.xxhash64(F.lit(13), "id_", "z"), F.lit(1 << 30)) < int(share * (1 << 30)))
        .orderBy("id_", "z")
        .collect()
    )
    labels = np.array([r["toxic_"] for r in rows])
    if not (labels == 1).any():
        return none
    gram = np.eye(len(kernel.landmarks))
    for i, v in kernel.values(list(kernel.landmarks)).items():
        gram[i] = v
    gram = (gram + gram.T) / 2
    values, vectors = np.linalg.eigh(gram)
    nystrom = vectors * np.where(values > 1e-3, 1 / np.sqrt(np.maximum(values, 1e-3)), 0.0)
    # Each word once, as Nyström features; the last row is a word without any value.
    tokens = sorted({t for r in rows for t in r["z"].split()})
    number = {t: i for i, t in enumerate(tokens)}
    seen = np.zeros((len(tokens) + 1, len(kernel.landmarks)), dtype=np.float32)
    worst = np.zeros(len(seen), dtype=np.float32)
    for lo in range(0, len(tokens), BLOCK):
        reader = Reader(kernel)
        reader.learn(set(tokens[lo : lo + BLOCK]))
        for t, v in reader.telling.items():
            worst[number[t]] = v[: len(marks)].max()
            seen[number[t]] = v
        seen[lo : lo + BLOCK] = seen[lo : lo + BLOCK] @ nystrom
    groups = [np.array([number[t] for t in r["z"].split()]) for r in rows]
    # A clean word counts as often as sentences have it.
    often = np.zeros(len(seen))
    often[-1] = 1
    for g, y in zip(groups, labels):
        if y == 0:
            often[g] += 1
    clean = np.flatnonzero(often)
    toxic = [g for g, y in zip(groups, labels) if y == 1]
    # At first the word nearest to a landmark insult stands for a toxic sentence, then the one the machine finds worst.
    weight = np.clip(often.sum() / len(toxic), 0.2, 5.0)
    for _ in range(3):
        chosen, times = np.unique([g[worst[g].argmax()] for g in toxic], return_counts=True)
        y = np.r_[-np.ones(len(clean)), np.ones(len(chosen))]
        w, bias = _svm(seen, np.r_[clean, chosen], y, np.r_[often[clean], times * weight] * 4.0)
        direction = nystrom @ w
        worst = seen @ w
    bias = min(bias, -0.1)  # a word without kernel values is clean
    machine = Model(kernel, direction.astype(np.float32), bias, (0.0, 0.0, 0.0, 0.0))

    @tidy
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(kernel, machine.margin)
        for batch in batches:
            found = [machine.features(t, reader.telling) for _, t in reader.read(batch["text_"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch["toxic_"], *[pa.array([f[i] for f in found], pa.float64()) for i in range(4)]],
                names=["toxic_", "a", "b", "c", "d"],
            )

    judged = (
        sample.select("text_", F.col("toxic_").cast("int"))
        .mapInArrow(judge, "toxic_ int, a double, b double, c double, d double")
        .orderBy("toxic_", "a", "b", "c")
        .collect()
    )
    table = np.array([tuple(r) for r in judged], dtype=float)
    fit = _logistic(table[:, 1:], table[:, 0])
    # The sample holds label 1 more often than the rows do.
    fit[3] += np.log(sizes[1] / sizes[0]) - np.log(max(1, n1) / max(1, n0))
    return replace(machine, fit=tuple(float(x) for x in fit))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability of being toxic as ``out`` to every row of ``docs``,
    read whole; a null or empty text counts as one without telling words.
    Rows are kept one for one; a column named like ``out`` is replaced; an
    empty table gives an empty result."""
    keep = [c for c in docs.columns if c.lower() != out.lower()]
    (body,) = fresh(docs.select(*[col(c) for c in keep]), "body_")
    sent = Shared(docs.sparkSession, model, lambda m: (m, Reader(m.kernel, m.margin)))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, reader = sent.get()
        for batch in batches:
            at = batch.schema.get_field_index(body)
            found = [model.probability(t, reader.telling) for _, t in reader.read(batch[at].to_pylist())]
            rest = batch.remove_column(at)
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(found, pa.float64())], names=[*rest.schema.names, out]
            )

    rows = docs.select(*[col(c) for c in keep], col(text).alias(body))
    return rows.mapInArrow(run, StructType(rows.schema.fields[:-1]).add(out, DoubleType()))
