"""Language identification by word-first backoff.

A known word scores by its log frequency per language. An unseen word falls
back to its character n-grams, the longest first: the first length at which
some of its n-grams are known decides, at a penalty per step down.

The model is fitted on a bounded, documented sample (``Bounds``) of labelled
documents, chosen by a hash of the id, and holds bounded tables; only that
travels to the tasks. Every text is scored whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType
from pyspark.sql.window import Window

from .common import Shared, col, fresh, written

LETTERS = regex.compile(r"\p{L}+").findall
STEP = math.log(0.4)  # cost of each step to shorter n-grams
CACHED_WORDS = 500_000


@dataclass(frozen=True)
class Bounds:
    docs_per_lang: int = 1_500
    words_per_lang: int | None = 15_000  # None: all that the sample holds
    grams_per_lang: int | None = 10_000  # of each length; None: all
    longest_gram: int = 5


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    words: dict[str, tuple[float, ...]]
    grams: tuple[dict[str, tuple[float, ...]], ...]  # by length, longest first

    def unseen(self, word: str) -> list[float]:
        padded = f" {word} "
        cost = 0.0
        for table in self.grams:
            n = len(next(iter(table))) if table else len(padded) + 1
            found = [v for i in range(len(padded) - n + 1) if (v := table.get(padded[i : i + n])) is not None]
            if found:
                return [sum(x) / len(found) + cost for x in zip(*found)]
            cost += STEP
        return [0.0] * len(self.langs)


class Scorer:
    """Scores texts; a worker's memory of words is one growing matrix."""

    def __init__(self, model: Model):
        self.model = model
        self.at = {w: i for i, w in enumerate(model.words)}
        self.known = len(self.at)
        self.rows = np.array(list(model.words.values()), dtype=float).reshape(self.known, len(model.langs))

    def _add(self, words: list[str]) -> None:
        if len(self.at) + len(words) > self.known + max(CACHED_WORDS, len(words)):
            self.at = dict(list(self.at.items())[: self.known])
        n = len(self.at)
        if n + len(words) > len(self.rows):
            grown = np.zeros((2 * (n + len(words)), self.rows.shape[1]))
            grown[:n] = self.rows[:n]
            self.rows = grown
        self.rows[n : n + len(words)] = [self.model.unseen(w) for w in words]
        self.at.update((w, n + i) for i, w in enumerate(words))

    def score(self, text: str | None) -> tuple[str, float]:
        counts = Counter(LETTERS(text.lower())) if text else {}
        langs = self.model.langs
        if not counts or not langs:
            return "und", 0.0
        new = [w for w in counts if w not in self.at]
        if new:
            self._add(new)
            if any(w not in self.at for w in counts):  # the memory was cleared meanwhile
                self._add([w for w in counts if w not in self.at])
        at = np.fromiter(map(self.at.__getitem__, counts), dtype=np.int64, count=len(counts))
        total = np.fromiter(counts.values(), dtype=float, count=len(counts)) @ self.rows[at]
        best = int(np.argmax(total))
        return langs[best], float(1.0 / np.exp(total - total[best]).sum())


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` modulo ``parts``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def _logs(rows: list, langs: list[str], key: str) -> dict[str, tuple[float, ...]]:
    """Log frequencies per key and language, add-one smoothed."""
    at = {lang: i for i, lang in enumerate(langs)}
    counts: dict[str, np.ndarray] = {}
    for r in rows:
        counts.setdefault(r[key], np.ones(len(langs)))[at[r["lang_"]]] += r["n"]
    if not counts:
        return {}
    total = np.log(sum(counts.values()))
    return {k: tuple((np.log(v) - total).tolist()) for k, v in counts.items()}


def train(labelled: DataFrame, bounds: Bounds = Bounds()) -> Model:
    """Fit on rows (``id_``, ``text_``, ``lang_``) without nulls in text or
    lang. Where a language has more than ``docs_per_lang`` rows, those are
    taken whose id hashes below its share; their texts are read whole."""
    sizes = written(labelled.groupBy("lang_").agg(F.count(F.lit(1)).alias("rows_")), "sizes")
    below = F.pmod(F.xxhash64(F.lit(7), F.col("id_")), F.lit(1 << 30)) < F.floor(
        F.lit(float(1 << 30)) * bounds.docs_per_lang / F.col("rows_")
    )
    sample = labelled.join(sizes, "lang_").where(below)
    words = written(
        sample.select(
            "lang_",
            F.explode(F.regexp_extract_all(F.lower("text_"), F.lit(r"(\p{L}+)"), 1)).alias("word"),
        )
        .groupBy("lang_", "word")
        .agg(F.count(F.lit(1)).alias("n")),
        "words",
    )
    langs = sorted(r["lang_"] for r in words.select("lang_").distinct().collect())

    def top(counts: DataFrame, by: list[str], key: str, n: int | None) -> list:
        if n is None:
            return counts.collect()
        # Rows here are distinct words or n-grams of the bounded sample.
        order = Window.partitionBy(*by).orderBy(F.col("n").desc(), F.col(key))
        return counts.withColumn("rank_", F.row_number().over(order)).where(F.col("rank_") <= n).collect()

    known = _logs(top(words.where("n > 1"), ["lang_"], "word", bounds.words_per_lang), langs, "word")
    tables = []
    for size in range(bounds.longest_gram, 0, -1):
        padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
        grams = (
            words.withColumn("padded_", padded)
            .where(F.length("padded_") >= size)
            .select(
                "lang_",
                "n",
                F.explode(
                    F.transform(
                        F.sequence(F.lit(1), F.length("padded_") - size + 1),
                        lambda i: F.substr(F.col("padded_"), i, F.lit(size)),
                    )
                ).alias("gram"),
            )
            .groupBy("lang_", "gram")
            .agg(F.sum("n").alias("n"))
        )
        tables.append(_logs(top(grams, ["lang_"], "gram", bounds.grams_per_lang), langs, "gram"))
    return Model(tuple(langs), known, tuple(tables))


def identify(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    lang_pred: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (posterior, 0 to 1) to every row of
    ``docs``: a language the model learned, or ``und`` with 0 where the text is
    null or has no letter, or nothing was learned. Ties go to the language
    that sorts first. Rows are kept one for one; columns named like a new one
    are replaced; an empty table gives an empty result."""
    keep = [c for c in docs.columns if c.lower() not in {lang_pred.lower(), score.lower()}]
    (body,) = fresh(docs.select(*[col(c) for c in keep]), "body_")
    sent = Shared(docs.sparkSession, model, Scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = sent.get()
        for batch in batches:
            at = batch.schema.get_field_index(body)
            found = [scorer.score(x.as_py()) for x in batch[at]]
            rest = batch.remove_column(at)
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*rest.schema.names, lang_pred, score],
            )

    rows = docs.select(*[col(c) for c in keep], col(text).alias(body))
    schema = StructType(rows.schema.fields[:-1]).add(lang_pred, StringType()).add(score, DoubleType())
    return rows.mapInArrow(run, schema)
