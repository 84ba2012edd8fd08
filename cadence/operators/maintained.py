"""Retention kept up batch by batch.

Two tables stand for all history read so far: each entity's first date with
its number, and bitmaps of the numbers per (cohort, period). A batch

* lowers first dates by a merge (the least of two minima is the minimum of both),
* gives numbers to new entities,
* adds its own (cohort, period) bits by OR.

A late row can make an entity's first date earlier, which moves its cohort and
all its periods. Such an entity gets a new number, its old one is retired
(left out of every count from then on), and its older rows, of these entities
only, are added anew under the new number. Batches without such rows never read
old history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions import calendar as cal
from cadence.operators import bitmaps as bm
from cadence.operators import long_windows as lw
from cadence.sources.staging import staged


def first_dates(history: DataFrame, entity: str, start: str, first_col: str = "first") -> DataFrame:
    """Mergeable state of R1: (entity, first date); null entities are left out."""
    return history.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.min(start).alias(first_col))


def merged_first_dates(states: Sequence[DataFrame], entity: str, first_col: str = "first") -> DataFrame:
    """One state out of several, in any order: per entity the earliest date."""
    every = states[0].select(entity, first_col)
    for state in states[1:]:
        every = every.union(state.select(entity, first_col))
    return every.groupBy(entity).agg(F.min(first_col).alias(first_col))


def first_rows(history: DataFrame, entity: str, order: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """Mergeable state of R12: per entity the ``order`` and ``carried`` columns
    of its first row (nulls last in each). ``order`` should end in a
    unique column. Merge states by calling this on their union."""
    known = history.where(F.col(entity).isNotNull())
    key = [x for c in order for x in (F.col(c).isNull(), F.col(c))]
    row = F.min(F.struct(*[k.alias(f"_k{i}") for i, k in enumerate(key)], *carried)).alias("_row")
    out = known.groupBy(entity).agg(row)
    places = [F.col(f"_row._k{2 * i + 1}").alias(c) for i, c in enumerate(order)]
    return out.select(entity, *places, *[F.col("_row")[c].alias(c) for c in carried])


@dataclass(frozen=True)
class Kept:
    """State of a retention: ``entities`` (entity, ``_number``, first),
    ``sets`` (cohort columns, period, ``_bucket``, ``_bits``) and the ``retired``
    numbers (``_bucket``, ``_bits``)."""

    entities: DataFrame
    sets: DataFrame
    retired: DataFrame


@dataclass(frozen=True)
class Retention:
    """How rows count. A row says that ``entity`` began something at ``start``
    and was there at ``at`` (both may be one column; a null ``at``
    counts in period 0 if ``null_is_zero``, else as a null period). ``cohort``
    derives cohort columns from the first date (name -> expression over ``first``)."""

    entity: str
    start: str
    at: str
    unit: str = "year"
    cohort: Mapping[str, Column] | None = None
    null_is_zero: bool = False

    @property
    def keys(self) -> list[str]:
        return [*(self.cohort or {}), "period"]

    def _reduced(self, rows: DataFrame) -> DataFrame:
        known = rows.where(F.col(self.entity).isNotNull())
        return known.groupBy(F.col(self.entity).alias("_entity"), F.col(self.at).alias("_at")).agg(
            F.min(self.start).alias("_start")
        )

    def _sets(self, reduced: DataFrame, entities: DataFrame) -> DataFrame:
        """Bitmaps of rows under the numbers and first dates of ``entities``."""
        period = cal.completed_units(self.unit, F.col("first"), F.col("_at"))
        if self.null_is_zero:
            period = F.coalesce(period, F.lit(0).cast("bigint"))
        rows = reduced.select("_entity", "_at").join(entities, F.col("_entity") == F.col(self.entity))
        rows = rows.withColumns({**(self.cohort or {}), "period": period})
        return bm.bitmaps_of(rows, "_number", self.keys)

    def _numbered(self, found: DataFrame, after: Column | int) -> DataFrame:
        """(entity, first) with numbers from ``after`` + 1 on."""
        series = lw.numbered(found.select(self.entity, "first"), [self.entity])
        return series.rows.select(self.entity, (F.col("_row") + 1 + after).alias("_number"), "first")

    def begin(self, rows: DataFrame) -> Kept:
        """The state of a first batch."""
        reduced = self._reduced(rows)
        found = first_dates(reduced, "_entity", "_start").withColumnRenamed("_entity", self.entity)
        entities = staged(self._numbered(found, 0), "entities")
        none = bm.bitmaps_of(entities.where("false"), "_number")
        return Kept(entities, staged(self._sets(reduced, entities), "sets"), none)

    def add(self, kept: Kept, batch: DataFrame, history: DataFrame | None = None) -> Kept:
        """The state with ``batch`` added. ``history`` (the rows of earlier
        batches, where they can be read) is needed only if a late row moves an
        entity's first date; of it only those entities' rows are used."""
        reduced = staged(self._reduced(batch), "batch")
        late = first_dates(reduced, "_entity", "_start", "_first")
        known = kept.entities.select(F.col(self.entity), F.col("_number").alias("_old"), F.col("first").alias("_was"))
        # Only the batch's entities: those that are new or begin earlier than was known.
        earlier = F.col("_old").isNull() | (F.col("_first") < F.col("_was")) | (F.col("_was").isNull() & F.col("_first").isNotNull())
        changed = staged(
            late.join(known, F.col("_entity") == F.col(self.entity), "left")
            .where(earlier)
            .select("_entity", "_first", "_old"),
            "changed",
        )
        moved = changed.where("_old is not null")
        sets = [kept.sets]
        some_moved = moved.limit(1).count() > 0
        if some_moved and history is None:
            raise ValueError("late rows move first dates: the history of those entities is needed")
        most = kept.entities.agg(F.coalesce(F.max("_number"), F.lit(0))).first()[0]
        fresh = self._numbered(changed.select(F.col("_entity").alias(self.entity), F.col("_first").alias("first")), most)
        stay = kept.entities.join(changed.select(F.col("_entity").alias(self.entity)), self.entity, "left_anti")
        entities = staged(stay.select(self.entity, "_number", "first").union(fresh), "entities")
        sets.append(self._sets(reduced, entities))
        retired = kept.retired
        if some_moved:
            older = self._reduced(history).join(moved.select("_entity"), "_entity", "left_semi")
            sets.append(self._sets(older, entities))
            retired = staged(bm.merged([retired, bm.bitmaps_of(moved, "_old")]), "retired")
        return Kept(entities, staged(bm.merged(sets, self.keys), "sets"), retired)

    def counts(self, kept: Kept, by: Sequence[str] | None = None, count_col: str = "cohort_retained") -> DataFrame:
        """Distinct entities per cohort and period, or per fewer keys (``by``), from the state alone."""
        return bm.counts(kept.sets, self.keys if by is None else list(by), count_col, kept.retired)
