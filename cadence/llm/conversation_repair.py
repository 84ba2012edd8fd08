"""Repair of the structure of conversations by the cheapest edits.

The rows of a conversation, in order of their turns, are to read
``(system? (user assistant)+)?`` by the initials of their roles. Each row is
Kept (free), Reroled to user or assistant (1) or Deleted (2; the only choice
for blank and duplicate rows); empty user or assistant rows are Inserted
anywhere (5 each); a truncated row that stays costs 5 more. The audit is the
edits' initials in order; among cheapest ones the ASCII-least counts.

A dynamic program over the states empty / system / user / assistant keeps the
best audit for each. Audits share their prefixes: each is a node with one edit,
its depth, a rolling hash of the whole audit and binary-lifting ancestors.
Equal costs are decided by the edit after the longest common prefix, which
lifting finds by comparing hashes; a prefix found equal that way is verified
edit by edit down to the node that both share.

Two audits of one cost at one row never are prefixes of one another (the rest
would be insertions, which cost), so the smaller stays smaller whatever
follows. A state dearer by more than ``HOPELESS`` than another can be left: the
other reaches any end for less. When the living states' audits agree on a
long prefix, its edits are applied to the waiting rows and let go, so a very
long conversation needs the memory of its undecided part only.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from .common import col

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
# Any state can follow another's edits after at most two insertions and one deletion.
HOPELESS = 2 * INSERT + DELETE
# Edits of the undecided part above which its common prefix is looked for.
UNDECIDED = 2_048

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"u": "user", "a": "assistant"}
# From a state, an initial leads to a state.
STEP = {
    (EMPTY, "s"): SYSTEM,
    (EMPTY, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
# The one initial besides s that may follow a state.
NEXT = {EMPTY: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ADJACENT = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"

BASE = 1_000_003
MODULUS = (1 << 61) - 1


class Audit:
    """The last edit of a shared list of edits."""

    __slots__ = ("edit", "depth", "hash", "up")

    def __init__(self, parent: Audit | None, edit: str):
        self.edit = edit
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + ord(edit)) % MODULUS
        up = [parent]
        for k in range(64):  # the 2^k-th ancestor's own 2^k-th ancestor
            if k >= len(up[k].up):
                break
            up.append(up[k].up[k])
        self.up = tuple(up)

    def at(self, depth: int) -> Audit:
        """The ancestor of this depth."""
        node, left = self, self.depth - depth
        while left:
            k = left.bit_length() - 1
            node, left = node.up[k], left - (1 << k)
        return node

    def edits(self) -> str:
        out, node = [], self
        while node.depth:
            out.append(node.edit)
            node = node.up[0]
        return "".join(reversed(out))


def _same(x: Audit, y: Audit) -> bool:
    """Whether two audits of one depth are equal, edit by edit down to the node that both share."""
    while x is not y:
        if x.edit != y.edit:
            return False
        if not x.depth:
            break
        x, y = x.up[0], y.up[0]
    return True


def less(x: Audit, y: Audit) -> bool:
    """Whether the edits of ``x`` come before those of ``y`` in ASCII order."""
    depth = min(x.depth, y.depth)
    a, b = x.at(depth), y.at(depth)
    if a.hash == b.hash:
        if _same(a, b):
            return x.depth < y.depth
        return x.edits() < y.edits()
    for k in reversed(range(len(a.up))):
        if k < len(a.up) and a.up[k].hash != b.up[k].hash:
            a, b = a.up[k], b.up[k]
    if not _same(a.up[0], b.up[0]):  # equal hashes of different prefixes
        return x.edits() < y.edits()
    return a.edit < b.edit


class Conversation:
    """The program over one conversation, fed row by row."""

    def __init__(self, keep_turns: bool, undecided: int = UNDECIDED):
        self.best: dict[int, tuple[int, Audit]] = {}
        self._offer(self.best, EMPTY, 0, Audit(None, ""))
        self._insert(self.best)
        self.limit = self.step = undecided
        self.waiting: list[tuple[str, str]] = []
        self.audit: list[str] = []
        self.state, self.first, self.sha = EMPTY, True, hashlib.sha256()
        self.turns: list[tuple[str, str, str]] | None = [] if keep_turns else None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None
        self.low = self.high = self.turn = None
        self.distinct = 0

    @staticmethod
    def _offer(best: dict[int, tuple[int, Audit]], state: int, cost: int, audit: Audit) -> bool:
        held = best.get(state)
        if held is None or cost < held[0] or (cost == held[0] and less(audit, held[1])):
            best[state] = (cost, audit)
            return True
        return False

    def _insert(self, best: dict[int, tuple[int, Audit]]) -> None:
        waiting = [s for s in (EMPTY, SYSTEM, USER, ASSISTANT) if s in best]
        while waiting:
            state = waiting.pop(0)
            cost, audit = best[state]
            to = STEP[state, NEXT[state]]
            if to in best and cost + INSERT > best[to][0]:
                continue
            if self._offer(best, to, cost + INSERT, Audit(audit, "I")) and to not in waiting:
                waiting.append(to)

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.turn
            self.high = self.turn = turn
        initial = role[:1]
        if self.before is not None and self.before + initial not in ADJACENT:
            self.illegal += 1
        self.before = initial
        if fault:
            self.faults[fault] += 1
        self.waiting.append((role, text))
        new: dict[int, tuple[int, Audit]] = {}
        stays = CUT_OFF if fault == "truncated" else 0
        for state, (cost, audit) in self.best.items():
            self._offer(new, state, cost + DELETE, Audit(audit, "D"))
            if fault in ("blank", "duplicate"):
                continue
            to = STEP.get((state, initial))
            if to is not None:
                self._offer(new, to, cost + KEEP + stays, Audit(audit, "K"))
            self._offer(new, STEP[state, NEXT[state]], cost + REROLE + stays, Audit(audit, "R"))
        self._insert(new)
        least = min(cost for cost, _ in new.values())
        self.best = {state: held for state, held in new.items() if held[0] <= least + HOPELESS}
        if max(audit.depth for _, audit in self.best.values()) >= self.limit:
            self._settle()

    def _settle(self) -> None:
        """Apply the edits that all living audits begin with and start the audits anew after them."""
        edits = {state: audit.edits() for state, (_, audit) in self.best.items()}
        known = len(os.path.commonprefix(list(edits.values())))
        if known:
            self._apply(next(iter(edits.values()))[:known])
            root = Audit(None, "")
            made: dict[str, Audit] = {"": root}
            for state, text in edits.items():
                rest = text[known:]
                for i in range(len(rest)):
                    if rest[: i + 1] not in made:
                        made[rest[: i + 1]] = Audit(made[rest[:i]], rest[i])
                self.best[state] = (self.best[state][0], made[rest])
        longest = max(audit.depth for _, audit in self.best.values())
        self.limit = max(self.step, 2 * longest)

    def _apply(self, edits: str) -> None:
        self.audit.append(edits)
        used = 0
        for edit in edits:
            role, text = "", ""
            if edit != "I":
                role, text = self.waiting[used]
                used += 1
            if edit == "D":
                continue
            if edit in "IR":
                role = ROLES[NEXT[self.state]]
            self.state = STEP[self.state, role[:1]]
            self.sha.update((("" if self.first else "\n") + role + ":" + text).encode())
            self.first = False
            if self.turns is not None:
                self.turns.append((edit, role, text))
        del self.waiting[:used]

    def close(self) -> dict:
        ends = [self.best[s] for s in (EMPTY, ASSISTANT) if s in self.best]
        cost, audit = ends[0]
        for other, rival in ends[1:]:
            if other < cost or (other == cost and less(rival, audit)):
                cost, audit = other, rival
        self._apply(audit.edits())
        return {
            "gaps": 0 if self.low is None else self.high - self.low + 1 - self.distinct,
            **self.faults,
            "illegal": self.illegal,
            "cost": cost,
            "audit": "".join(self.audit),
            "repaired_sha256": self.sha.hexdigest(),
        }


AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "place long, edit string, role string, text string"


def _ordered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str, present: Column | None) -> DataFrame:
    """Rows with their fault, each conversation's one after another in one partition: one shuffle."""
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = turns.select(
        col(conv_id).alias("conv"),
        col(turn).cast("long").alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(col(text).cast("string"), F.lit(" ")).alias("text"),
        here.alias("here"),
    )
    rows = rows.select(
        "conv", "turn", "here", *[F.when(F.col("here"), F.col(c)).otherwise("").alias(c) for c in ("role", "text")]
    ).repartition("conv")
    again = Window.partitionBy("conv", "here", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    body = F.rtrim("text", F.lit(WHITE))
    fault = (
        F.when(~F.col("here"), F.lit(None))
        .when(body == "", "blank")
        .when(F.col("seen") > 1, "duplicate")
        .when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    marked = rows.withColumn("seen", F.row_number().over(again)).withColumn("fault", fault)
    return marked.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text", "seen")


def _run(turns: DataFrame, conv_id: str, keep_turns: bool, undecided: int, **named: object) -> DataFrame:
    ordered = _ordered(turns, conv_id, **named).select("conv", "turn", "role", "text", "fault", "here")
    result = StructType.fromDDL(TURNS if keep_turns else AUDIT)
    schema = StructType([StructField("conv", turns.schema[conv_id].dataType), *result.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        name, placed = None, 0
        kind = None
        out: list[list] = []

        def turns_of() -> None:
            nonlocal placed
            for edit, role, text in now.turns:
                out.append([name, placed, edit, role, text])
                placed += 1
            now.turns.clear()

        def end() -> None:
            done = now.close()
            if keep_turns:
                turns_of()
            else:
                out.append([name, *done.values()])

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(schema)
            out.clear()
            kinds = [kind] + [pa.string() if f.dataType.simpleString() == "string" else pa.int64() for f in result.fields]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

        for batch in batches:
            kind = batch.schema.field("conv").type
            for conv, turn, role, text, fault, here in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != name:
                    if now is not None:
                        end()
                    now, name, placed = Conversation(keep_turns, undecided), conv, 0
                if here:
                    now.add(turn, role, text, fault)
            if keep_turns and now is not None:
                turns_of()
            if out:
                yield batch_of()
        if now is not None:
            end()
            yield batch_of()

    return ordered.mapInArrow(run, schema).withColumnRenamed("conv", conv_id)


def audit(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    present: Column | None = None,
    undecided: int = UNDECIDED,
) -> DataFrame:
    """One row a conversation: gaps in its turns, rows by their first fault
    (``blank``: white space only; ``duplicate``: role and text seen earlier;
    ``truncated``: last mark is not . ! or ?), ``illegal`` neighbouring roles,
    and the ``cost``, ``audit`` and hash of its repair.

    Rows go by turn, null turns first, equal turns by role and text. Null roles
    and texts count as one blank; a null conversation is one of its own; a role
    without an initial cannot be kept. Rows where ``present`` is not true only
    name their conversation: one without other rows gets zeros, an empty audit
    and the hash of an empty string. Repeated rows are duplicates, other
    columns are left aside, an empty table gives an empty one. Very long texts
    are kept whole. A conversation is one task's stream, as its hash needs, in bounded
    memory; its rows are sorted by Spark."""
    return _run(turns, conv_id, False, undecided, turn=turn, role=role, text=text, present=present)


def repair(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    present: Column | None = None,
    undecided: int = UNDECIDED,
) -> DataFrame:
    """The repaired conversations, one row a turn: ``place`` (from 0), the
    ``edit`` (K, R or I) that gave it, role and text. Cases as in ``audit``; a
    conversation of which nothing is left has no rows."""
    return _run(turns, conv_id, True, undecided, turn=turn, role=role, text=text, present=present)
