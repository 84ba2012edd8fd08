"""Window dedup, importance resampling and conversation repair: against their SQL
on small tables with every edge case, and against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cadence.llm import conversation_repair as cr
from cadence.llm import importance, queries, substring_dedup
from tests.harness import compare, duck_connect

from .conftest import SCHEMA, rows, words

TURNS = "conv_id long, turn long, role string, text string"
NEW = ("op11_substring_dedup", "op12_importance", "op13_conversation_repair")


def turns():
    rng = random.Random(11)
    out = [
        (None, None, None, None),
        (None, 1, "user", "Hello there."),
        (None, 1, "user", "Hello there."),
        (100, None, "assistant", " \n\t"),
        (101, 0, "", "no initial."),
        (102, 3, "tool", "other role."),
        (103, 0, "system", "Only this."),
        (104, 0, "user", "x" * 50_000 + "."),
        (104, 1, "assistant", "ends in a separator. "),
    ]
    said = ["Yes.", "No!", "Why?", "cut off", "so it goes on and", " ", "Fine. ", "été.", "a\nb."]
    for conv in range(60):
        for turn in range(rng.randint(0, 12)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "umpire", None])
            at = None if rng.random() < 0.1 else turn * rng.choice([1, 1, 2])
            out.append((conv, at, role, rng.choice([*said, None, f"line {rng.randint(0, 99)}."])))
    return out


def texts():
    """The shared fixture, and texts with passages of 34 to 80 words in common, some periodic."""
    rng = random.Random(7)
    passages = [" ".join(f"p{k}x{i}" for i in range(n)) for k, n in enumerate((34, 35, 36, 60, 80))]
    out = rows()
    for i in range(40):
        body = [rng.choice(passages) if rng.random() < 0.4 else words(100 + rng.randint(0, 30), 20) for _ in range(5)]
        out.append((20 + i, "\t".join(body), "en", "a", 1, None, None))
    out += [
        (70, "la " * 120, "fr", "a", 1, None, None),
        (71, "un deux " * 90, "fr", "a", 1, None, None),
        (72, "Été " * 40 + "  ÀB " + "z" * 5_000, "fr", "a", 1, None, None),
        (73, "!!! ... ---", "fr", "a", 1, None, None),
    ]
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    made = tmp_path_factory.mktemp("tables")
    for name, data, schema in (
        ("documents", texts(), SCHEMA),
        ("benchmark", [(1, words(1, 50)), (2, None), (3, "la la un deux")], "item_id long, text string"),
        ("conversations", turns(), TURNS),
    ):
        # One file each, as the harness reads it.
        pq.write_table(spark.createDataFrame(data, schema).toArrow(), made / f"{name}.parquet")
    return str(made)


@pytest.fixture(scope="module")
def empty_folder(spark, tmp_path_factory):
    made = tmp_path_factory.mktemp("empty")
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id long, text string"), ("conversations", TURNS)):
        spark.createDataFrame([], schema).coalesce(1).write.parquet(str(made / f"{name}.parquet"))
    return str(made)


@pytest.mark.parametrize("name", NEW)
def test_query_equals_its_sql_on_edge_cases(spark, folder, name):
    res = compare(queries.QUERIES[name](spark, folder), duck_connect(folder), queries.ORACLE_SQL[name])
    assert res["ok"], res


@pytest.mark.parametrize("name", NEW)
def test_query_of_empty_tables_is_empty(spark, empty_folder, name):
    assert queries.QUERIES[name](spark, empty_folder).collect() == []


def brute_windows(bodies, width):
    split = [(b or "").encode().split() for b in bodies]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for body, w in zip(bodies, split):
        gone = {
            i + j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(width)
        }
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((None if body is None else kept, len(w), len(gone)))
    return out


@pytest.mark.parametrize("width,bucket_windows,rows_per_task", [(3, 1, 2), (8, 5, 3), (8, 100_000, 1_000_000), (35, 20, 5)])
def test_windows_equal_brute_force_also_in_hot_buckets(spark, tmp_path, width, bucket_windows, rows_per_task):
    rng = random.Random(width)
    bodies = [" ".join(rng.choice("abcde") * rng.randint(1, 2) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    bodies += [r[1] for r in texts()]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, text string").repartition(4)
    df = df.withColumn("n_words", F.lit("clash")).withColumn("UID_", F.lit(1)).withColumn("gram", F.lit(2))
    df.write.parquet(str(tmp_path / "docs"))
    df = spark.read.parquet(str(tmp_path / "docs"))
    out = substring_dedup.remove_repeated(df, width, bucket_windows=bucket_windows, rows_per_task=rows_per_task)
    assert out.columns == ["i", "text", "UID_", "gram", "n_words", "n_removed"]
    got = {r["i"]: (r["text"], r["n_words"], r["n_removed"]) for r in out.collect()}
    want = dict(enumerate(brute_windows(bodies, width)))
    assert got == want


def test_position_table_equals_crc32():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 60_000).astype(np.uint8)
    lengths = np.concatenate([np.arange(1, 200), rng.integers(1, 700, 500), [50_000]])
    starts = rng.integers(0, len(data) - 50_000, len(lengths))
    got = importance.crc32_spans(data, starts, starts + lengths)
    assert got.tolist() == [zlib.crc32(data[s : s + n].tobytes()) for s, n in zip(starts, lengths)]


def test_resample_gives_whole_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    target = spark.read.parquet(f"{folder}/benchmark.parquet")
    got = importance.resample(docs, target, percent=30)
    ranks = queries.op12_importance(spark, folder)
    assert got.columns == docs.columns
    large = [r for r in importance.weigh(docs, np.zeros(10_000, dtype=np.int64)).collect() if r["n_words"] >= 20]
    assert got.count() == 30 * len(large) // 100
    # A draw of more rows begins with the rows of a smaller one.
    few = {r["doc_id"] for r in ranks.where("rank is not null").collect()}
    assert few <= {r["doc_id"] for r in got.collect()}


def cheapest(conversation):
    """(cost, audit) by trying every list of edits with at most three insertions."""
    best = None

    def walk(i, state, inserts, cost, audit):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if inserts < 3:
            walk(i, cr.STEP[state, cr.NEXT[state]], inserts + 1, cost + 5, audit + "I")
        if i == len(conversation):
            if state in (cr.EMPTY, cr.ASSISTANT) and (best is None or (cost, audit) < best):
                best = (cost, audit)
            return
        role, fault = conversation[i]
        walk(i + 1, state, inserts, cost + 2, audit + "D")
        if fault in ("blank", "duplicate"):
            return
        stays = 5 if fault == "truncated" else 0
        if (state, role[:1]) in cr.STEP:
            walk(i + 1, cr.STEP[state, role[:1]], inserts, cost + stays, audit + "K")
        walk(i + 1, cr.STEP[state, cr.NEXT[state]], inserts, cost + 1 + stays, audit + "R")

    walk(0, cr.EMPTY, 0, 0, "")
    return best


def some_conversations(n, longest, seed):
    rng = random.Random(seed)
    for _ in range(n):
        yield [
            (rng.choice(["system", "user", "assistant", "tool"]), rng.choice([None, None, None, "truncated", "blank"]))
            for _ in range(rng.randint(0, longest))
        ]


def audited(conversation, undecided=cr.UNDECIDED):
    c = cr.Conversation(True, undecided)
    for k, (role, fault) in enumerate(conversation):
        c.add(k, role, f"{k}.", fault)
    done = c.close()
    return done["cost"], done["audit"], done["repaired_sha256"], list(c.turns)


def test_audit_is_the_cheapest_and_least_of_all():
    for conversation in some_conversations(250, 6, 5):
        assert audited(conversation)[:2] == cheapest(conversation)


def test_audit_in_parts_and_with_colliding_hashes(monkeypatch):
    conversations = list(some_conversations(150, 90, 6))
    whole = [audited(c) for c in conversations]
    assert [audited(c, undecided=4) for c in conversations] == whole
    monkeypatch.setattr(cr, "MODULUS", 3)
    assert [audited(c) for c in conversations] == whole


def test_long_conversation_keeps_little(monkeypatch):
    rng = random.Random(9)
    c = cr.Conversation(False)
    most = 0
    for k in range(60_000):
        c.add(k, rng.choice(["user", "assistant", "system"]), "x.", rng.choice([None, None, "truncated", "duplicate"]))
        most = max(most, len(c.waiting))
    assert most <= 2 * cr.UNDECIDED
    assert len(c.close()["audit"].replace("I", "")) == 60_000


def test_repaired_turns_follow_the_audit(spark, folder):
    docs = queries.damaged(spark.read.parquet(f"{folder}/conversations.parquet"))
    audits = {r["conv_id"]: r for r in cr.audit(docs, present=F.col("here_")).collect()}
    fixed = cr.repair(docs, present=F.col("here_")).collect()
    for conv, row in audits.items():
        mine = sorted((r["place"], r["edit"], r["role"]) for r in fixed if r["conv_id"] == conv)
        assert "".join(e for _, e, _ in mine) == row["audit"].replace("D", "")
        initials = "".join(r[0] for _, _, r in mine)
        assert initials.removeprefix("s").replace("ua", "") == ""
