"""The pipeline's stages, each against a plain version on the edge-case table, and the whole run."""

import shutil
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as cp
from cadence.llm import near_dup, queries, toxicity
from tests.conftest import SF001

from .conftest import rows
from .test_documents import components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "score_", "uid_"]


def table_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def plain_lines(data):
    """Every line of a pair of neighbouring lines that stood before goes; texts left blank by it go."""
    order = sorted(range(len(data)), key=lambda i: (data[i][0] is None, data[i][0] or 0, i))
    seen, gone = set(), defaultdict(set)
    for i in order:
        lines = (data[i][1] or "").split("\n")
        mine = [tuple(lines[a : a + 2]) for a in range(len(lines) - 1)]
        for a, pair in enumerate(mine):
            if pair in seen:
                gone[i] |= {a, a + 1}
            seen.add(pair)
    out = []
    for i, row in enumerate(data):
        if i in gone:
            text = "\n".join(x for a, x in enumerate(row[1].split("\n")) if a not in gone[i])
            if text.strip(cp.WHITE):
                out.append((row[0], text, row[2], row[3], len(text), *row[5:]))
        else:
            out.append(row)
    return sorted(out, key=str)


def test_line_stage(spark, docs):
    assert table_of(cp.drop_repeated_chunks(spark, docs, SF001)) == plain_lines(rows())


def test_line_stage_drops_what_is_blank_by_it(spark):
    data = [(1, "a b\nc d\ne f", "en", "s", 11, None, None), (2, "\n\na b\nc d\n\n", "en", "s", 11, None, None)]
    data += [(3, "\n \t\n", "en", "s", 4, None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, score_ string, uid_ int")
    got = table_of(cp.drop_repeated_chunks(spark, df.coalesce(1), SF001))
    assert got == plain_lines(data) and {r[0] for r in got} == {1, 3}


def test_toxicity_stage(spark, docs):
    model = queries.toxicity_model(spark, SF001)
    scored = toxicity.score(docs, model, out="p").collect()
    want = sorted((tuple(r[c] for c in COLUMNS) for r in scored if r["p"] < cp.TOXIC_AT), key=str)
    assert table_of(cp.drop_toxic(spark, docs, SF001)) == want and want


def test_near_copies_stage(spark, docs):
    by_id = {}
    for doc, _, component in components([(r[0], r[1]) for r in rows()]):
        by_id.setdefault(doc, component)
    worded = [r for r in rows() if near_dup.words_of(r[1])]
    # The first row of each component, and every row without words.
    firsts = {}
    for r in sorted(worded, key=lambda r: (r[0] is None, r[0] or 0)):
        firsts.setdefault((by_id[r[0]], r[0] is None), r)
    want = [*firsts.values(), *[r for r in rows() if not near_dup.words_of(r[1])]]
    assert table_of(cp.drop_near_copies(spark, docs, SF001)) == sorted(want, key=str)


def test_mixing_stage(spark, docs):
    got = cp.mix_sources(spark, docs, SF001)
    taken = Counter()
    texts = {(r[0], r[3]): (r[1] or "").split() for r in rows()}
    for r in got.collect():
        words = r["text"].split()
        whole = texts[r["doc_id"], r["source"]]
        assert words == whole[: len(words)] and words
        taken[r["doc_id"], r["source"]] += len(words)
    copies = Counter((r[0], r[3]) for r in rows())
    assert got.columns == COLUMNS
    for key, n in taken.items():
        assert n <= 2 * len(texts[key]) * copies[key]


def test_packing_stage(spark, docs):
    pieces = cp.pack_tokens(spark, docs, SF001).collect()
    fill = defaultdict(list)
    for r in pieces:
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= cp.SEQUENCE
    ends = sum(r["start"] + r["length"] == r["doc_tokens"] for r in pieces)
    assert ends == len(rows())


@pytest.mark.parametrize("stage", [f for _, f in cp.STAGES])
def test_stages_of_an_empty_table(spark, none, stage):
    assert stage(spark, none, SF001).count() == 0


def test_whole_run(spark, tmp_path):
    """On a folder with the edge cases as documents: as the stages one after another, and no rows of none."""
    for name, data in (("some", rows()), ("none", [])):
        folder = tmp_path / name
        folder.mkdir()
        shutil.copy(f"{SF001}/labels.parquet", folder / "labels.parquet")
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        df = spark.createDataFrame([r[:5] for r in data], schema).coalesce(1)
        df.write.parquet(str(folder / "documents.parquet"))
        found = cp.run(spark, str(folder)).collect()
        assert bool(found) == bool(data)
        if data:
            kept = {r["doc_id"] for r in found}
            # One of the copies 1 to 3, the long text, both passages' documents; nothing without words.
            assert {1, 8, 9, 10} <= kept and not {2, 3, 4, 5, 6} & kept
