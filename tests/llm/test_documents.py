"""Operators on documents against brute force, edge cases included."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cadence.llm import fingerprint, langid, line_dedup, mixing, near_dup, packing, queries, toxicity

from .conftest import rows


def shingles(text, width=5):
    w = near_dup.words_of(text)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def components(texts):
    sets = [shingles(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    groups = defaultdict(list)
    for i, (d, _) in enumerate(texts):
        groups[find(i)].append(d)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(texts)), key=str)


def test_jaccard_join_equals_brute_force(spark, docs):
    got = near_dup.link(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == components([(r[0], r[1]) for r in rows()])


@pytest.mark.parametrize("block", [50, 1 << 20])
@pytest.mark.parametrize("pivots", [0, 2])
def test_jaccard_join_on_clusters(spark, block, pivots, monkeypatch):
    """Also in small blocks, and with all links left to the neighbourhoods."""
    monkeypatch.setattr(near_dup, "BLOCK_ELEMENTS", block)
    monkeypatch.setattr(near_dup, "PIVOTS", pivots)
    rng = np.random.default_rng(3)
    texts = []
    for c in range(6):
        base = [f"t{rng.integers(400)}" for _ in range(int(rng.integers(6, 80)))]
        for _ in range(6):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(len(w)))] = f"t{rng.integers(400)}"
            texts.append((len(texts), " ".join(w)))
    # Copies near the threshold to one another, and texts put together from common passages.
    base = [f"t{i}" for i in range(90)]
    for _ in range(25):
        w = list(base)
        for _ in range(int(rng.integers(1, 5))):
            w[int(rng.integers(len(w)))] = f"u{rng.integers(9)}"
        texts.append((len(texts), " ".join(w)))
    passages = [" ".join(f"p{k}x{i}" for i in range(12)) for k in range(6)]
    for _ in range(25):
        texts.append((len(texts), " ".join(passages[k] for k in rng.choice(6, int(rng.integers(1, 6)), replace=False))))
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(3)
    got = near_dup.link(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == components(texts)


def test_near_copies_drop_to_one_row(docs, none):
    left = near_dup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.where("doc_id <= 3").collect()) == [1]
    assert near_dup.drop_copies(none).count() == 0


def test_line_dedup_equals_brute_force(docs, none):
    out = line_dedup.remove_repeated(docs)
    got = sorted(((r["doc_id"], r["text"], r["removed_lines"]) for r in out.collect()), key=str)
    places, order = defaultdict(list), sorted(range(len(rows())), key=lambda i: (rows()[i][0] is None, rows()[i][0] or 0))
    for rank, i in enumerate(order):
        lines = (rows()[i][1] or "").split("\n")
        if len(lines) > 1:
            h = [xxhash.xxh3_64_intdigest(x.encode()) for x in lines]
            for a, b in {s for seed in (1, 2) for s in line_dedup.chunks(h, seed, 2, 3, 2)}:
                places["\n".join(lines[a:b])].append((rank, a, b, i))
    gone = defaultdict(set)
    for found in places.values():
        for _, a, b, i in sorted(found)[1:]:
            gone[i] |= set(range(a, b))
    want = []
    for i, r in enumerate(rows()):
        text = r[1] if r[1] is None else "\n".join(x for j, x in enumerate(r[1].split("\n")) if j not in gone[i])
        want.append((r[0], text, len(gone[i])))
    assert got == sorted(want, key=str) and gone
    assert line_dedup.remove_repeated(none).count() == 0


def test_line_dedup_finds_every_repeated_run(spark, tmp_path):
    """Passages of 2 to 15 lines with different surroundings go whole, but for their first place."""
    data, gone = [], {}
    for n in range(2, 16):
        for trial in range(10):
            passage = [words_at(n, trial, i) for i in range(n)]
            for copy in range(2):
                own = [words_at(n, trial, 100 + 50 * copy + i) for i in range(2 * copy + 6)]
                at = 1 + (trial + copy) % (len(own) - 1)
                gone[len(data)] = own if copy else own[:at] + passage + own[at:]
                data.append((len(data), "\n".join(own[:at] + passage + own[at:])))
    spark.createDataFrame(data, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op4_line_dedup(spark, str(tmp_path)).collect()}
    for i, text in data:
        assert got[i]["text"].split("\n") == gone[i]
        assert got[i]["removed_lines"] == len(text.split("\n")) - len(gone[i])


def words_at(*key):
    return f"line {zlib.crc32(str(key).encode())} of {key}"


def test_fingerprints_estimate_and_edit(docs, none):
    texts = sorted(((d, t or "") for d, t, *_ in rows()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    got = sorted(fingerprint.edit_check(docs).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    for k, (d, t) in enumerate(texts):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + texts[(k + 1) % len(texts)][1][:cut]
        a, b = shingles_cased(t), shingles_cased(edited)
        assert got[k]["doc_id"] == d and got[k]["n_chars"] == len(t)
        assert got[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(got[k]["near_edited"] - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.2
    assert got[0]["near_next"] == 1.0 and got[0]["fingerprint"] == got[1]["fingerprint"]
    assert fingerprint.edit_check(none).count() == 0


def shingles_cased(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_merged_sketches_equal_the_sketch_of_the_whole(spark):
    df = spark.createDataFrame([(1, i, f"p{i} q{i} r{i} s{i} t{i} u{i}") for i in range(300)], "g int, i int, text string")
    parts = fingerprint.add_sketch(df, "text", "sk", 64)
    merged = fingerprint.merge_sketches(parts, ["g"], "sk", 64).first()["sk"]
    assert merged == sorted({h for r in parts.collect() for h in r["sk"]})[:64]
    n = spark.range(1).select(fingerprint.distinct(F.array(*[F.lit(x) for x in merged]), 64)).first()[0]
    assert 350 < n < 1000


def test_mix_meets_targets(docs, none):
    got = mixing.mix(docs, block=1).collect()
    assert len(got) == len(rows()) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    assert math.isclose(sum(v[0]["target"] for v in by.values()), 1.5 * sum(r["size"] for r in got))
    for v in by.values():
        assert v[0]["target"] <= 2 * v[0]["source_size"] and abs(sum(r["taken"] for r in v) - v[0]["target"]) <= 2
    again = mixing.mix(docs, block=1).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(none).count() == 0
    made = mixing.materialize(mixing.mix(docs, block=1), docs.columns)
    assert made.columns == docs.columns
    assert made.select(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0] == sum(r["taken"] for r in got)


def test_apportionment_is_sainte_lague(spark):
    weights = {1: 53.0, 2: 24.0, 3: 23.0, 4: 0.5, 5: 12.5}
    df = spark.createDataFrame([(0, k, w, 17) for k, w in weights.items()], "grp int, key int, weight double, seats long")
    got = {r["key"]: r["quota"] for r in mixing.apportion(df).collect()}
    best = sorted(((-w / (2 * s + 1), k) for k, w in weights.items() for s in range(17)))[:17]
    assert got == {k: sum(x[1] == k for x in best) for k in weights}


def test_packing_round_trip(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    odd = ["It's ΑΣ Σ e\u0301 ﬁ 日本 <|endoftext|> a\u00a0b\u2003c\x1cd \u0130 don't 12³ ½", "naïve CAFÉ, straße!\r\n\x0b«x»"]
    more = docs.sparkSession.createDataFrame([(90 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(more)
    pieces = packing.pack(both, path, 2, length=64)
    got = pieces.collect()
    whole = sorted([r[1] or "" for r in rows()] + odd)
    want = sorted(np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes() for t in whole)
    stream = defaultdict(dict)
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        stream[r["sequence_id"]][r["offset"]] = r
    flat, docs_out = [], []
    for s in sorted(stream):
        at = 0
        for o in sorted(stream[s]):
            assert o == at
            at += stream[s][o]["length"]
            flat.append(stream[s][o])
        assert at == 64 or s == max(stream)
    for r in flat:
        if r["start"] == 0:
            docs_out.append(b"")
        docs_out[-1] += r["ids"]
    assert sorted(docs_out) == want
    packed = packing.sequences(pieces, 64).collect()
    assert len(packed) == len(stream) and all(len(r["ids"]) == 64 or r["n_tokens"] & (r["n_tokens"] - 1) == 0 for r in packed)
    assert packing.pack(none, path, 2).count() == 0


def test_language_of_held_out_texts(spark, docs, none):
    vocab = {"aa": ["mona", "tiva", "rolu"], "bb": ["skeg", "drumf", "plix"]}
    data = [(i, " ".join(vocab[c][(i + j) % 3] for j in range(6)), c) for i in range(40) for c in vocab]
    model = langid.train(spark.createDataFrame(data, "id_ long, text_ string, lang_ string"))
    tests = spark.createDataFrame([(1, "mona rolu"), (2, "skegs drumfy"), (3, "123 !"), (4, None), (5, "")], "doc_id int, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(tests, model).collect()}
    assert got[1][0] == "aa" and got[2][0] == "bb" and got[1][1] > 0.5
    assert got[3] == got[4] == got[5] == ("und", 0.0)
    assert langid.identify(docs, model).count() == len(rows()) and langid.identify(none, model).count() == 0
    empty = langid.train(spark.createDataFrame([], "id_ long, text_ string, lang_ string"))
    assert {r["lang_pred"] for r in langid.identify(tests, empty).collect()} == {"und"}


def test_toxicity_tolerates_gaps(spark, docs, none):
    clean = ["the river runs north", "green hills and towns", "we met the baker today", "a long road home"]
    data = [(i, f"{clean[i % 4]}. the {['worthless', 'pathetic'][i % 2]} baker today. {clean[(i + 1) % 4]}", 1) for i in range(30)]
    data += [(100 + i, f"{clean[i % 4]}. {clean[(i + 2) % 4]}", 0) for i in range(60)]
    model = toxicity.train(spark.createDataFrame(data, "id_ long, text_ string, toxic_ int"))
    tests = ["so worthless", "so wor*thless", "p a t h e t i c", "patthetic", "the hills", None, ""]
    df = spark.createDataFrame(list(enumerate(tests)), "i int, text string")
    p = [r["score"] for r in toxicity.score(df, model).orderBy("i").collect()]
    assert min(p[:4]) > 0.5 > max(p[4:]) and all(0 <= x <= 1 for x in p)
    assert toxicity.score(docs, model, out="score_").columns[:5] == docs.columns[:5]
    assert toxicity.score(none, model).count() == 0
    one = toxicity.train(spark.createDataFrame([(1, "x", 0)], "id_ long, text_ string, toxic_ int"))
    assert all(r["score"] < 0.5 for r in toxicity.score(df, one).collect())


def test_toxicity_reads_through_marks(spark):
    clean = ["the river runs north", "green hills and towns", "we met the baker today", "a long road home"]
    insults = ["worthless", "pathetic", "idiot", "moron"]
    data = [(i, f"{clean[i % 4]}. the {insults[i % 4]} baker today. {clean[(i + 1) % 4]}", 1) for i in range(60)]
    data += [(100 + i, f"{clean[i % 4]}. {clean[(i + 2) % 4]}", 0) for i in range(120)]
    model = toxicity.train(spark.createDataFrame(data, "id_ long, text_ string, toxic_ int"))
    marked = ["i*di*ot", "id--iot", "i.d.i.o.t", "mo.r.on", "pa.th.et.ic", "p.a.t.h.e.t.i.c", "w-o-r-t-h-l-e-s-s"]
    marked += ["i\u00a0d\u00a0i\u00a0o\u00a0t", "m\no\nr\no\nn"]
    tests = ["so " + w for w in marked] + ["so idi0t", "so", *clean]
    df = spark.createDataFrame(list(enumerate(tests)), "i int, text string")
    p = [r["score"] for r in toxicity.score(df, model).orderBy("i").collect()]
    n = len(marked)
    assert min(p[:n]) > 0.5 > max(p[n + 1 :]) and p[n] > p[n + 1]
    (near,) = toxicity.Kernel(("idiot",)).values(["idi0t"]).values()
    assert 0.25 < near[0] < 0.35
