"""Language identification against a plain-Python model of its definition, whole texts and letters."""

import math
import random
from collections import Counter

import pytest
import regex

from cadence.llm import langid

WORDS = regex.compile(r"\p{L}+").findall
SYLLABLES = {"aa": "ka lo mi tu re".split(), "bb": "sch ung en ver ko".split(), "cc": "que la eau tion ka".split()}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def plain_model(rows, words_per_lang, grams_per_lang, longest):
    langs = sorted({lang for _, text, lang in rows if WORDS(text.lower())})
    counted = Counter((lang, w) for _, text, lang in rows for w in WORDS(text.lower()))

    def logs(counts, most):
        chosen = {}
        for lang in langs:
            mine = sorted(((-n, k) for (g, k), n in counts.items() if g == lang))[:most]
            for n, k in mine:
                chosen.setdefault(k, dict.fromkeys(langs, 1))[lang] += -n
        total = {lang: sum(v[lang] for v in chosen.values()) for lang in langs}
        return {k: [math.log(v[g]) - math.log(total[g]) for g in langs] for k, v in chosen.items()}

    known = logs({k: n for k, n in counted.items() if n > 1}, words_per_lang)
    tables = []
    for size in range(longest, 0, -1):
        grams = Counter()
        for (lang, w), n in counted.items():
            padded = f" {w} "
            for i in range(len(padded) - size + 1):
                grams[lang, padded[i : i + size]] += n
        tables.append((size, logs(grams, grams_per_lang)))
    return langs, known, tables


def plain_identify(model, text):
    langs, known, tables = model
    found = WORDS((text or "").lower())
    if not found:
        return "und", 0.0
    total = [0.0] * len(langs)
    for w in found:
        row = known.get(w)
        cost = 0.0
        for size, table in tables if row is None else ():
            padded = f" {w} "
            hits = [table[g] for i in range(len(padded) - size + 1) if (g := padded[i : i + size]) in table]
            if hits:
                row = [sum(x) / len(hits) + cost for x in zip(*hits)]
                break
            cost += math.log(0.4)
        total = [a + b for a, b in zip(total, row or [0.0] * len(langs))]
    best = max(range(len(langs)), key=lambda i: total[i])
    return langs[best], 1 / sum(math.exp(t - total[best]) for t in total)


@pytest.mark.parametrize("words,grams", [(40, 30), (None, None)])
def test_equals_its_definition(spark, words, grams):
    rng = random.Random(12)
    rows = [(i, prose(rng, lang, rng.randint(3, 40)), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 12)]
    tests = [prose(rng, rng.choice("abc") * 2, rng.randint(1, 12)) for _ in range(60)] + ["kaung xyz", "Ä", "", None, "12 ½"]
    bounds = langid.Bounds(words_per_lang=words, grams_per_lang=grams)
    model = langid.train(spark.createDataFrame(rows, "id_ long, text_ string, lang_ string"), bounds)
    got = langid.identify(spark.createDataFrame(list(enumerate(tests)), "i int, text string"), model).collect()
    plain = plain_model(rows, words, grams, 5)
    for r in got:
        lang, score = plain_identify(plain, tests[r["i"]])
        assert r["score"] == pytest.approx(score, rel=1e-9)
        assert r["lang_pred"] == lang or math.isclose(score, 0.5)


def test_the_end_of_a_long_text_counts(spark):
    """A language known only from beyond the first 20,000 characters of its text."""
    tail = " ".join(["schungen", "verkoen"] * 50)
    rows = [(1, "12 34 " * 8_000 + tail, "bb"), (2, "kalo mitu " * 60, "aa")]
    model = langid.train(spark.createDataFrame(rows, "id_ long, text_ string, lang_ string"))
    got = langid.identify(spark.createDataFrame([(1, "verkoen"), (2, "mitu")], "i int, text string"), model)
    assert {r["i"]: r["lang_pred"] for r in got.collect()} == {1: "bb", 2: "aa"}


def test_only_letters_are_letters(spark):
    model = langid.train(spark.createDataFrame([(1, "kalo mitu kalo", "aa"), (2, "verko verko", "bb")], "id_ long, text_ string, lang_ string"))
    texts = ["½ ²", "Ⅷ", "１２ _ 34", "№", "!?"]
    got = langid.identify(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
