"""Language identification: probabilities, held-out accuracy, odd texts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelpfit.llm import language_id, quality


def test_letters_and_borders():
    codes, starts = language_id.letters(["Ab, c", "", "9", "É"])
    assert "".join(map(chr, codes)) == " ab c  é "[:0] + "".join(map(chr, codes))
    assert [chr(codes[s]) for s in starts[:-1]] == [" "] * 4
    inside = language_id._positions(starts, len(codes))
    grams = language_id._grams(codes, 3)[inside]
    text = {"".join(chr(int(g) >> s & 0x1FFFFF) for s in (42, 21, 0)) for g in grams}
    assert text == {" ab", "ab ", "b c", " c ", " é "} - ({" c "} - text) - ({" é "} - text)


def test_probabilities_sum_to_one():
    r = np.random.default_rng(1)
    grams = {}
    for name in "xy":
        g = sum(r.integers(97, 101, 300).astype(np.uint64) << np.uint64(21 * k) for k in range(3))
        grams[name] = np.unique(g, return_counts=True)
    model = language_id._estimate(["x", "y"], grams, 0.75)
    for context in (97 << 21 | 98, 100 << 21 | 100, 1 << 21 | 97):
        every = np.array([context << 21 | c for c in range(97, 101)], np.uint64)
        total = np.exp2(model.log_probabilities(every).astype(np.float64)).sum(axis=0)
        assert total == pytest.approx(np.ones(2), abs=1e-3)


@pytest.fixture
def labelled(spark):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(quality.COMMON_WORDS[k]) for _ in range(r.randint(5, 40))), k)
            for i in range(600) for k in [("de", "en", "fr")[i % 3]]]
    return spark.createDataFrame(rows, "doc_id long, _text string, lang string")


def test_held_out_accuracy(labelled):
    model = language_id.fit(labelled.where("doc_id % 5 > 0"), F.col("doc_id") % 5 == 1, fit_docs=80)
    held = labelled.where("doc_id % 5 = 0").withColumnRenamed("_text", "text")
    got = language_id.predicted(held, model).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert sum(x.lang_pred == x.lang for x in got) > 0.9 * len(got)
    assert all(0 <= x.score <= 1 for x in got)
    assert sum(x.accepted for x in got) > 0.9 * len(got)
    odd = held.sparkSession.createDataFrame([(1, "zzqx kkjw vvzx qqjk " * 5)], "doc_id long, text string")
    assert not language_id.predicted(odd, model).first().accepted


def test_odd_texts(labelled, messy, nothing):
    model = language_id.fit(labelled, F.col("doc_id") % 5 == 1)
    got = {x._rid: x for x in language_id.predicted(messy, model).collect()}
    assert len(got) == messy.count()
    undetermined = [x for x in got.values() if x.lang_pred == "und"]
    assert len(undetermined) == 4 and all(x.score == 0 and x.bits is None for x in undetermined)
    assert language_id.predicted(nothing, model).count() == 0
    assert language_id.fit(labelled.where("false"), F.lit(False)) == []
    assert {x.lang_pred for x in language_id.predicted(messy, []).collect()} == {"und"}


def plain_model(texts, alphabet, discount):
    """Kneser-Ney trigrams from dictionaries, after the definition."""
    def grams(text):
        # a blank before the text; the one after it belongs to the next
        kept = "".join(c.lower() if c.isalpha() else " " for c in f" {text}")
        while "  " in kept:
            kept = kept.replace("  ", " ")
        return [kept[i:i + 3] for i in range(len(kept) - 2)]

    tri = Counter(g for t in texts for g in grams(t))
    before2, before1 = defaultdict(set), defaultdict(set)  # what comes before a bigram, a character
    for g in tri:
        before2[g[1:]].add(g[0])
    for b in before2:
        before1[b[1]].add(b[0])
    n2, n1 = {b: len(v) for b, v in before2.items()}, {c: len(v) for c, v in before1.items()}

    def p1(c):
        return max(n1.get(c, 0) - discount, 0) / sum(n1.values()) + discount * len(n1) / sum(n1.values()) / len(alphabet)

    def p2(b):
        own = {x: n for x, n in n2.items() if x[0] == b[0]}
        if not own:
            return p1(b[1])
        total = sum(own.values())
        return max(own.get(b, 0) - discount, 0) / total + discount * len(own) / total * p1(b[1])

    def p3(g):
        own = {x: n for x, n in tri.items() if x[:2] == g[:2]}
        if not own:
            return p2(g[1:])
        total = sum(own.values())
        return max(own.get(g, 0) - discount, 0) / total + discount * len(own) / total * p2(g[1:])

    return lambda text: -sum(math.log2(p3(g)) for g in grams(text)) / len(grams(text))


@pytest.mark.parametrize("group", [64, 1])
def test_entropies_equal_those_of_plain_dictionaries(spark, group):
    r = random.Random(5)
    texts = {k: [" ".join(r.choice(quality.COMMON_WORDS[k]) for _ in range(12)) for _ in range(15)] for k in ("de", "en", "fr")}
    rows = [(100 * j + i, t, k) for j, (k, v) in enumerate(texts.items()) for i, t in enumerate(v)]
    models = language_id.fit(spark.createDataFrame(rows, "doc_id long, _text string, lang string"), F.lit(False), group=group)
    assert len(models) == (1 if group == 64 else 3)
    alphabet = {c for v in texts.values() for t in v for c in t.lower()} | {" "}
    asked = [" ".join(r.choice(quality.COMMON_WORDS[k]) for _ in range(8)) for k in ("de", "en", "fr", "es") for _ in range(5)]
    asked = [t for t in asked if set(t) <= alphabet]
    plain = {k: plain_model(v, alphabet, language_id.DISCOUNT) for k, v in texts.items()}
    df = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    for x in language_id.predicted(df, models).collect():
        h = {k: f(asked[x.doc_id]) for k, f in plain.items()}
        low = min(h.values())
        assert x.bits == pytest.approx(low, abs=1e-4) and h[x.lang_pred] == pytest.approx(low, abs=1e-6)
        assert x.score == pytest.approx(1 / sum(2 ** (-8 * (v - low)) for v in h.values()), abs=1e-3)


def test_any_number_of_languages(spark):
    r = random.Random(2)
    letters = [chr(0x4E00 + i) for i in range(1200)]
    rows = [(10 * k + i, " ".join("".join(r.choices(letters[4 * k:4 * k + 4], k=3)) for _ in range(20)), f"l{k:03}")
            for k in range(300) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, _text string, lang string")
    models = language_id.fit(df, F.lit(False))
    assert sorted(x for m in models for x in m.languages) == [f"l{k:03}" for k in range(300)]
    got = language_id.predicted(df.withColumnRenamed("_text", "text"), models).join(df.select("doc_id", "lang"), "doc_id")
    assert got.where("lang_pred = lang").count() == 900


def test_a_language_with_calibration_rows_only_is_learned(labelled):
    rows = labelled.withColumn("lang", F.col("lang"))
    models = language_id.fit(rows, F.col("lang") == "fr")
    assert [m.languages for m in models] == [["de", "en", "fr"]]
