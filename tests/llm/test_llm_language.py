"""Held-out accuracy, and what is not a language."""

import random

import numpy as np

from rankloom.llm.language import GRID, SEED, Encoder, held_out, learn_profiles, predict_language

SYLLABLES = {"aa": ["ba", "do", "ki", "lu"], "bb": ["strü", "chen", "auf", "ge"], "cc": ["ёж", "ик", "тан", "во"]}
SCHEMA = "doc_id bigint, text string, lang string, score string"


def corpus():
    rng = random.Random(9)
    rows = []
    for i in range(240):
        lang = rng.choice(sorted(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(3, 60))]
        rows.append((i, " ".join(words), lang, "clash"))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    profiles = learn_profiles(docs.filter(~held_out(docs["doc_id"])))
    again = learn_profiles(docs.filter(~held_out(docs["doc_id"])).repartition(7))
    assert (profiles.matrix == again.matrix).all()  # whatever the partitioning
    got = {r["doc_id"]: r for r in predict_language(docs, profiles, keep=("lang",)).collect()}
    asked = [r["doc_id"] for r in docs.filter(held_out(docs["doc_id"])).collect()]
    assert len(asked) > 20 and sum(got[i]["lang_pred"] == got[i]["lang"] for i in asked) >= 0.95 * len(asked)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_odd_rows(spark):
    rows = [(1, None, "aa", ""), (2, "", "aa", ""), (3, "123 !? \n", "aa", ""), (None, "badokilu", None, ""), (5, "badokilu", "aa", ""), (5, "badokilu", "aa", ""), (6, "ёжик " * 50000, "cc", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in predict_language(docs, learn_profiles(docs)).collect()]
    assert len(got) == len(rows)
    for i, lang, score in got:
        assert (lang, score) == ("und", 0.0) if i in (1, 2, 3) else lang == ("cc" if i == 6 else "aa") and score > 0.5
    nothing = learn_profiles(docs.limit(0))
    assert {r["lang_pred"] for r in predict_language(docs, nothing).collect()} == {"und"}
    assert predict_language(docs.limit(0), nothing).count() == 0


def plain_vector(text, dimensions):
    """Bind and bundle, one n-gram and one dimension after the other."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    marked = [1, *[x for w in letters for x in [*map(ord, w), 1]]]
    if not letters:
        return None
    signs = {c: [2 * int(s) - 1 for s in np.random.default_rng((SEED, c)).integers(0, 2, dimensions)] for c in set(marked)}
    total = [0] * dimensions
    for i in range(len(marked) - 2):
        for d in range(dimensions):
            total[d] += signs[marked[i]][(d - 2) % dimensions] * signs[marked[i + 1]][(d - 1) % dimensions] * signs[marked[i + 2]][d]
    return total


def test_vectors_and_verdicts_like_plain_ones(spark):
    texts = ["The cat, the DOG.", "é1ü x", "a", "wörter und worte " * 40, "ёж", "--- 12", "", "aaa aaa"]
    encoder = Encoder(dimensions=64)
    for text in texts:
        got, want = encoder.vector(text), plain_vector(text, 64)
        assert (got is None) == (want is None) and (want is None or got.tolist() == want)
    rows = corpus()[:60]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    profiles = learn_profiles(docs.filter("doc_id < 40"), dimensions=64)
    sums = {}
    for i, text, lang, _ in rows:
        if i < 40:
            vector = plain_vector(text, 64)
            length = sum(x * x for x in vector) ** 0.5
            sums[lang] = [a + round(x / length * GRID) for a, x in zip(sums.get(lang, [0] * 64), vector)]
    cosine = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
    got = {r["doc_id"]: r for r in predict_language(docs, profiles).collect()}
    for i, text, _, _ in rows:
        vector = plain_vector(text, 64)
        best = max(sorted(sums), key=lambda lang: round(cosine(sums[lang], vector), 12))
        assert got[i]["lang_pred"] == best and abs(got[i]["score"] - max(0.0, cosine(sums[best], vector))) < 1e-9
