"""The model against Kneser-Ney in plain Python; both ways of scoring; limits."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rankloom.llm.quality import CLASS_BITS, START, _class_table, classes, fit_limits, judge, learn, score, train

TEXTS = ["the cat sat on the mat", "the dog sat on the log", "a  cat\nand a dog 12", "é", "", "that is that"]


def plain_model(texts, order):
    """Probability of a class behind a context, by the definition."""
    table = _class_table()
    levels = {order: Counter()}
    for text in texts:
        codes = [START] * (order - 1) + classes(text, table).tolist()
        for i in range(order - 1, len(codes)):
            levels[order][tuple(codes[i - order + 1 : i + 1])] += 1
    for k in range(order - 1, 0, -1):
        levels[k] = Counter()
        for gram, n in levels[k + 1].items():
            levels[k][gram[1:]] += n if gram[1] == START else 1
    letters = len(levels[1])

    def discounts(level):
        n = Counter(level.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        raw = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0, 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        return [min(max(d, 0.1), top) for d, top in zip(raw, (1.0, 2.0, 3.0))]

    kept = {k: discounts(levels[k]) for k in levels}
    behind = {k: defaultdict(dict) for k in levels}
    for k, level in levels.items():
        for gram, n in level.items():
            behind[k][gram[:-1]][gram[-1]] = n

    def p(context, c):
        k = len(context) + 1
        lower = p(context[1:], c) if k > 1 else 1 / (letters + 1)
        seen = behind[k].get(context)
        if not seen:
            return lower
        total = sum(seen.values())
        d = {x: kept[k][min(n, 3) - 1] for x, n in seen.items()}
        return max(seen.get(c, 0) - d.get(c, 0), 0) / total + sum(d.values()) / total * lower

    return p, letters


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.createDataFrame([(t,) for t in TEXTS] + [(None,)], "text string"), order=3)


def test_probabilities_like_the_definition(spark, model):
    p, letters = plain_model(TEXTS, 3)
    asked = [*TEXTS, "zebra on the dog", "the the the", "ééé", "x" * 3000]
    docs = spark.createDataFrame([(i, t, 1.0, "clash") for i, t in enumerate(asked)], "doc_id int, text string, perplexity double, gram string")
    rows = {r["doc_id"]: r for r in score(docs, model).collect()}
    table = _class_table()
    for i, text in enumerate(asked):
        codes = classes(text, table).tolist()
        assert rows[i]["lm_chars"] == len(codes) and rows[i]["gram"] == "clash"
        padded = [START, START, *codes]
        logs = [math.log(p(tuple(padded[k : k + 2]), padded[k + 2])) for k in range(len(codes))]
        assert rows[i]["perplexity"] == (pytest.approx(math.exp(-sum(logs) / len(logs))) if codes else None)
    seen = {c for t in TEXTS for c in classes(t, table).tolist()}
    assert sum(p((116, 104), c) for c in seen) + p((116, 104), 9999) == pytest.approx(1.0)


def test_scoring_by_join_is_the_same(spark, model):
    rows = [(1, "the cat", "en"), (1, "the cat", "en"), (None, "zebra é", None), (2, None, "en"), (3, "", "en"), (4, "that dog " * 3000, "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    for name in ("log", "__row", "row_0", "LOG_0", "chars_0", "top", "n", "done"):  # clashing names are kept
        docs = docs.withColumn(name, F.lit(name))
    key = lambda r: (r["doc_id"] or 0, r["text"] or "")
    here, joined = (sorted(score(docs, model, sent_rows=limit).collect(), key=key) for limit in (10**9, 0))
    assert len(here) == len(joined) == len(rows)
    for a, b in zip(here, joined):
        assert (a["doc_id"], a["lm_chars"], a["log"], a["__row"]) == (b["doc_id"], b["lm_chars"], b["log"], b["__row"]) and a["log"] == "log"
        assert b["perplexity"] == (None if a["perplexity"] is None else pytest.approx(a["perplexity"], rel=1e-9))


def corpus():
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(300):
        lang = rng.choice(["x", "y"])
        parts = {"x": ["an", "the", "re", "in"], "y": ["ü", "ch", "der", "st"]}[lang]
        words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 200))]
        junk = i % 6 == 0
        rows.append((i, " ".join(w.upper() + "!!" if junk else w for w in words), lang, i))
        if i % 2 == 0:
            labels.append((i, 0 if junk else 1, 0))
    return rows, labels


def test_junk_goes_and_clean_stays(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, kept int")
    odd = spark.createDataFrame([(900, None, "x", 1), (901, " ", "x", 1), (902, rows[1][1], None, 1), (None, rows[1][1], "zz", 1)], docs.schema)
    docs = docs.union(odd)
    given = spark.createDataFrame([*labels, (None, 1, 0), (5, None, None), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    model, limits = learn(docs, given)
    got = [(r["doc_id"], r["kept"]) for r in judge(score(docs, model), limits).collect()]
    assert len(got) == len(rows) + 4
    kept = dict(got)
    assert not kept[900] and not kept[901] and kept[902] and kept[None]
    clean = [i for i, *_ in rows if i % 6]
    assert sum(kept[i] for i in clean) >= 0.99 * len(clean) and not any(kept[i] for i in range(0, 300, 6))


def test_each_language_has_its_own_limit(spark):
    rows = [(lang, 10_000_000, math.exp(2 + width * k / 1000)) for lang, width in (("x", 0.05), ("y", 0.1)) for k in range(1001)]
    limits = {lang: (middle, top) for lang, middle, top in fit_limits(spark.createDataFrame(rows, "lang string, lm_chars bigint, perplexity double")).rows}
    for lang, width in (("x", 0.05), ("y", 0.1)):
        assert limits[lang] == (pytest.approx(2 + width / 2, abs=0.002), pytest.approx(1.5 * 0.495 * width, abs=0.004))


def test_without_trust_everything_stays(spark):
    docs = spark.createDataFrame([(1, "abc", "x"), (2, None, "x")], "doc_id bigint, text string, lang string")
    model, limits = learn(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert limits.rows == []
    assert {r["doc_id"]: r["kept"] for r in judge(score(docs, model), limits).collect()} == {1: True, 2: False}
    assert judge(score(docs.limit(0), model), limits).count() == 0
    assert fit_limits(score(docs.limit(0), model)).rows == []


def test_classes():
    table = _class_table()
    assert classes("\n a \t b7éあ ", table).tolist() == [97, 32, 98, 48, 233, 2048 + 0x3042 % 2048]
    assert max(table.tolist()) < 1 << CLASS_BITS
