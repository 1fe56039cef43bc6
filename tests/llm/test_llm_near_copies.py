"""The pipeline's near copies against brute force, on planted copies."""

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from rankloom.llm import blocks
from rankloom.llm.near_copies import near_copies
from test_llm_groups import smallest_reached


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def planted():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(500)]
    texts = []
    for _ in range(40):
        words = rng.choices(vocabulary, k=rng.randint(3, 400))
        texts.append(" ".join(words))
        for _ in range(3):
            words = list(words)  # a chain: each is a copy of the one before
            for _ in range(max(1, len(words) // 70)):
                words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        texts.append(" ".join(words[: len(words) // 2]))
    rng.shuffle(texts)
    return texts + [None, "", " ", texts[0], "Two words", "two  WORDS"]


@pytest.mark.parametrize("chunk", [4, 1024])
def test_near_copies(spark, monkeypatch, chunk):
    monkeypatch.setattr(blocks.in_blocks, "__defaults__", (chunk,))
    texts = planted()
    sets = [shingles(t) for t in texts]
    similar = [(a, b) for a in range(len(sets)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    want = smallest_reached(range(len(texts)), similar)
    assert len(similar) > 100
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert {r["doc_id"]: r["component_id"] for r in near_copies(docs).collect()} == want


def test_stage_removes_near_copies(spark):
    words = [f"w{k}" for k in range(300)]
    near = [*words[:100], "changed", *words[101:200], "too", *words[201:]]
    rows = [(1, " ".join(words), "en", "s", 1), (2, " ".join(near), "en", "s", 1), (3, " ".join(words[:150]), "en", "s", 1), (None, " ".join(near), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 3]


def test_candidates_come_from_simhash(spark, monkeypatch):
    """Pairs of similarity 0.8, short ones included, are within the radius and meet in a run of the fingerprint."""
    from rankloom.llm import simhash

    monkeypatch.setattr(simhash, "RUN_ROWS", 8)
    rng = random.Random(6)
    make, prints, pairs = simhash.WideHash(), [], []
    for size in [4, 8, 20, 100, 400] * 12:
        whole = [rng.getrandbits(64) for _ in range(size + size // 4)]
        pairs.append((len(prints), len(prints) + 1))
        prints += [make(np.array(sorted(s), np.uint64)) for s in (whole, whole[:size])]
    classes = spark.createDataFrame(list(enumerate(map(bytearray, prints))), "class bigint, print binary").repartition(3).cache()
    found = {(r["b"], r["a"]) for r in simhash.near_prints(classes).filter("direct").collect()}
    assert found == set(pairs)
    assert all(simhash.wide_distances(*(simhash.print_matrix(pa.array([prints[k]])) for k in p))[0] <= simhash.within(simhash.WIDE) for p in pairs)
