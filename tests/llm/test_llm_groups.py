"""Components, fingerprints and vectors against brute force."""

import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from rankloom.llm import blocks, embedding_dedup
from rankloom.llm.components import components, smallest_labels
from rankloom.llm.embedding_dedup import near_vectors
from rankloom.llm.simhash import fingerprint, near_duplicates

xxhash = pytest.importorskip("xxhash")


def smallest_reached(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(500, k) for k in range(501, 560)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    links += [(7, 7), (61, 60), (60, 61), (60, 61)]
    table = spark.createDataFrame(links + [(None, 1), (1, None)], "a bigint, b bigint").repartition(5)
    want = smallest_reached({n for pair in links for n in pair}, links)
    got = {r["node"]: r["component"] for r in components(table).collect()}
    assert got == {n: c for n, c in want.items() if n != c}
    assert components(table.limit(0)).count() == 0


def test_labels_of_chains():
    left, right = np.array([[0, 4], [4, 3], [3, 2], [2, 1]]).T
    assert smallest_labels(5, left, right).tolist() == [0, 0, 0, 0, 0]
    assert smallest_labels(3, left[:0], right[:0]).tolist() == [0, 1, 2]
    rng = np.random.default_rng(4)
    for n in (5, 40, 3000):
        for _ in range(20):
            names, apart = rng.permutation(n), rng.integers(1, n, 2)
            keep = ~np.isin(np.arange(1, n), apart)
            left, right = names[:-1][keep], names[1:][keep]
            order = rng.permutation(len(left))
            want = smallest_reached(range(n), list(zip(left.tolist(), right.tolist())))
            assert smallest_labels(n, left[order], right[order]).tolist() == [want[k] for k in range(n)]


def plain_fingerprint(text, words):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "A b", "É Ü x  y", "a a a a a a", "one two\x0bthree\x85four five", "x" * 50000, "w " * 70000, None])
def test_fingerprint(text):
    assert fingerprint(text, 3) == plain_fingerprint(text, 3)


@pytest.mark.parametrize("chunk", [3, 1024])
def test_near_duplicates(spark, monkeypatch, chunk):
    monkeypatch.setattr(blocks.in_blocks, "__defaults__", (chunk,))
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choices(vocabulary, k=400)) for _ in range(12)]
    rows = []
    for text in base:
        for _ in range(5):
            words = text.split()
            words[rng.randrange(len(words))] = "changed"
            rows.append(" ".join(words))
    rows = base + rows + ["same text here"] * 9 + [None, "", " "]
    docs = [(100 - i, t, 1, 2) for i, t in enumerate(rows)] + [(None, "same text here", 1, 2), (3, "same text here", 1, 2), (3, "same text here", 1, 2)]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string, fp int, id int")).collect()
    prints = {(i, t): plain_fingerprint(t, 3) for i, t, _, _ in docs}
    near = [(a, b) for a in set(prints.values()) for b in set(prints.values()) if a < b and bin(a ^ b).count("1") <= 2]
    group = smallest_reached(set(prints.values()), near)
    first = {}
    for (i, _), p in prints.items():
        if i is not None:
            first[group[p]] = min(i, first.get(group[p], i))
    want = sorted((-1 if i is None else i, f"{prints[i, t]:016x}", first[group[prints[i, t]]]) for i, t, _, _ in docs)
    assert near and sorted((-1 if r["doc_id"] is None else r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("chunk", [40, 1024])
def test_vectors(spark, monkeypatch, chunk):
    monkeypatch.setattr(blocks.in_blocks, "__defaults__", (chunk,))
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(30, 16))
    rows = [(int(i), (centre[i % 30] + rng.normal(scale=0.09, size=16)).tolist(), int(i % 3)) for i in range(600)]
    rows += [(600 + i, rows[5][1], rows[5][2]) for i in range(25)] + [(700, [2 * x for x in rows[5][1]], rows[5][2])]
    odd = [(800, None, 1), (801, [0.0] * 16, 1), (802, [float("nan")] * 16, 1), (803, [None] + [1.0] * 15, 1), (804, rows[5][1], None), (805, [float("inf")] * 16, 1), (806, [], 1), (807, [1.0, 2.0], 1)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], "vec_id bigint, embedding array<double>, label int, cells int, node string").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(table).collect()}
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows])
    ids = np.array([r[0] for r in rows])
    linked = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None, :]) & ~np.eye(len(rows), dtype=bool)
    found = sum(got[i][0] for i in ids.tolist())
    assert all(got[i][0] <= n for i, n in zip(ids.tolist(), linked.sum(1).tolist()))
    assert found >= 0.98 * linked.sum() > 1000
    want = smallest_reached(ids.tolist(), [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(linked))])
    assert sum(got[i][1] == c for i, c in want.items()) >= 0.98 * len(rows)
    for i, _, _ in odd:
        assert got[i] == (0, i, True)
    assert len(got) == len(rows + odd)


def spread_vectors(n, width, seed=0):
    """Unit vectors of mean cosine 0.5, as text embeddings have, and copies of some around the threshold."""
    rng = np.random.default_rng(seed)
    base, far = rng.normal(size=width), rng.normal(size=(n, width))
    near = n // 3
    plain = far + base
    moved = plain[:near] + rng.normal(size=(near, width)) * np.linspace(0.05, 0.6, near)[:, None]
    unit = np.concatenate([plain, moved])
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


@pytest.mark.parametrize("max_cells,cell_rows", [(1024, 4), (16, 8), (4, 4)])
def test_recall_and_replication_with_many_cells(spark, max_cells, cell_rows):
    """One level of 1,024 cells, and two levels; every vector is in three cells at most."""
    unit = spread_vectors(3000, 64)
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(unit)], "vec_id bigint, embedding array<double>, label int").repartition(4)
    found = {r["vec_id"]: r["n_links"] for r in near_vectors(table, max_cells=max_cells, cell_rows=cell_rows).collect()}
    linked = (unit @ unit.T >= 0.93).sum(1) - 1
    assert all(found[i] <= n for i, n in enumerate(linked.tolist()))
    assert sum(found.values()) >= 0.9 * linked.sum() > 500
    classes = table.select(F.col("vec_id").alias("node"), "label", F.lit(1).cast("bigint").alias("weight"), F.col("embedding").alias("vector"))
    cells = embedding_dedup.fit_cells(classes, len(unit), max_cells=max_cells, cell_rows=cell_rows)
    assert bool(cells.fine) == (max_cells < 1024)
    listed = cells.nearest(unit, embedding_dedup.PROBES)
    assert max(map(len, listed)) <= 3 and all(x == sorted(set(x)) for x in listed)
    assert len({c for x in listed for c in x}) > min(max_cells, len(unit) // cell_rows) * (1 if max_cells == 1024 else 2) // 2


def test_vectors_of_nothing(spark):
    table = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert near_vectors(table).count() == 0
    assert [tuple(r) for r in near_vectors(spark.createDataFrame([(None, [1.0], 1)], "vec_id bigint, embedding array<float>, label int")).collect()] == [(None, 0, None, True)]
