"""Block-wise search against all inner products."""

import math

import numpy as np
import pytest

from rankloom.llm.topk_search import Best, bounds, products, search_shard, top_k

NAN, INF = float("nan"), float("inf")


def plain_search(rows, every=50, k=5, scale=256):
    whole = [(i, [math.floor(x * scale) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(whole):
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), i) for n, (i, w) in enumerate(whole) if n != at and len(w) == len(v))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def run(spark, rows, **sizes):
    table = spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], "vec_id bigint, embedding array<double>, query string, size int, row double").repartition(3)
    return sorted(tuple(r) for r in top_k(table, **sizes).collect())


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 3, "shard_rows": 24}, {"block_rows": 1, "shard_rows": 1}])
def test_search(spark, sizes):
    rng = np.random.default_rng(8)
    n = 60 if sizes.get("shard_rows") == 1 else 700
    centre = rng.normal(size=(6, 8))
    rows = [(i, (centre[i % 6] + rng.normal(scale=0.2, size=8)).tolist()) for i in range(n)]
    rows += [(50, rows[3][1]), (50, rows[3][1]), (100, rows[7][1]), (0, [0.0] * 8)]
    rows += [(n + i, rows[1][1]) for i in range(30)]  # ties
    rows += [(1000, None), (1050, [NAN] * 8), (1100, [INF] + [1.0] * 7), (1150, [None] * 8), (1200, []), (None, rows[0][1])]
    rows += [(1250, [0.5, -0.5]), (1251, [0.25, 0.25]), (1300, [-1.0, 2.0]), (-50, rows[9][1]), (1350, [1.0] * 3)]
    assert run(spark, rows, **sizes) == plain_search(rows)


def test_search_of_few(spark):
    assert run(spark, []) == []
    assert run(spark, [(50, [1.0])]) == []
    assert run(spark, [(50, [1.0]), (7, [-0.001])]) == [(50, 1, 7, -256)]
    assert run(spark, [(1, [1.0]), (7, [-0.001])]) == []


def test_other_numbers_of_chunks_and_groups(spark, monkeypatch):
    from rankloom.llm import topk_search

    monkeypatch.setattr(topk_search, "CHUNK_QUERIES", 3)
    monkeypatch.setattr(topk_search, "GROUP_SHARDS", 2)
    rng = np.random.default_rng(9)
    rows = [(i * 10, rng.normal(size=4).tolist()) for i in range(120)]
    assert run(spark, rows, block_rows=4, shard_rows=12) == plain_search(rows)


def test_large_numbers_are_exact(spark):
    rows = [(50, [4e6, 3.0]), (1, [2e6 + 1 / 256, 1.0]), (2, [2e6, 1.0]), (3, [2e6, 2.0])]
    assert run(spark, rows) == plain_search(rows)
    with pytest.raises(OverflowError):
        products(np.array([[2**40]]), np.array([[2**40]]))


def test_pruning_leaves_blocks_out():
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(40, 16)) * 400
    vectors = np.floor(np.repeat(centre, 20, axis=0) + rng.normal(size=(800, 16))).astype(np.int64)
    blocks = [(np.arange(i, i + 20), np.arange(i, i + 20), vectors[i : i + 20]) for i in range(0, 800, 20)]
    low, high = (np.array([f(b[2], axis=0) for b in blocks]) for f in (np.min, np.max))
    best = Best(800, 5)
    scored = search_shard(vectors, np.arange(800), best, {"blocks": blocks, "low": low, "high": high})
    assert scored < 0.3 * 800 * len(blocks)
    every = vectors @ vectors.T
    assert (bounds(vectors, low, high) >= every.reshape(800, 40, 20).max(2)).all()
    np.fill_diagonal(every, -(2**60))
    assert (best.score.reshape(800, 5) == -np.sort(-every, axis=1)[:, :5]).all()
