"""Codes with bounds against the plain algorithm."""

import hashlib
import math

import numpy as np
import pytest

from rankloom.llm import vector_codes
from rankloom.llm.vector_codes import Bounds, assign_all, compress, learn_codes, moved, next_size, reassign, shrink, whole_vectors

NAN, INF = float("nan"), float("inf")


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(kept[0][1]) // parts
    cut = [[r[1][p * d : (p + 1) * d] for p in range(parts)] for r in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for turn in range(rounds + 1):
        codes = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
        if turn < rounds:
            for p in range(parts):
                for i in range(len(books[p])):
                    mine = [c[p] for c, a in zip(cut, codes) if a[p][1] == i]
                    if mine:
                        books[p][i] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(a[0] for a in c) for c in codes]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    return [(r[0], "".join(f"{a[1]:02x}" for a in c), e, by_label[r[2]], digest) for r, c, e in zip(kept, codes, errors)]


def run(spark, rows, **how):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, label int, near string, id int").repartition(4)
    return sorted(map(str, (tuple(r) for r in compress(table, **how).collect())))


def vectors(n, width, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(9, width))
    return [(int(i), (centre[i % 9] + rng.normal(scale=0.3, size=width)).tolist(), [None, 0, 1][i % 3]) for i in rng.permutation(n)]


ODD = [(9000, None, 1), (9001, [], 1), (9002, [NAN] * 16, 1), (9003, [None] * 16, 1), (9004, [INF] + [0.0] * 15, None), (None, [0.25] * 16, 1), (None, [0.5] * 16, 7)]


@pytest.mark.parametrize("how", [{}, {"entries": 5, "rounds": 9}, {"parts": 2, "entries": 40}, {"parts": 1, "entries": 1}])
def test_codes(spark, how):
    rows = vectors(700, 16, 3)
    rows += [(3, rows[9][1], 1), (3, rows[9][1], 1), (3, rows[8][1], None)] + [(2000 + i, rows[0][1], 2) for i in range(200)] + ODD
    assert run(spark, rows, **how) == sorted(map(str, plain_codes(rows, **how)))


@pytest.mark.parametrize("n", [0, 1, 7, 16])
def test_few_vectors_and_ties(spark, n):
    rows = [(i, [float(i % 3)] * 8 + [float(-i)] * 8, None) for i in range(n)]
    assert run(spark, rows) == sorted(map(str, plain_codes(rows)))
    assert run(spark, ODD[:5]) == []


def test_lengths_that_fit_no_codebook(spark):
    with pytest.raises(ValueError, match="one length"):
        run(spark, [(1, [1.0] * 16, 1), (2, [1.0] * 8, 1)])
    with pytest.raises(ValueError, match="one length"):
        run(spark, [(1, [1.0] * 12, 1)])
    with pytest.raises(ValueError, match="no room"):
        run(spark, [(1, [1e15] * 16, 1)])


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(5)
    rows = rng.integers(-4000, 4000, (3000, 4))
    book = rng.integers(-4000, 4000, (16, 4))
    bounds, b = assign_all(rows, book, 6), 6
    for turn in range(12):
        step = rng.integers(-600, 600, (16, 4)) // (turn + 1) ** 2
        new = book + step
        bounds = moved(shrink(bounds, b), np.sqrt((step.astype(float) ** 2).sum(1)) * (1 + vector_codes.SLACK))
        used = np.zeros(18, np.int64)
        bounds, book = reassign(rows, new, bounds, used), new
        far = np.sqrt(((rows[:, None] - book) ** 2).sum(2).astype(float))
        assert (bounds.near[:, 0] == ((rows[:, None] - book) ** 2).sum(2).argmin(1)).all()
        assert (bounds.upper >= far[np.arange(3000), bounds.near[:, 0]]).all()
        assert (bounds.lower <= np.take_along_axis(far, bounds.near[:, 1:].astype(int), 1)).all()
        np.put_along_axis(far, bounds.near.astype(int), np.inf, 1)
        assert (bounds.outer <= far.min(1)).all()
        b = next_size(used, b, 16)
    assert used.sum() < 600


def test_next_size():
    assert next_size(np.array([0, 0, 96, 4, 0, 0, 0, 0]), 6, 16) == 2
    assert next_size(np.array([0, 0, 10, 10, 10, 0, 0, 0]), 6, 16) == 4
    assert next_size(np.array([0, 0, 10, 0, 0, 0, 0, 90]), 6, 16) == 6
    assert next_size(np.zeros(8, int), 6, 16) == 2
    assert isinstance(Bounds(1, 2, 3, 4), Bounds)


def test_later_rounds_ask_less(spark):
    table = spark.createDataFrame(vectors(1500, 16, 4), "vec_id bigint, embedding array<double>, label int").repartition(2)
    done = learn_codes(whole_vectors(table, "vec_id", "embedding", "label"))
    assert done.asked[0] == 0 and done.asked[-1] < 0.6 * 1500 * 8
    assert max(done.sizes[-1]) <= max(done.sizes[0])
