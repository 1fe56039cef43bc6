"""Sums of looked-up vectors: both ways of looking up against plain sums."""

import random

import pytest
from pyspark.sql import functions as F

from rankloom.functions.arrays import value_counts
from rankloom.operators import bags, vectors
from rankloom.operators.vectors import vector_sums


def plain(rows, table, dim, positions):
    out = {}
    for key, entries in rows:
        n, w2, s, q = [0] * positions, [0.0] * positions, [[0.0] * dim for _ in range(positions)], [[0.0] * dim for _ in range(positions)]
        for p, i, w in entries or []:
            if i is None:
                continue
            n[p] += 1
            w2[p] += (w or 0.0) ** 2
            for d, x in enumerate((table.get(i) or [])[:dim]):
                s[p][d] += (w or 0.0) * x
                q[p][d] += ((w or 0.0) * x) ** 2
        out[key] = (n, w2, sum(s, []), sum(q, []))
    return out


@pytest.mark.parametrize("max_rows", [1000, 0])
@pytest.mark.parametrize("at_once", [1 << 21, 40])
def test_vector_sums(spark, monkeypatch, max_rows, at_once):
    monkeypatch.setattr(vectors, "NUMBERS_AT_ONCE", at_once)
    rng = random.Random(3)
    table = {i: [rng.uniform(-1, 1) for _ in range(5)] for i in range(40)}
    rows = [(k, [(rng.randrange(3), rng.choice([None, *range(45)]), rng.choice([None, 1.0, 0.5, -2.0])) for _ in range(rng.randrange(6))]) for k in range(150)]
    rows += [(900, None), (901, []), (902, [(1, rng.randrange(40), 1.0) for _ in range(3000)])]
    df = spark.createDataFrame([(k, e, f"x{k}") for k, e in rows], "key int, e array<struct<position:int,id:int,weight:double>>, other string").repartition(4)
    side = spark.createDataFrame([(i, v) for i, v in table.items()] + [(None, [1.0] * 5), (44, None)], "id bigint, vec array<float>")
    got = vector_sums(df, "key", F.col("e"), side, 5, positions=3, squares=True, keep=["other"], max_rows=max_rows)
    want = plain(rows, table, 5, 3)
    found = got.collect()
    assert len(found) == len(want)
    for r in found:
        n, w2, s, q = want[r["key"]]
        assert r["other"] == f"x{r['key']}" and r["_n"] == n
        for a, b in ((r["_w2"], w2), (r["_s"], s), (r["_q"], q)):
            assert a == pytest.approx(b, abs=1e-4)
    wide = vector_sums(df, "key", F.col("e"), side, 9, positions=3, max_rows=max_rows)
    assert {len(r["_s"]) for r in wide.collect()} == {27}
    assert vector_sums(df.limit(0), "key", F.col("e"), side, 5, positions=3, max_rows=max_rows).count() == 0


def test_plan_does_not_grow_with_the_dimension(spark):
    df = spark.createDataFrame([(1, [1, 2])], "row int, ids array<int>")
    plans = []
    for dim in (2, 64):
        side = spark.createDataFrame([(1, [1.0] * dim)], "id int, vec array<double>")
        pooled = bags.embedding_pool(df, "row", "ids", side, dim, {"s": "sum", "f": "fm"}, max_rows=0)
        plans.append(len(pooled._jdf.queryExecution().executedPlan().toString().splitlines()))
    assert plans[0] == plans[1]


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_pools_of_strings_and_kept_columns(spark, max_rows):
    df = spark.createDataFrame([(1, ["a", "b", "a"], 7.0), (2, None, 8.0), (3, ["zz"], None)], "row int, ids array<string>, mass double")
    side = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "id string, vec array<double>")
    how = {"s": "sum", "m": "mean", "q": "sqrtn", "f": "fm"}
    got = {r["row"]: r for r in bags.embedding_pool(df, "row", "ids", side, 2, how, keep=["mass"], max_rows=max_rows).collect()}
    assert got[1]["s"] == [2.0, 2.0] and got[1]["m"] == pytest.approx([2 / 3, 2 / 3]) and got[1]["q"] == pytest.approx([2 / 3**0.5] * 2)
    assert got[1]["f"] == [1.0, 0.0]
    assert [got[i]["mass"] for i in (1, 2, 3)] == [7.0, 8.0, None] and got[2]["m"] == [0.0, 0.0] == got[3]["s"]


def test_value_counts(spark):
    rows = [([3, 1, 3, None, 1, 3],), ([],), (None,), ([5],)]
    df = spark.createDataFrame(rows, "a array<int>")
    got = [r["c"] and [(e["value"], e["n"]) for e in r["c"]] for r in df.select(value_counts(F.col("a")).alias("c")).collect()]
    assert got == [[(1, 2), (3, 3)], [], None, [(5, 1)]]


def test_multihot_outside(spark):
    df = spark.createDataFrame([(1, [0, 7, 7]), (2, [-1])], "row int, ids array<int>")
    with pytest.raises(Exception, match="id outside"):
        bags.multihot(df, "row", "ids", 4).collect()
    assert [tuple(r) for r in bags.multihot(df, "row", "ids", 4, "mean", outside="drop").collect()] == [(1, 0, pytest.approx(1 / 3))]


@pytest.mark.parametrize("at_once", [1 << 21, 40])
@pytest.mark.parametrize("squares", [False, True])
def test_sums_in_place(spark, monkeypatch, at_once, squares):
    """A table too large for every worker goes to the executors; rows are summed where they lie, also where keys repeat."""
    monkeypatch.setattr(vectors, "NUMBERS_AT_ONCE", at_once)
    monkeypatch.setattr(vectors, "WORKER_BYTES", 0)
    rng = random.Random(4)
    table = {i: [rng.uniform(-1, 1) for _ in range(5)] for i in range(40)}
    rows = [(k, [(rng.randrange(3), rng.choice([None, *range(45)]), rng.choice([None, 1.0, 0.5, -2.0])) for _ in range(rng.randrange(6))]) for k in range(150)]
    rows += [(900, None), (901, []), (902, [(1, rng.randrange(40), 1.0) for _ in range(3000)]), (903, []), (7, rows[7][1]), (7, rows[7][1])]
    df = spark.createDataFrame([(k, e, f"x{k}") for k, e in rows], "key int, e array<struct<position:int,id:int,weight:double>>, other string").repartition(4)
    side = spark.createDataFrame([(i, v) for i, v in table.items()] + [(None, [1.0] * 5), (44, None), (3, table[3])], "id bigint, vec array<float>")
    sums = vector_sums(df, "key", F.col("e"), side, 5, positions=3, squares=squares, keep=["other"])
    plan = sums._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "REPARTITION_BY_COL" not in plan
    got, want = sums.collect(), plain(rows, table, 5, 3)
    assert sorted(r["key"] for r in got) == sorted(k for k, _ in rows)
    for r in got:
        n, w2, s, q = want[r["key"]]
        assert r["other"] == f"x{r['key']}" and r["_n"] == n
        assert r["_w2"] == pytest.approx(w2) and r["_s"] == pytest.approx(s, rel=1e-6, abs=1e-5)
        if squares:
            assert r["_q"] == pytest.approx(q, rel=1e-6, abs=1e-5)
