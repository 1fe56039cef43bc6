"""Ranks by digits and running sums in one pass, against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import ordering
from rankloom.operators.ordering import key_value, order_keys, order_statistics, ordered_prefix, ranked_values

NAN, INF = float("nan"), float("inf")


def test_keys_keep_the_order():
    values = np.array([-INF, -1e300, -2.5, -1e-320, -0.0, 0.0, 5e-324, 1.0, 1.0 + 2**-52, 3e8, INF, NAN])
    keys = order_keys(values)
    assert keys[4] == keys[5] and (np.diff(np.delete(keys, 4)) > 0).all()
    assert [key_value(k) for k in keys[:-1]] == [v + 0.0 for v in values[:-1]] and math.isnan(key_value(keys[-1]))
    assert order_keys(np.array([-NAN]))[0] == keys[-1]


def columns_of(n):
    rng = random.Random(n)
    near = lambda: 1e9 + rng.randrange(300) / 1024  # noqa: E731  (needs all four rounds)
    return {
        "ties": [rng.choice([1.0, 1.0, 1.0, 2.0, -3.0]) for _ in range(n)],
        "mixed": [rng.choice([None, NAN, -0.0, 0.0, INF, -INF, rng.uniform(-1, 1)]) for _ in range(n)],
        "near": [near() for _ in range(n)],
        "wide": [rng.uniform(-1, 1) * 10 ** rng.randrange(-200, 200) for _ in range(n)],
        "none": [None] * n,
        "one": [7.25] + [None] * (n - 1),
    }


@pytest.mark.parametrize("n,groups", [(1, 5), (2, 1), (997, 3), (3000, 3000), (500, 10**6)])
def test_ranks(spark, n, groups):
    data = columns_of(n)
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"`{c}` double" for c in data)).repartition(3)
    got = {r["field"]: (r["lo"], r["hi"]) for r in order_statistics(df, list(data), groups).collect()}
    for name, values in data.items():
        kept = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        if not kept:
            assert name not in got
            continue
        low = len(kept) // groups
        want = (kept[min(low, len(kept) - 1)], kept[min(len(kept) - low, len(kept) - 1)])
        assert all(a == b or (math.isnan(a) and math.isnan(b)) for a, b in zip(got[name], want)), name


def test_ranks_of_other_types_and_nothing(spark):
    df = spark.createDataFrame([(i, 1) for i in range(100)], "a int, `odd.name` bigint")
    assert ranked_values(df, ["a", "odd.name"], lambda n: range(0, n, 25)) == {"a": [0, 25, 50, 75], "odd.name": [1] * 4}
    assert order_statistics(df.limit(0), ["a"], 3).count() == 0


def test_selection_has_no_sort(spark, monkeypatch):
    plans = []
    real = ordering.Window.partitionBy
    monkeypatch.setattr(ordering, "materialize", lambda d: plans.append(d) or d)
    df = spark.range(1000).select(F.rand(3).alias("x"))
    ordering.order_statistics(df, ["x"], 10).collect()
    text = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text and real is not None


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("batch", ["3", "10000"])
def test_prefix_sums(spark, parts, batch):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b", "c", "d"]), i, rng.choice([None, 2**40, -3, 5]), rng.choice([None, 0.5, -2.25, 1e-3])) for i in range(400)]
    rows += [("hot", 1000 + i, 1, 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, i int, w bigint, x double").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = ordered_prefix(df, [F.asc("i")], by=["g"], sums={"sw": F.col("w"), "sx": F.col("x")}, parts=parts, group_totals=False).collect()
        flat = ordered_prefix(df, [F.desc("i")], sums={"sw": F.col("w")}, parts=parts, group_totals=True).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for g in {r[0] for r in rows}:
        w, x = 0, 0.0
        for at, r in enumerate(sorted(r for r in rows if r[0] == g), 1):
            w, x = w + (r[2] or 0), x + (r[3] or 0.0)
            want[r[1]] = (at, w, pytest.approx(x))
    assert {r["i"]: (r["position"], r["sw"], r["sx"]) for r in got} == want
    total, seen = sum(r[2] or 0 for r in rows), 0
    for at, r in enumerate(sorted(flat, key=lambda r: -r["i"]), 1):
        seen += r["w"] or 0
        assert (r["position"], r["sw"], r["total_sw"]) == (at, seen, total)


def test_not_a_number_does_not_leave_its_group(spark):
    df = spark.createDataFrame([("a", 1, NAN), ("a", 2, 1.0), ("b", 1, 2.0), ("b", 2, 3.0)], "g string, i int, x double")
    got = {(r["g"], r["i"]): r["s"] for r in ordered_prefix(df, [F.asc("i")], by=["g"], sums={"s": F.col("x")}, parts=1).collect()}
    assert math.isnan(got["a", 2]) and got["b", 2] == 5.0
    with pytest.raises(ValueError, match="running sums"):
        ordered_prefix(df, [F.asc("i")], sums={"s": F.col("g")})


def test_rows_are_exchanged_once(spark, monkeypatch):
    seen = []
    real = ordering.materialize
    monkeypatch.setattr(ordering, "materialize", lambda d: seen.append(d._jdf.queryExecution().executedPlan().toString()) or real(d))
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    done = ordered_prefix(df, [F.asc("id")], by=["g"], sums={"s": F.col("id")})
    assert seen[0].count("Exchange") == 1 and "Window" not in seen[0]
    # What is left joins one row per range.
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 0
