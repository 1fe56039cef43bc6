"""Whole histories against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from rankloom.operators.history import last_n_history
from test_operators import ORDER, naive_history, random_log

SCHEMA = "cid string, pid string, ts int, tag int, rid int"


def whole(targets, df, **how):
    sources = df.filter("tag > 0").withColumn("stream", F.when(F.col("tag") == 1, "click").otherwise("order"))
    got = last_n_history(targets, sources, ["cid"], ORDER, "pid", "stream", ["click", "order"], n=None, **how)
    return {r["rid"]: (r["click_history"], r["order_history"]) for r in got.collect()}


@pytest.mark.parametrize("limit", [10**6, 40, 7])
def test_whole_histories(spark, limit):
    log = random_log(1, 400, 6) + [(None, str(i % 3), i % 5, i % 3, 1000 + i) for i in range(60)]
    df = spark.createDataFrame(log, SCHEMA)
    assert whole(df, df, max_rows_per_key=limit) == naive_history(log, 10**6)


def test_user_with_very_many_events(spark):
    rng = random.Random(2)
    log = [("busy", str(rng.randrange(50)), rng.randrange(10**6), 1 + (i % 2), i) for i in range(100_000)] + [("calm", "7", 3, 1, 100_000)]
    df = spark.createDataFrame(log, SCHEMA).repartition(4)
    at = [0, 5, 77_777, 99_999, 100_000]
    ordered = sorted((t, p, g, r) for c, p, t, g, r in log if c == "busy")
    place = {r: k for k, (_, _, _, r) in enumerate(ordered)}
    want = {r: tuple([p for _, p, g, _ in ordered[: place[r]] if g == s] for s in (1, 2)) for r in at[:-1]} | {100_000: ([], [])}
    targets = df.filter(F.col("rid").isin(at))
    assert whole(targets, df, few_targets=True) == want
    assert whole(targets, df, few_targets=True, max_rows_per_key=9_000) == want


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert whole(df, df) == {}
