"""Pairs with the profiles of both items, from a broadcast and from buckets."""

import random
import re

import pytest

from rankloom.operators.joins import enrich_pairs
from rankloom.plans.pairs import pair_training_set
from rankloom.session import bucketed, scratch_scope


def tables(spark):
    rng = random.Random(4)
    pairs = [(i, rng.choice([7, rng.randrange(60), None]), rng.randrange(60), int(i % 4 == 0)) for i in range(600)]
    profile = [(i, f"name {i}", float(i)) for i in range(50)] + [(None, "nobody", 0.0)]
    return pairs, profile, spark.createDataFrame(pairs, "rid int, item1 int, item2 int, label int"), spark.createDataFrame(profile, "pid int, name string, x double")


@pytest.mark.parametrize("sizes", [{}, {"max_rows": 0}, {"max_rows": 0, "hot_rows": 100, "buckets": 3}])
def test_both_profiles(spark, sizes):
    pairs, profile, df, side = tables(spark)
    known = {p[0]: p[1:] for p in profile if p[0] is not None}
    want = sorted((*p, *known[p[2]], *known[p[1]]) for p in pairs if p[1] in known and p[2] in known)
    with scratch_scope(spark):
        got = enrich_pairs(df, side, **sizes).select("rid", "item1", "item2", "label", "name2", "x2", "name1", "x1").collect()
    assert sorted(tuple(r) for r in got) == want


def test_profile_is_not_shuffled(spark):
    _, _, df, side = tables(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with scratch_scope(spark):
            plan = enrich_pairs(df, side, max_rows=0, buckets=4)._jdf.queryExecution().executedPlan().toString()
            before = spark.catalog.listTables()
        # The only exchanges are those of the pairs; both scans read buckets.
        exchanges = re.findall(r"hashpartitioning\((\w+)#", plan)
        assert sorted(exchanges) == ["item1", "item2"] and plan.count("Bucketed: true") == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(before) == len(spark.catalog.listTables()) + 1  # the scope dropped it


def test_training_rows_are_some_of_the_evaluation_rows(spark):
    pairs, _, df, side = tables(spark)
    with scratch_scope(spark):
        train, full = pair_training_set(df, side, ["rid"], max_rows=0)
        assert train.columns == full.columns
        some, every = ({r["rid"]: r["label"] for r in d.collect()} for d in (train, full))
    assert set(some) <= set(every) and all(r in some for r, label in every.items() if label == 1)
    assert 0 < sum(v == 0 for v in some.values()) < sum(v == 0 for v in every.values())


def test_buckets_of_strings(spark):
    df = spark.createDataFrame([(f"k{i % 9}", i) for i in range(90)], "k string, i int")
    with scratch_scope(spark):
        assert sorted(tuple(r) for r in bucketed(df, "k", 4).collect()) == sorted(tuple(r) for r in df.collect())
