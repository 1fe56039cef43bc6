"""The feature plan: positions, padding, combinations, and what lies below the reported widths."""

import random

import pytest
from pyspark.sql import functions as F

from rankloom.operators.features import (
    FeatureSpec,
    deep_vectors,
    dense_values,
    encode_features,
    longest_lists,
    plan_features,
    plan_widths,
    sparse_entries,
)

SPECS = [
    FeatureSpec("one", "category", transform="tabled", size=4, style=("onehot", "embedding"), groups=("g",)),
    FeatureSpec("many", "category", transform="vocabulary_list", style=("onehot", "embedding"), num=3, default=1, fill="a", groups=("h",)),
    FeatureSpec("free", "category", transform="tabled", size=5, style=("onehot",), num=-2, groups=("g", "h")),
    FeatureSpec("bag", "category", transform="tabled", size=6, style=("onehot", "embedding"), num=9, combiner="mean"),
    FeatureSpec("real", "category", transform="tabled", size=3, style=("onehot",), num=2, tail=2),
    FeatureSpec("own", "numeric", style=("value", "embedding"), num=2, same=False),
    FeatureSpec("shared", "numeric", style=("value", "embedding"), num=2, tail=7),
    FeatureSpec("peak", "numeric", style=("value", "embedding"), num=-4, combiner="max"),
    FeatureSpec("terms", "numeric", style=("embedding",), num=3, combiner="sum", same=False),
]
SCHEMA = (
    "k int, one int, many array<string>, free array<int>, bag array<int>, real array<int>, own array<double>, "
    "shared array<double>, peak array<double>, terms array<double>"
)
VOCAB = {"a": 2, "b": 3, "c": 4}


def rows(n=40):
    rng = random.Random(5)
    pick = lambda values, most: [rng.choice(values) for _ in range(rng.randrange(most + 1))]
    out = []
    for k in range(n):
        numbers = [[rng.uniform(-1, 1) for _ in range(rng.randrange(1, m + 1))] for m in (2, 2, 4, 3)]
        out.append((k, rng.randrange(4), pick(["a", "b", "zz", "", None], 3), pick(range(5), 4), pick(range(6), 9), pick(range(3), 2), *numbers))
    return [*out, (n, 0, None, None, None, None, [1.0, 2.0], [1.0], [3.0], [1.0])]


def plain(row, free):
    """Sparse, dense and deep (position, table, id, weight) of a row, from the contract."""
    _, one, many, lead, bag, real, own, shared, peak, terms = row
    many = [VOCAB.get(t or "a", 1) for t in many or []]
    lead, bag, real = lead or [], bag or [], real or []
    sparse, at = {}, 0
    for ids, slots, depth, tail in (([one], 1, 4, 4), (many, 3, 5, 5), (lead, free, 5, 5)):
        for s in range(slots):
            i = ids[s] if s < len(ids) else tail
            if i < depth:
                sparse[at + s * depth + i] = 1.0
        at += slots * depth
    for i in bag:
        sparse[at + i] = sparse.get(at + i, 0.0) + 1 / len(bag)
    at += 6
    for s, i in enumerate((real + [2, 2])[:2]):
        sparse[at + s * 3 + i] = 1.0
    shared = (shared + [7.0])[:2]
    own = (own + [0.0])[:2]
    dense = [*own, *shared, max(peak)]
    deep = [(0, "one", one, 1.0)] + [(1 + s, "many", i, 1.0) for s, i in enumerate(many)] + [(4, "bag", i, 1 / len(bag)) for i in bag]
    deep += [(5 + s, "own", s, v) for s, v in enumerate(own)] + [(7 + s, "shared", 0, v) for s, v in enumerate(shared)]
    deep += [(9, "peak", 0, max(peak))] + [(10, "terms", s, v) for s, v in enumerate(terms)]
    return sparse, dense, deep


def encoded(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    vocab = spark.createDataFrame([("many", t, i) for t, i in VOCAB.items()], "field string, token string, id bigint")
    plan = plan_features(SPECS, {"many": 5}, longest_lists(df, SPECS))
    return encode_features(df, plan, "k", vocab), plan


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_plan_against_the_contract(spark, max_rows):
    done, plan = encoded(spark)
    free = max(len(r[3] or []) for r in rows())
    assert plan.slots["free"] == free and plan.sparse_width == 4 + 3 * 5 + free * 5 + 6 + 2 * 3
    assert (plan.dense_width, plan.deep_vectors) == (5, 11)
    rng = random.Random(6)
    # Rows behind the end of a table must not be taken for those of the next one.
    tables = {(f, i): [rng.uniform(-1, 1) for _ in range(3)] for f in ("one", "many", "bag", "own", "shared", "peak", "terms") for i in range(-1, 9)}
    side = spark.createDataFrame([(f, i, v) for (f, i), v in tables.items()], "feature string, id int, vec array<double>")
    packed = done.select("*", sparse_entries(plan), dense_values(plan))
    got = {r["k"]: r for r in deep_vectors(packed, plan, "k", side, 3, keep=["sparse", "dense"], max_rows=max_rows).collect()}
    for row in rows():
        sparse, dense, deep = plain(row, free)
        r = got[row[0]]
        assert [e["index"] for e in r["sparse"]] == sorted(sparse)
        assert all(e["value"] == pytest.approx(sparse[e["index"]]) and e["index"] < plan.sparse_width for e in r["sparse"])
        assert r["dense"] == pytest.approx(dense)
        want = [[0.0] * 3 for _ in range(11)]
        for p, f, i, w in deep:
            for d in range(3):
                want[p][d] += w * tables[f, i][d]
        assert [x for v in r["deep"] for x in v] == pytest.approx([x for v in want for x in v])


def test_padding_is_the_size_of_the_table(spark):
    done, plan = encoded(spark)
    last = done.filter("k = 40").first()
    assert last["many"] == [5, 5, 5] and last["free"] == [5] * plan.slots["free"] and last["real"] == [2, 2]
    assert (last["bag"], last["own"], last["shared"]) == ([], [1.0, 2.0], [1.0, 7.0])


def test_ids_outside(spark):
    plan = plan_features([FeatureSpec("x", "category", transform="tabled", size=3, style=("onehot",), num=2)], {})
    df = spark.createDataFrame([([0, 3],), ([2, 1],)], "x array<bigint>")
    assert [[e["index"] for e in r["sparse"]] for r in df.select(sparse_entries(plan)).collect()] == [[0], [2, 4]]
    bad = spark.createDataFrame([([0, 9],)], "x array<bigint>")
    with pytest.raises(Exception, match="id outside"):
        bad.select(sparse_entries(plan)).collect()
    assert [e["index"] for e in bad.select(sparse_entries(plan, outside="drop")).first()["sparse"]] == [0]
    merged = plan_features([FeatureSpec("x", "category", transform="tabled", size=3, style=("onehot",), num=2, combiner="sum")], {})
    with pytest.raises(Exception, match="id outside"):
        df.select(sparse_entries(merged)).collect()  # a combined list has no padding
    counted = spark.createDataFrame([([2, 0, 2],)], "x array<bigint>").select(sparse_entries(merged)).first()["sparse"]
    assert [tuple(e) for e in counted] == [(0, 1.0), (2, 2.0)]


def test_groups_and_widths():
    plan = plan_features(SPECS, {"many": 5})
    part = plan.of_group("g")
    assert [p.spec.name for p in part.sparse] == ["one", "free"] and part.sparse_width == 4 + 2 * 5
    assert part.tables == plan.tables and [p.spec.name for p in part.deep] == ["one"]
    w = plan_widths(plan, embed_dim=4, first_order=1)
    assert (w.wide, w.dense, w.deep_vectors, w.deep) == (plan.sparse_width, 5, 11, 55)
    with pytest.raises(ValueError):
        plan.of_group("nothing")
    with pytest.raises(ValueError):
        FeatureSpec("x", "numeric", num=0)


def test_too_long_a_list(spark):
    plan = plan_features([FeatureSpec("x", "numeric", num=2)], {})
    with pytest.raises(Exception, match="more than 2 values"):
        encode_features(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "k int, x array<double>"), plan, "k").select(F.col("x")).collect()


def test_no_rows_have_one_position(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert longest_lists(df, SPECS) == {"free": 1}
