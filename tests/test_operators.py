import random

import pytest
from pyspark.sql import functions as F

from rankloom.functions import arrays
from rankloom.operators import bags, encode, features, joins, metrics, ordering, sampling, vocab
from rankloom.operators.combine import combine_by_key
from rankloom.operators.history import last_n_history
from rankloom.plans.pairs import top_recommendations
from rankloom.plans.tabular import clip_points, read_tabular, tabular_features
from rankloom.plans.train_samples import SampleSettings, label_samples, learn_vocabularies, train_samples
from rankloom.sources.interactions import explode_user_lines

from test_sources import USER_LINES, lines

ORDER = ["ts", "pid", "tag", "rid"]


def random_log(seed: int, rows: int, users: int, times: int = 50):
    """User 0 owns a third of the rows; many rows share a time."""
    rnd = random.Random(seed)
    out = []
    for rid in range(rows):
        cid = "0" if rnd.random() < 1 / 3 else str(rnd.randrange(1, users))
        out.append((cid, str(rnd.randrange(12)), rnd.randrange(times), rnd.randrange(3), rid))
    return out


def naive_history(log, n):
    result = {}
    for cid, pid, ts, tag, rid in log:
        before = sorted(
            (t, p, g, r) for c, p, t, g, r in log if c == cid and (t, p, g, r) < (ts, pid, tag, rid)
        )
        result[rid] = ([p for _, p, g, _ in before if g == 1][-n:], [p for _, p, g, _ in before if g == 2][-n:])
    return result


@pytest.mark.parametrize("limit", [10**6, 40, 7])
def test_history_equals_brute_force(spark, limit):
    log = random_log(1, 400, 6)
    df = spark.createDataFrame(log, "cid string, pid string, ts int, tag int, rid int")
    sources = df.filter("tag > 0").withColumn("stream", F.when(F.col("tag") == 1, "click").otherwise("order"))
    got = last_n_history(df, sources, ["cid"], ORDER, "pid", "stream", ["click", "order"], n=5, max_rows_per_key=limit)
    expected = naive_history(log, 5)
    rows = got.collect()
    assert len(rows) == len(log)
    for r in rows:
        assert (r["click_history"], r["order_history"]) == expected[r["rid"]]


def test_history_of_one_instant_and_one_user(spark):
    """All rows share user and time: chunks still follow the remaining order columns."""
    log = [("u", str(i % 3), 0, i % 3, i) for i in range(120)]
    df = spark.createDataFrame(log, "cid string, pid string, ts int, tag int, rid int")
    sources = df.filter("tag > 0").withColumn("stream", F.when(F.col("tag") == 1, "click").otherwise("order"))
    got = last_n_history(df, sources, ["cid"], ORDER, "pid", "stream", ["click", "order"], n=4, max_rows_per_key=10)
    expected = naive_history(log, 4)
    assert {r["rid"]: (r["click_history"], r["order_history"]) for r in got.collect()} == expected


def test_documented_user_line(spark):
    log = explode_user_lines(lines(spark, USER_LINES)).withColumnRenamed("seq", "rid")
    sources = log.filter("tag > 0").withColumn("stream", F.when(F.col("tag") == 1, "click").otherwise("order"))
    got = {
        (r["ts"].strftime("%H:%M"), r["tag"]): (r["click_history"], r["order_history"])
        for r in last_n_history(
            log.filter("cid = 'u1'"), sources, ["cid"], ["ts", "pid", "tag", "rid"], "pid", "stream", ["click", "order"]
        ).collect()
    }
    assert got[("10:09", 0)] == (["a", "b"], ["a"])
    assert got[("10:01", 1)] == ([], [])
    samples = label_samples(log.withColumn("rid", F.concat_ws(":", "cid", "rid")), "rid")
    assert sorted(r["label"] for r in samples.collect()) == [0, 0, 1, 1]  # u2 has no click


def test_balanced_sample_invariants(spark):
    log = random_log(2, 3000, 40)
    df = spark.createDataFrame(log, "cid string, pid string, ts int, tag int, rid int")
    counts = sampling.balanced_sample(df, "cid", "rid").groupBy("cid").agg(
        F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n")
    )
    truth = {}
    for cid, _, _, tag, _ in log:
        truth.setdefault(cid, [0, 0, 0])[tag] += 1
    got = {r["cid"]: (r["p"], r["n"]) for r in counts.collect()}
    for cid, (imp, click, _) in truth.items():
        m = min(imp, click, 7)
        assert got.get(cid, (0, 0)) == (m, m)


@pytest.mark.parametrize("parts", ["1", "7"])
def test_samples_do_not_depend_on_partitions(spark, parts):
    log = spark.createDataFrame(random_log(3, 600, 9), "cid string, pid string, ts int, tag int, rid int")
    base = sorted(map(str, label_samples(log, "rid").collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert sorted(map(str, label_samples(log.repartition(5), "rid").collect())) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ordered_prefix_by_group(spark):
    rnd = random.Random(4)
    rows = [("big" if rnd.random() < 0.5 else rnd.choice("abcd"), i, rnd.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i int, w int")
    got = ordering.ordered_prefix(df, [F.desc("i")], by=["g"], sums={"acc": F.col("w")}, parts=9, group_totals=True)
    for g in {r[0] for r in rows}:
        want, acc = [], 0
        for pos, (_, i, w) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: -r[1]), start=1):
            acc += w
            want.append((i, pos, acc))
        mine = [(r["i"], r["position"], r["acc"]) for r in got.filter(F.col("g") == g).orderBy("position").collect()]
        assert mine == want
    totals = {r["g"]: r["total_acc"] for r in got.select("g", "total_acc").distinct().collect()}
    assert totals == {g: sum(r[2] for r in rows if r[0] == g) for g in {r[0] for r in rows}}


def test_ordered_prefix_global_and_null_group(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)] + [("x", 99)], "g string, i int")
    got = ordering.ordered_prefix(df, [F.asc("i")], by=["g"], parts=6)
    assert {r["i"]: r["position"] for r in got.filter("g is null").collect()} == {i: i + 1 for i in range(50)}
    flat = ordering.ordered_prefix(df.select("i"), [F.desc("i")], parts=6)
    assert {r["i"]: r["position"] for r in flat.collect()}[99] == 1


def test_order_statistics(spark):
    df = spark.createDataFrame([(float(i), 1.0) for i in range(1, 11)] + [(None, 1.0)], "x double, c double")
    got = {r["field"]: (r["lo"], r["hi"]) for r in ordering.order_statistics(df, ["x", "c"], 5).collect()}
    assert got == {"x": (3.0, 9.0), "c": (1.0, 1.0)}
    few = {r["field"]: (r["lo"], r["hi"]) for r in ordering.order_statistics(df.limit(3), ["x"], 5).collect()}
    assert few["x"][1] == max(r["x"] for r in df.limit(3).collect())  # fewer rows than groups: clamped
    rough = {r["field"]: (r["lo"], r["hi"]) for r in ordering.order_statistics_approx(df, ["x"], 5).collect()}
    assert abs(rough["x"][0] - 3.0) <= 1 and abs(rough["x"][1] - 9.0) <= 1


def counts(spark, pairs):
    return spark.createDataFrame(pairs, "token string, n bigint")


def test_coverage_vocabulary(spark):
    table = counts(spark, [("a", 5), ("b", 3), ("d", 1), ("c", 1)])
    got = vocab.coverage_vocabulary(table, 0.9).orderBy("id").collect()
    assert [(r["token"], r["id"]) for r in got] == [("a", 1), ("b", 2)]
    more = vocab.coverage_vocabulary(table, 0.9, totals=20).orderBy("id").collect()
    assert [r["token"] for r in more] == ["a", "b", "c", "d"]
    floor = vocab.with_default(vocab.min_count_vocabulary(table, 3), token="<unk>").orderBy("id").collect()
    assert [(r["token"], r["id"]) for r in floor] == [("<unk>", 0), ("a", 1), ("b", 2)]


def test_rows_total_is_the_padded_row_count(spark):
    samples = spark.createDataFrame(
        [("1", "u", "p", 1, ["a", "b"], ["p,a", "p,b"], ["p,c"]), ("2", "u", "q", 0, [], [], [])],
        "sample_id string, cid string, pid string, label int, click array<string>, click_cross array<string>, order_cross array<string>",
    )
    flat = vocab.flatten_tokens(samples)
    assert flat.count() == 4
    assert flat.filter("pid = ''").count() == 0 and flat.filter("cross_pair = ''").count() == 1
    settings = SampleSettings(rates=(("cid", 1.5), ("cross", 1.0), ("pid", 0.6)), rows_total=True)
    by_rows = learn_vocabularies(samples, settings)
    assert {r["token"] for r in by_rows.filter("field = 'pid' and id > 0").collect()} == {"a", "b"}
    assert {r["token"] for r in by_rows.filter("field = 'cross' and id > 0").collect()} == {"p,a", "p,b", "p,c"}


def skewed_lookup(spark):
    rows = [(i, "hot" if i % 3 == 0 else "gone" if i % 3 == 1 else f"t{i % 17}") for i in range(600)] + [(1000, None)]
    left = spark.createDataFrame(rows, "i int, token string")
    dim = spark.createDataFrame([("hot", 1)] + [(f"t{k}", k + 2) for k in range(12)], "token string, id bigint")
    return rows, left, dim, {r["token"]: r["id"] for r in dim.collect()}


@pytest.mark.parametrize("max_rows,hot_rows", [(100, 10**6), (0, 10**6), (0, 50)])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_dimension_join_paths(spark, max_rows, hot_rows, how):
    rows, left, dim, known = skewed_lookup(spark)
    table = dim.select(F.col("token").alias("key"), "id")
    got = joins.dimension_join(left, table, [("token", "key")], how=how, max_rows=max_rows, hot_rows=hot_rows)
    want = sorted((i, known.get(t) or -1) for i, t in rows if how == "left" or t in known)
    assert sorted((r["i"], r["id"] or -1) for r in got.collect()) == want
    assert got.columns == ["i", "token", "id"]


@pytest.mark.parametrize("sizes", [{}, {"max_rows": 0, "hot_rows": 50}])
def test_encode_lists(spark, sizes):
    rows = [(i, "x", [["hot", "zz", "t1"], [], ["t2"]][i % 3], "hot") for i in range(300)]
    df = spark.createDataFrame(rows, "k int, other string, items array<string>, one string")
    _, _, dim, known = skewed_lookup(spark)
    got = encode.encode_lists(df, dim, "k", {"items": None}, {"one": None}, **sizes)
    assert got.columns == df.columns
    for r in got.collect():
        assert r["items"] == [known.get(t, 0) for t in rows[r["k"]][2]] and r["one"] == 1 and r["other"] == "x"
    assert encode.encode_lists(df, dim, "k", {"items": None}, drop_empty=True, **sizes).count() == 200


@pytest.mark.parametrize("max_rows", [1000, 5, 0])
def test_encode_fields_of_different_size(spark, max_rows):
    """Small fields by broadcast, large ones by shuffle; an empty list survives either way."""
    vocab_rows = [("pid", "a", 1), ("pid", "b", 2)] + [("cross", f"c{i}", i + 1) for i in range(20)]
    table = spark.createDataFrame(vocab_rows, "field string, token string, id bigint")
    rows = [(i, "a" if i % 2 else "q", ["b", "c1"] if i % 3 else [], [f"c{i % 25}", "a"]) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, pid string, click array<string>, pairs array<string>")
    got = encode.encode_lists(
        df, table, "k", {"click": "pid", "pairs": "cross"}, {"pid": "pid"}, max_rows=max_rows, hot_rows=20
    )
    out = {r["k"]: r for r in got.collect()}
    assert len(out) == 100
    for i, pid, click, pairs in rows:
        assert out[i]["pid"] == (1 if pid == "a" else 0)
        assert out[i]["click"] == ([2, 0] if click else [])
        assert out[i]["pairs"] == [i % 25 + 1 if i % 25 < 20 else 0, 0]


def test_broadcast_limit_counts_bytes(spark):
    from rankloom.operators.skew import fits_broadcast

    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array_repeat(F.lit(1.0), 50).alias("v"))
    assert fits_broadcast(wide) and not fits_broadcast(wide, max_rows=99)
    assert fits_broadcast(wide, max_bytes=140_800) and not fits_broadcast(wide, max_bytes=140_799)
    assert fits_broadcast(wide.limit(0), max_rows=0, max_bytes=0)


def test_scratch_tables_are_deleted(spark):
    import os

    from rankloom.session import materialize, scratch_scope

    with scratch_scope(spark):
        kept = materialize(spark.range(3))
        path = "/" + kept.inputFiles()[0].removeprefix("file:").lstrip("/")
        assert os.path.exists(path) and kept.count() == 3
    assert not os.path.exists(path)


def test_specs_from_config():
    config = {
        "brand": {
            "type": "category",
            "transform": "vocabulary_list",
            "style": ["onehot", "embedding"],
            "multi": {"num": 3, "same": False, "combiner": "mean"},
            "parameter": {"embed_dim": 8, "default": 2, "fill": "DEFAULT", "tail": 9},
            "group": ["wide"],
        },
        "price": {"type": "numeric", "transform": None, "style": "value", "parameter": {}, "ignore": True},
    }
    specs = features.specs_from_config(config, {3: "brand", 1: "price", 2: "other"})
    assert [s.name for s in specs] == ["price", "brand"] and specs[0].ignore
    assert (specs[1].num, specs[1].combiner, specs[1].embed_dim, specs[1].default, specs[1].tail) == (3, "mean", 8, 2, 9)


def test_tabled_id_range(spark):
    assert spark.range(3).select(encode.tabled_id(F.col("id"), 3)).count() == 3
    with pytest.raises(Exception, match="id outside"):
        spark.range(4).select(encode.tabled_id(F.col("id"), 3)).collect()


RAGGED = [(0, [1, 1, 2]), (1, []), (2, [3]), (3, [])]


def test_multihot_and_pool(spark):
    df = spark.createDataFrame(RAGGED, "row int, ids array<bigint>")
    want = {"sum": [0, 2, 1, 0], "mean": [0, 2 / 3, 1 / 3, 0], "max": [0, 1, 1, 0]}
    for how, dense in want.items():
        sparse = {(r["row"], r["id"]): r["value"] for r in bags.multihot(df, "row", "ids", 4, how).collect()}
        assert [sparse.get((0, i), 0) for i in range(4)] == pytest.approx(dense)
        row = df.select("row", bags.multihot_dense(F.col("ids"), 4, how).alias("v")).orderBy("row").collect()
        assert row[0]["v"] == pytest.approx(dense) and row[1]["v"] == [0, 0, 0, 0]
    emb = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0])], "id bigint, vec array<double>")
    pooled = {
        r["row"]: r
        for r in bags.embedding_pool(df, "row", "ids", emb, 2, {"s": "sum", "m": "mean", "q": "sqrtn"}).collect()
    }
    assert pooled[0]["s"] == [2.0, 2.0] and pooled[0]["m"] == pytest.approx([2 / 3, 2 / 3])
    assert pooled[0]["q"] == pytest.approx([2 / 3**0.5] * 2)
    assert pooled[1]["s"] == [0.0, 0.0] and pooled[3]["m"] == [0.0, 0.0]


def test_fm_second_order(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0], None)], "a array<double>, b array<double>, c array<double>")
    out = df.select(bags.fm_second_order([F.col("a"), F.col("b"), F.col("c")]).alias("v")).first()["v"]
    assert out == pytest.approx([3.0, 8.0])


def test_merge_shards_in_numeric_order(spark):
    df = spark.createDataFrame([(k, r, f"{k}:{r}") for k in (0, 2, 10) for r in range(2)], "k int, r int, v string")
    got = [r["v"] for r in bags.merge_shards(df, "k", "r").orderBy("id").collect()]
    assert got == ["0:0", "0:1", "2:0", "2:1", "10:0", "10:1"]


def test_auc_ties_and_single_class(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("a", 1, 0.5), ("a", 0, 0.5), ("b", 1, 0.3)]
    df = spark.createDataFrame(rows, "task string, label int, pred double")
    got = {r["task"]: r["auc"] for r in metrics.auc(df, by=["task"]).collect()}
    assert got["a"] == pytest.approx(0.875) and got["b"] is None
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rnd = random.Random(5)
    many = spark.createDataFrame([(float(rnd.random() < 0.3), rnd.randrange(40) / 40) for _ in range(2000)], "label double, pred double")
    theirs = BinaryClassificationEvaluator(rawPredictionCol="pred", labelCol="label", numBins=0).evaluate(many)
    assert metrics.auc(many).first()["auc"] == pytest.approx(theirs)


def test_focal_rescaling(spark):
    df = spark.createDataFrame([(1, 0.5, 1.0), (0, 0.5, 1.0), (1, 0.9, 0.0)], "label int, pred double, w double")
    import math

    terms = [0.75 * (0.5 * 2) * -math.log(0.5), 0.25 * 0.25 * -math.log(0.5), 0.0]
    want = sum(terms) / 3 * 3 / (2 + 1)
    assert metrics.mean_focal(df, weight="w").first()["focal"] == pytest.approx(want)


def test_top_recommendations_hot_key(spark):
    rows = [(1 if i % 3 else 2, i, float(i % 50)) for i in range(900)]
    df = spark.createDataFrame(rows, "pid int, item int, score double")
    got = {r["pid"]: r["items"] for r in top_recommendations(df, "pid", "item", F.col("score"), k=20, salts=4).collect()}
    for pid in (1, 2):
        want = [i for _, i in sorted((-s, i) for p, i, s in rows if p == pid)][:20]
        assert got[pid] == want


def test_downsample_needs_a_minority(spark):
    df = spark.createDataFrame([(i, int(i % 2)) for i in range(10)], "i int, label int")
    with pytest.raises(Exception, match="ratio must be below 1"):
        sampling.downsample_negatives(df, "label", ["i"]).collect()


def test_split_is_disjoint_and_complete(spark):
    df = spark.range(1000)
    train, held = sampling.split_train_eval(df, ["id"])
    assert train.count() + held.count() == 1000 and train.intersect(held).count() == 0
    assert 50 < held.count() < 150


def test_combine_by_key_hot_key(spark):
    import pandas as pd

    df = spark.createDataFrame([("hot" if i % 3 else "cold", i) for i in range(300)], "k string, v bigint").repartition(6)

    def create(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.groupby("k", as_index=False).agg(v=("v", "max"))

    got = combine_by_key(df, ["k"], create, create, "k string, v bigint", salts=3)
    assert {r["k"]: r["v"] for r in got.collect()} == {"hot": 299, "cold": 297}


def test_feature_specs_validate_and_measure():
    with pytest.raises(ValueError):
        features.FeatureSpec("x", "text")
    with pytest.raises(ValueError):
        features.FeatureSpec("x", "category", transform="tabled")
    specs = [
        features.FeatureSpec("brand", "category", transform="vocabulary_list", style=("onehot", "embedding"), groups=("wide",)),
        features.FeatureSpec("hist", "category", transform="tabled", size=10, style=("embedding",), num=5, combiner="mean"),
        features.FeatureSpec("price", "numeric", style=("value", "embedding"), num=2),
        features.FeatureSpec("gone", "numeric", ignore=True),
    ]
    w = features.widths(specs, embed_dim=4, sizes={"brand": 7}, first_order=1)
    assert (w.wide, w.deep, w.deep_vectors, w.category_vectors, w.numeric_vectors, w.dense) == (7, 20, 4, 2, 2, 2)
    assert w.groups == {"wide": ["brand"]}


def test_tabular_features(spark):
    rows = [(i, i % 2, None if i == 0 else i * 10, "common" if i < 8 else f"rare{i}") for i in range(10)]
    df = spark.createDataFrame(rows, "key int, label int, x bigint, c string")
    got = {r["key"]: r["line"] for r in tabular_features(df, "key", "label", {"x": 50}, ["c"], cutoff=3).collect()}
    assert got[1] == "1\t0\t1" and got[9] == "1\t1\t0" and got[3] == "1\t0.5\t1"
    assert got[0].split("\t")[1] == "-0.25"  # blank counts as 0, below the smallest seen value


def test_read_tabular(spark, tmp_path):
    path = str(tmp_path / "t")
    line = "\t".join(["1", *[str(i) if i != 3 else "" for i in range(1, 14)], *[f"c{i}" if i != 2 else "" for i in range(1, 27)]])
    lines(spark, [line]).write.text(path)
    df = read_tabular(spark, path)
    row = df.first()
    assert len(df.columns) == 40 and (row["label"], row["I1"], row["I3"], row["C1"], row["C2"]) == (1, 1, None, "c1", None)
    assert clip_points()["I5"] == 64000
    with pytest.raises(Exception):
        lines(spark, ["1\tx"]).write.text(path + "bad")
        read_tabular(spark, path + "bad").collect()


def test_train_samples_job(spark):
    log = spark.createDataFrame(random_log(6, 500, 8), "cid string, pid string, ts int, tag int, rid int")
    profile = spark.createDataFrame([(str(i), float(i)) for i in range(10)], "key string, price double")
    done = train_samples(log, "rid", profile, "key", ["price"], SampleSettings(buckets=5)).collect()
    kept = label_samples(log, "rid").filter(F.col("pid").cast("int") < 10)
    assert len(done) == kept.count() > 0  # items 10 and 11 have no profile
    for r in done:
        head, body = r["line"].split("@")
        assert head == str(r["label"]) and len(body.split("|")) == 6
        assert len(r["click"]) == len(r["click_cross"]) <= 20
    strict = train_samples(log, "rid", profile, "key", ["price"], SampleSettings(buckets=5), drop_empty=True).collect()
    assert len(strict) == sum(1 for r in done if r["click"] and r["order_cross"])


@pytest.mark.parametrize("limit", [5, 10**9])
def test_rows_without_a_user_are_one_history(spark, limit):
    rnd = random.Random(6)
    log = [(i, None if i % 2 else "u", f"p{i}", rnd.randrange(9), rnd.randrange(3)) for i in range(60)]
    df = spark.createDataFrame(log, "rid int, cid string, pid string, ts int, tag int")
    sources = df.filter("tag > 0").withColumn("stream", F.when(F.col("tag") == 1, "click").otherwise("order"))
    got = last_n_history(df, sources, ["cid"], ["ts", "rid"], "pid", "stream", ["click", "order"], n=4, max_rows_per_key=limit)
    found = {r["rid"]: (r["click_history"], r["order_history"]) for r in got.collect()}
    for rid, cid, _, ts, _ in log:
        before = sorted((r for r in log if r[1] == cid and (r[3], r[0]) < (ts, rid)), key=lambda r: (r[3], r[0]))
        assert found[rid] == tuple([r[2] for r in before if r[4] == tag][-4:] for tag in (1, 2))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_nan_is_a_key_and_null_is_none(spark, how):
    left = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None), (4, 9.0)], "i int, k double")
    dim = spark.createDataFrame([(1.0, "one"), (float("nan"), "nan"), (None, "null")], "key double, v string")
    want = {1: "one", 2: "nan"} | ({3: None, 4: None} if how == "left" else {})
    for sizes in ({}, {"max_rows": 0}, {"max_rows": 0, "hot_rows": 0}):
        got = joins.dimension_join(left, dim, [("k", "key")], how=how, **sizes)
        assert {r["i"]: r["v"] for r in got.collect()} == want


@pytest.mark.parametrize("max_rows", [0, 2, 10**6])
def test_null_lists_keep_their_sample(spark, max_rows):
    rows = [(1, ["a", "b"], ["x"]), (2, None, ["y"]), (3, ["b"], None), (4, None, None), (5, [], [None])]
    df = spark.createDataFrame(rows, "k int, near array<string>, far array<string>")
    vocab = spark.createDataFrame([("n", "a", 1), ("n", "b", 2), ("f", "x", 1), ("f", "y", 2), ("f", "z", 3)], "field string, token string, id bigint")
    got = encode.encode_lists(df, vocab, "k", {"near": "n", "far": "f"}, max_rows=max_rows)
    assert {r["k"]: (r["near"], r["far"]) for r in got.collect()} == {1: ([1, 2], [1]), 2: ([], [2]), 3: ([2], []), 4: ([], []), 5: ([], [0])}


def test_surplus_values_are_no_secret(spark):
    df = spark.createDataFrame([(1, [1, 2, 3])], "k int, v array<bigint>")
    with pytest.raises(Exception, match="more than 2 values"):
        df.select(arrays.pad_to(F.col("v"), 2, F.lit(0).cast("bigint"))).collect()
    with pytest.raises(Exception, match="outside"):
        bags.multihot(df, "k", "v", 3, outside="raise").collect()
    with pytest.raises(Exception, match="outside"):
        bags.multihot(df, "k", "v", 3).count()
    assert bags.multihot(df, "k", "v", 3, outside="drop").count() == 2
