import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.ml import learners, registry
from rankloom.ml.estimator import RankerEstimator, RankerModel
from rankloom.ml.scoring import score_partitions
from rankloom.ml.serving import serving_table
from rankloom.streaming.feed import feed_batches, score_stream


def train_rows(spark, n=300):
    return spark.createDataFrame(
        [(i, float(i % 3 == 0), i % 5, float(i % 7)) for i in range(n)], "id int, label double, item int, value double"
    )


@pytest.mark.parametrize("name", ["linear", "fm", "mlp"])
def test_learners(spark, name):
    rows = train_rows(spark)
    model = registry.build(name)(rows, ["item"], ["value"], steps=3)
    scored = learners.predict(model, rows, ["id"])
    assert scored.filter((F.col("pred") < 0) | (F.col("pred") > 1)).count() == 0 and scored.count() == 300


def test_width_is_that_of_the_table(spark):
    """Ids far apart, and words, do not widen the one-hot block."""
    rows = train_rows(spark).withColumn("item", F.pow(F.lit(10), F.col("item")).cast("int")).withColumn("word", F.concat(F.lit("w"), F.col("id") % 3))
    ids = learners.learn_ids(rows, ["item", "word"]).cache()
    assert sorted((r["field"], r["id"]) for r in ids.collect()) == [("item", i) for i in range(1, 6)] + [("word", i) for i in range(1, 4)]
    dense = learners.apply_ids(rows, ids, ["item", "word"])
    model = registry.build("linear")(dense, ["item", "word"], ["value"], steps=3)
    assert len(model.stages[-1].coefficients) == 7 + 5 + 1  # ids 0 to 5 and 0 to 3, one slot each for unseen ones
    few = learners.learn_ids(rows, ["word"], rate=0.5)
    assert few.count() == 1 and learners.learn_ids(rows, ["item"], most=2).count() == 2
    odd = spark.createDataFrame([(None, "nobody"), (10, "")], "item int, word string")
    assert [tuple(r) for r in learners.apply_ids(odd, ids, ["item", "word"]).collect()][0] == (0, 0)


def test_registry(tmp_path):
    with pytest.raises(ValueError):
        registry.register("linear", lambda: None)
    with pytest.raises(KeyError):
        registry.build("nothing")
    path = tmp_path / "extra.py"
    path.write_text("MODELS = {'extra_rule': lambda x: x + 1}\n")
    assert registry.build("extra_rule", external=str(path))(1) == 2


def mean_label(df, args):
    return {"mean": df.agg(F.avg("label")).first()[0], "rows": df.count(), "steps": args.steps}


def load_mean(state, args):
    return lambda feed: {"p": np.full(len(feed["x"]), state["mean"])}


def test_estimator_epochs_tfrecords_and_export(spark, tmp_path):
    rows = train_rows(spark, 30)
    exported = []
    estimator = RankerEstimator(
        mean_label, load_mean, {"steps": 5}, export_fn=lambda state, args: exported.append((state["rows"], args.export_dir))
    ).configure(
        input_mapping={"value": "x", "label": "y"},
        output_mapping={"p": "pred"},
        epochs=2,
        tfrecord_dir=str(tmp_path / "tf"),
        export_dir="somewhere",
    )
    model = estimator.fit(rows)
    assert exported == [(60, "somewhere")] and model.state["steps"] == 5
    out = model.transform(rows)
    assert out.columns == [*rows.columns, "pred"] and out.first()["pred"] == pytest.approx(1 / 3)
    with pytest.raises(ValueError, match="export_dir"):
        RankerEstimator(mean_label, load_mean, export_fn=print).fit(rows)


def test_set_param_wins(spark):
    model = RankerModel({}, load_mean, {"batch_size": 7, "own": 1}).configure(batch_size=3)
    args = model.merged(model.args)
    assert (args.batch_size, args.own, args.epochs) == (3, 1, 1)
    with pytest.raises(TypeError):
        model.configure(input_mapping=["x"])


def test_output_length_is_checked(spark):
    def load():
        return lambda feed: {"p": np.zeros(len(feed["x"]) + 1)}

    with pytest.raises(Exception, match="rows for"):
        score_partitions(train_rows(spark, 5), load, {"value": "x"}, {"p": "p"}).collect()


def test_serving_table(spark):
    vocab = spark.createDataFrame([("DEFAULT", 0), ("u1", 1)], "token string, id bigint")
    weights = spark.createDataFrame([(0, "0.1"), (1, "0.2"), (2, "0.3")], "id bigint, vec string")
    got = serving_table({"cid": (vocab, weights), "gmv": (vocab.limit(1), weights)})
    assert sorted(tuple(r) for r in got.collect()) == [("cid_DEFAULT", "0.1"), ("cid_u1", "0.2"), ("gmv_DEFAULT", "0.1")]


def test_stream_equals_batch_and_replay_is_idempotent(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(0, 50).write.parquet(source)
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(source)
    scored = score_stream(stream, lambda rows: rows.withColumn("twice", F.col("id") * 2))
    feed_batches(scored, out, str(tmp_path / "state")).awaitTermination()
    first = sorted((r["id"], r["twice"]) for r in spark.read.parquet(out).collect())
    assert first == [(i, 2 * i) for i in range(50)]
    # A lost checkpoint replays the same batch ids onto the same folders.
    feed_batches(scored, out, str(tmp_path / "state2")).awaitTermination()
    assert sorted((r["id"], r["twice"]) for r in spark.read.parquet(out).collect()) == first
    with pytest.raises(ValueError):
        score_stream(spark.range(1), lambda rows: rows)


def test_models_do_not_stand_for_each_other(spark):
    rows = train_rows(spark, 4)

    def scored(value):
        return [r["p"] for r in score_partitions(rows, lambda: lambda feed: {"p": np.full(len(feed["x"]), value)}, {"value": "x"}, {"p": "p"}).collect()]

    assert set(scored(0.25)) == {0.25} and set(scored(0.75)) == {0.75}


def load_scaled(state, args):
    return lambda feed: {"p": np.full(len(feed["x"]), float(state["mean"]) * args.own)}


def test_model_is_saved_loaded_and_set_anew(spark, tmp_path):
    rows = train_rows(spark, 6)
    path = str(tmp_path / "model")
    estimator = RankerEstimator(mean_label, load_scaled, {"own": 2.0}).configure(input_mapping={"value": "x", "label": "y"}, output_mapping={"p": "p"}, model_dir=path)
    model = estimator.fit(rows)
    first = [r["p"] for r in model.transform(rows).collect()]
    again = RankerModel.load(path)
    assert [r["p"] for r in again.transform(rows).collect()] == first
    assert again.getOrDefault("output_mapping") == {"p": "p"}
    again.args["own"] = 4.0
    assert [r["p"] for r in again.transform(rows).collect()] == [2 * p for p in first]
    assert "q" in again.configure(output_mapping={"p": "q"}).transform(rows).columns
