"""Bounded feeds that are stopped and started again, folded states, and models in saved pipelines."""

import os

import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from rankloom.ml.estimator import RankerEstimator
from rankloom.operators.combine import combine_by_key
from rankloom.plans.q_ml import edits
from rankloom.sources import tfrecord as tf
from rankloom.streaming.feed import feed_batches, read_events, read_record_stream
from test_ml_and_streams import load_scaled, mean_label, train_rows


def ids(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())


def batch_sizes(spark, path):
    return [r["count"] for r in spark.read.parquet(path).groupBy("batch_id").count().orderBy("batch_id").collect()]


@pytest.mark.parametrize("bound", [{"max_files": 3}, {"max_bytes": 1500}])
def test_backlog_is_fed_in_bounded_batches(spark, tmp_path, bound):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(100).repartition(10).write.parquet(source)
    stream = read_events(spark, source, "id bigint", **bound)
    feed_batches(stream, out, str(tmp_path / "state")).awaitTermination()
    assert ids(spark, out) == list(range(100)) and len(batch_sizes(spark, out)) >= 4
    with pytest.raises(ValueError):
        read_events(spark, source, "id bigint", max_files=1, max_bytes=1)


def test_record_stream_is_stopped_and_started_again(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    state, checkpoint = str(tmp_path / "files"), str(tmp_path / "state")
    tf.write_tfrecords(spark.range(0, 60).repartition(6), source)

    def run(fail_at=None):
        stream = read_record_stream(spark, source, state, "id bigint", max_files=2)

        def broken(rows):
            if fail_at is not None and rows.filter(F.col("id") >= 0).count() and len(os.listdir(out) if os.path.isdir(out) else []) > fail_at:
                raise RuntimeError("lost")
            return rows

        query = feed_batches(stream, out, checkpoint, broken, available_now=False)
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(Exception):
        run(fail_at=1)  # dies inside a later batch, whose offset is already stored
    before = ids(spark, out)
    assert 0 < len(before) < 60
    run()
    assert ids(spark, out) == list(range(60))
    tf.write_tfrecords(spark.range(60, 90).repartition(3), source)
    run()
    assert ids(spark, out) == list(range(90))
    assert max(batch_sizes(spark, out)) <= 40
    with pytest.raises(Exception, match="state"):
        query = spark.readStream.format("tfrecord").schema("id bigint").load(f"file://{source}")
        feed_batches(query, str(tmp_path / "o2"), str(tmp_path / "s2"), available_now=False).processAllAvailable()


def test_file_log(tmp_path):
    log = tf.FileLog(f"file://{tmp_path}/log")
    log.append([("a", 1), ("b", 2)])
    log.append([("c", 3)])
    again = tf.FileLog(f"file://{tmp_path}/log")
    assert again.end == 3 and again.files(1, 3) == [("b", 2), ("c", 3)] and again.files(0, 1) == [("a", 1)] and again.files(3, 3) == []


@pytest.mark.parametrize("salts", [1, 4])
def test_states_are_folded_by_batch(spark, salts):
    calls = spark.sparkContext.accumulator(0)

    def create(rows):
        return rows.groupby(["k", "j"], as_index=False, dropna=False).agg(v=("v", "sum"), n=("v", "size"))

    def merge(states):
        calls.add(1)
        return states.groupby(["k", "j"], as_index=False, dropna=False).agg({"v": "sum", "n": "sum"})

    rows = [(None if i % 50 == 0 else f"k{i % 700}" if i % 3 else "hot", i % 2, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, j int, v bigint").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")
    try:
        got = {(r["k"], r["j"]): (r["v"], r["n"]) for r in combine_by_key(df, ["k", "j"], create, merge, "k string, j int, v bigint, n bigint", salts).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    frame = pd.DataFrame(rows, columns=["k", "j", "v"])
    want = frame.groupby(["k", "j"], dropna=False).agg(v=("v", "sum"), n=("v", "size"))
    assert got == {(None if pd.isna(k) else k, j): tuple(map(int, r)) for (k, j), r in zip(want.index, want.to_numpy())}
    assert calls.value < 60 < len(got)


def test_saved_pipeline_scores_equally(spark, tmp_path):
    rows = train_rows(spark, 12)
    estimator = RankerEstimator(mean_label, load_scaled, {"own": 2.0}).configure(input_mapping={"value": "x", "label": "y"}, output_mapping={"p": "p"})
    pipeline = Pipeline(stages=[SQLTransformer(statement="SELECT *, value + 1 AS more FROM __THIS__"), estimator])
    model = pipeline.fit(rows)
    model.write().overwrite().save(str(tmp_path / "model"))
    pipeline.write().overwrite().save(str(tmp_path / "pipeline"))
    want = [(r["id"], r["more"], r["p"]) for r in model.transform(rows).orderBy("id").collect()]
    for again in (PipelineModel.load(str(tmp_path / "model")), Pipeline.load(str(tmp_path / "pipeline")).fit(rows)):
        assert [(r["id"], r["more"], r["p"]) for r in again.transform(rows).orderBy("id").collect()] == want
    assert PipelineModel.load(str(tmp_path / "model")).stages[1].uid == model.stages[1].uid


def test_edits():
    pairs = {("", ""): 0, ("a", ""): 1, ("ab", "ba"): 1, ("ca", "abc"): 2, ("kitten", "sitting"): 3, ("abcd", "acbd"): 1}
    assert {p: edits(*p) for p in pairs} == pairs
