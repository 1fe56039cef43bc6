"""Queries over learners, batch scoring, user functions and streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rankloom.functions.numeric import sigmoid
from rankloom.ml import learners, registry
from rankloom.ml.estimator import RankerEstimator, RankerModel
from rankloom.ml.scoring import linear_predictor, score_lines, score_partitions, score_udf
from rankloom.operators.combine import combine_by_key
from rankloom.operators.metrics import auc
from rankloom.plans.catalog import query, table
from rankloom.session import materialize, scratch_path
from rankloom.sources.tfrecord import write_tfrecords
from rankloom.streaming.feed import feed_batches, read_events, read_record_stream, score_stream

DIM = 64
BIAS = 0.1
SQL_LOGIT = "list_sum([embedding[i]::DOUBLE * (((i - 1) * 37) % 101 - 50) / 1e2 FOR i IN range(1, 65)]) + 1e-1"


def demo_weights() -> list[float]:
    """Weights by formula, so that SQL can state the same model."""
    return [((i * 37) % 101 - 50) / 100.0 for i in range(DIM)]


def click_rows(spark, sf_dir):
    """Clicks against views with an item id and the event value."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin("click", "view"))
    return events.select(
        "event_id",
        (F.col("event_type") == "click").cast("int").alias("label"),
        F.get_json_object("props", "$.k").cast("int").alias("item"),
        "value",
    )


def _fit_and_score(rows, fit, steps, **options):
    rows = materialize(learners.apply_ids(rows, materialize(learners.learn_ids(rows, ["item"])), ["item"]))
    model = fit(rows, ["item"], ["value"], steps=steps, **options)
    return materialize(learners.predict(model, rows, ["event_id", "label"]))


def _facts(scored, key, fact, holds: bool):
    """What SQL can know of a learner: every row has one probability, and the fact holds."""
    inside = (F.col("pred") >= 0) & (F.col("pred") <= 1)
    return scored.select(key, F.col("label").cast("int").alias("label"), inside.alias("in_range"), F.lit(holds).alias(fact))


def _balanced(scored) -> bool:
    """With a free intercept the residuals of a logistic fit sum to zero at the optimum."""
    return abs(scored.agg(F.avg(F.col("pred") - F.col("label"))).first()[0]) < 1e-3


def _separates(scored) -> bool:
    return auc(scored, "label", "pred").first()["auc"] > 0.9


def _formula_rows(spark, sf_dir):
    """Labels that follow from the item, which the item's own slot can express."""
    return click_rows(spark, sf_dir).withColumn("label", (F.col("item") % 3 == 0).cast("int"))


_CLICK_FACTS = "SELECT event_id, CAST({label} AS INTEGER) AS label, TRUE AS in_range, TRUE AS {fact} FROM events WHERE event_type IN ('click', 'view')"
_FORMULA = "CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 = 0"


@query("train_linear", _CLICK_FACTS.format(label="event_type = 'click'", fact="balanced"))
def train_linear(spark, sf_dir):
    scored = _fit_and_score(click_rows(spark, sf_dir), learners.fit_linear, 50, l1=0.001, l2=0.01)
    return _facts(scored, "event_id", "balanced", _balanced(scored))


@query("train_fm", _CLICK_FACTS.format(label=_FORMULA, fact="separates"))
def train_fm(spark, sf_dir):
    scored = _fit_and_score(_formula_rows(spark, sf_dir), learners.fit_fm, 15, factors=3)
    return _facts(scored, "event_id", "separates", _separates(scored))


@query("train_mlp", _CLICK_FACTS.format(label=_FORMULA, fact="separates"))
def train_mlp(spark, sf_dir):
    scored = _fit_and_score(_formula_rows(spark, sf_dir), learners.fit_mlp, 15, hidden=(4,))
    return _facts(scored, "event_id", "separates", _separates(scored))


@query(
    "cross_features",
    "SELECT l_orderkey, l_linenumber, round(l_quantity * l_discount, 6) AS qd, round(l_quantity * l_tax, 6) AS qt FROM lineitem",
)
def cross_features(spark, sf_dir):
    """Quantity crossed with a two-component vector."""
    from pyspark.ml.feature import VectorAssembler

    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    rows = VectorAssembler(inputCols=["l_discount", "l_tax"], outputCol="v").transform(rows)
    crossed = learners.cross_stage(["l_quantity", "v"]).transform(rows).withColumn("c", vector_to_array("crossed"))
    return crossed.select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.get("c", F.lit(0)), 6).alias("qd"),
        F.round(F.get("c", F.lit(1)), 6).alias("qt"),
    )


# --- batch scoring -----------------------------------------------------------------------


@query(
    "batch_predict_udf",
    f"SELECT vec_id, round(1 / (1 + exp(-({SQL_LOGIT}))), 6) AS score FROM embeddings",
)
def batch_predict_udf(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    make = linear_predictor(demo_weights(), BIAS)
    return emb.select("vec_id", F.round(score_udf(make, F.col("embedding"), DIM), 6).alias("score"))


def _load_linear(weights, bias):
    def load():
        predict = linear_predictor(weights, bias)()
        return lambda feed: {"p": predict(feed["x"]), "rows": np.full(len(feed["x"]), float(len(feed["x"])))}

    return load


@query(
    "batch_predict_partitions",
    f"SELECT vec_id, label, round(1 / (1 + exp(-({SQL_LOGIT}))), 6) AS score FROM embeddings",
)
def batch_predict_partitions(spark, sf_dir):
    scored = score_partitions(
        table(spark, sf_dir, "embeddings"),
        _load_linear(demo_weights(), BIAS),
        inputs={"embedding": "x"},
        outputs={"p": "score"},
        batch_size=128,
        keep=["vec_id", "label"],
    )
    return scored.withColumn("score", F.round("score", 6))


def _parse_lines(lines: pd.Series):
    fields = lines.str.split("|", regex=False)
    ids = [fields.str[0].tolist(), fields.str[1].tolist()]
    return ids, np.stack([np.array(text.split(","), dtype=np.float64) for text in fields.str[2]])


@query(
    "udf_pandas_scalar",
    f"SELECT vec_id || chr(9) || label || chr(9) || printf('%.6f', 1 / (1 + exp(-({SQL_LOGIT})))) AS value FROM embeddings",
)
def udf_pandas_scalar(spark, sf_dir):
    """Text rows in, ids and score out, joined by a delimiter."""
    values = F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), ",")
    line = F.concat_ws("|", F.col("vec_id").cast("string"), F.col("label").cast("string"), values)
    lines = table(spark, sf_dir, "embeddings").select(line.alias("line"))
    make = linear_predictor(demo_weights(), BIAS)
    return score_lines(lines, "line", make, _parse_lines).select(F.array_join("prediction", "\t").alias("value"))


# --- Estimator and Model -------------------------------------------------------------------


def _train(df, args):
    """Logistic regression on the array column ``features``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    ready = df.select("label", array_to_vector(F.col("features").cast("array<double>")).alias("x"))
    fitted = LogisticRegression(featuresCol="x", labelCol="label", maxIter=args.steps, regParam=0.01).fit(ready)
    return [float(w) for w in fitted.coefficients], float(fitted.intercept)


def _load(state, args):
    return _load_linear(*state)()


@query("ml_estimator", "SELECT vec_id, CAST(label % 2 AS INTEGER) AS label, TRUE AS in_range, TRUE AS balanced FROM embeddings")
def ml_estimator(spark, sf_dir):
    """fit on (features, label), transform keeps the input columns and adds the score."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("features"), (F.col("label") % 2).cast("double").alias("label")
    )
    estimator = RankerEstimator(_train, _load).configure(
        input_mapping={"features": "x", "label": "y"}, output_mapping={"p": "pred"}, steps=50, batch_size=64
    )
    scored = materialize(estimator.fit(rows).transform(rows).select("vec_id", "label", "pred"))
    return _facts(scored, "vec_id", "balanced", _balanced(scored))


@query(
    "ml_model",
    f"SELECT vec_id, round(1 / (1 + exp(-({SQL_LOGIT}))), 6) AS pred FROM embeddings",
)
def ml_model(spark, sf_dir):
    model = RankerModel((demo_weights(), BIAS), _load).configure(
        input_mapping={"embedding": "x"}, output_mapping={"p": "pred"}
    )
    return model.transform(table(spark, sf_dir, "embeddings")).select("vec_id", F.round("pred", 6).alias("pred"))


@query(
    "ml_params",
    f"SELECT vec_id, round(1 / (1 + exp(-({SQL_LOGIT}))), 6) AS pred, TRUE AS within_batch FROM embeddings",
)
def ml_params(spark, sf_dir):
    """A set param wins over the user's argument; the batch size limits each call."""
    model = RankerModel((demo_weights(), BIAS), _load, {"batch_size": 1000}).configure(
        input_mapping={"embedding": "x"}, output_mapping={"p": "pred", "rows": "n"}, batch_size=64
    )
    scored = model.transform(table(spark, sf_dir, "embeddings"))
    return scored.select("vec_id", F.round("pred", 6).alias("pred"), (F.col("n") <= 64).alias("within_batch"))


@query(
    "model_registry",
    "SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-(l_discount * 3 - l_tax))), 6) AS pred FROM lineitem",
)
def model_registry(spark, sf_dir):
    """Score with a model that is looked up by name."""
    if "discount_rule" not in registry.names():
        registry.register("discount_rule", lambda discount, tax: sigmoid(discount * 3 - tax))
    rule = registry.build("discount_rule")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(rule(F.col("l_discount"), F.col("l_tax")), 6).alias("pred")
    )


# --- user functions ------------------------------------------------------------------------


def edits(left: str, right: str) -> int:
    """Insertions, deletions, changes and swaps of neighbours that turn one string into the other (Damerau-Levenshtein)."""
    far = len(left) + len(right)
    seen: dict[str, int] = {}  # last row of a character of ``left``
    cost = [[far] * (len(right) + 2), [far, *range(len(right) + 1)]]
    for i, a in enumerate(left, 1):
        row = [far, i]
        match = 0  # last column of ``a`` in this row
        for j, b in enumerate(right, 1):
            swap = cost[seen.get(b, 0)][match] + (i - seen.get(b, 0) - 1) + 1 + (j - match - 1)
            row.append(min(cost[i][j] + (a != b), row[j] + 1, cost[i][j + 1] + 1, swap))
            match = j if a == b else match
        seen[a] = i
        cost.append(row)
    return cost[-1][-1]


@query("udf_row", "SELECT p_partkey, damerau_levenshtein(p_name, p_brand) AS edits, length(p_name) AS size FROM part")
def udf_row(spark, sf_dir):
    """A row function that no built-in offers, shipped in Arrow batches, next to a built-in."""
    distance = F.udf(edits, "bigint", useArrow=True)
    return table(spark, sf_dir, "part").select(
        "p_partkey", distance("p_name", "p_brand").alias("edits"), F.length("p_name").cast("bigint").alias("size")
    )


def _create_state(rows: pd.DataFrame) -> pd.DataFrame:
    logs = pd.DataFrame({"key": rows["l_suppkey"], "total": np.log(rows["l_extendedprice"]), "n": 1})
    return _merge_states(logs)


def _merge_states(states: pd.DataFrame) -> pd.DataFrame:
    return states.groupby("key", as_index=False).agg({"total": "sum", "n": "sum"})


@query(
    "udaf_combiner",
    "SELECT l_suppkey AS key, count(*) AS n, round(exp(avg(ln(l_extendedprice))), 4) AS geometric_mean FROM lineitem GROUP BY 1",
)
def udaf_combiner(spark, sf_dir):
    """Geometric mean as a user-defined create / merge pair."""
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice")
    states = combine_by_key(rows, ["key"], _create_state, _merge_states, "key bigint, total double, n bigint")
    return states.select("key", "n", F.round(F.exp(F.col("total") / F.col("n")), 4).alias("geometric_mean"))


@query(
    "partition_fn",
    "SELECT vec_id, round(sqrt(list_sum([x::DOUBLE * x::DOUBLE FOR x IN embedding])), 6) AS norm FROM embeddings",
)
def partition_fn(spark, sf_dir):
    """A function from batches to batches inside each partition."""

    def norms(frames):
        for frame in frames:
            matrix = np.stack(frame["embedding"]).astype(np.float64) if len(frame) else np.zeros((0, DIM))
            yield pd.DataFrame({"vec_id": frame["vec_id"], "norm": np.sqrt((matrix**2).sum(axis=1))})

    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return rows.mapInPandas(norms, "vec_id bigint, norm double").withColumn("norm", F.round("norm", 6))


# --- streams ---------------------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return read_events(spark, sf_dir, schema, name_glob="events.parquet", max_files=16)


@query("stream_feed_batches", "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'")
def stream_feed_batches(spark, sf_dir):
    path = scratch_path(spark, "stream")
    run = feed_batches(
        _event_stream(spark, sf_dir),
        path,
        scratch_path(spark, "stream-state"),
        transform=lambda rows: rows.filter(F.col("event_type") != "error"),
    )
    run.awaitTermination()
    return spark.read.parquet(path).select("event_id", "user_id", "event_type", "value")


@query("stream_records", "SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'view'")
def stream_records(spark, sf_dir):
    """TFRecord files of events, fed in batches of bounded size from a stored list of files."""
    source, path = scratch_path(spark, "records"), scratch_path(spark, "stream")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    write_tfrecords(events.repartition(6), source)
    stream = read_record_stream(
        spark, source, scratch_path(spark, "stream-files"), "event_id bigint, user_id bigint, event_type string", max_files=2
    )
    run = feed_batches(stream, path, scratch_path(spark, "stream-state"), lambda rows: rows.filter(F.col("event_type") != "view"), available_now=False)
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    return spark.read.parquet(path).select("event_id", "user_id", "event_type")


@query("stream_score", "SELECT event_id, round(1 / (1 + exp(-(value / 1e2 - 5e-1))), 6) AS score FROM events")
def stream_score(spark, sf_dir):
    path = scratch_path(spark, "stream")

    def score(rows):
        return rows.select("event_id", F.round(sigmoid(F.col("value") / 100.0 - 0.5), 6).alias("score"))

    run = feed_batches(score_stream(_event_stream(spark, sf_dir), score), path, scratch_path(spark, "stream-state"))
    run.awaitTermination()
    return spark.read.parquet(path).select("event_id", "score")
