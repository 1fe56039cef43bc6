"""Batch scoring with a model that fits in one worker's memory."""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Models that a worker keeps; the one used longest ago goes first.
KEPT_MODELS = 4


def loader_key(load: Callable[[], object]) -> str:
    """Digest of a loader with all that it closes over, so that another model is another key."""
    return hashlib.sha256(cloudpickle.dumps(load)).hexdigest()


def cached(key: str, load: Callable[[], object]):
    """Load once per Python worker and key; workers are reused between tasks."""
    shelf = sys.modules.setdefault("_rankloom_models", types.ModuleType("_rankloom_models"))
    models = shelf.__dict__.setdefault("models", {})
    model = models.pop(key) if key in models else load()
    models[key] = model
    while len(models) > KEPT_MODELS:
        models.pop(next(iter(models)))
    return model


def linear_predictor(weights: Sequence[float], bias: float) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """Factory of ``sigmoid(x . w + b)`` for :func:`score_udf`."""
    values = [float(w) for w in weights]

    def make() -> Callable[[np.ndarray], np.ndarray]:
        w = np.asarray(values)

        def predict(x: np.ndarray) -> np.ndarray:
            return 1.0 / (1.0 + np.exp(-(x.astype(np.float64) @ w + bias)))

        return predict

    return make


def score_udf(make_predict: Callable, features: Column, dim: int, batch_size: int = 1024) -> Column:
    """Score an array column; the model is built once per worker, rows go in Arrow batches."""
    udf = predict_batch_udf(
        make_predict, return_type=T.DoubleType(), batch_size=batch_size, input_tensor_shapes=[[dim]]
    )
    return udf(features)


def score_partitions(
    df: DataFrame,
    load: Callable[[], Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]],
    inputs: dict[str, str],
    outputs: dict[str, str],
    batch_size: int = 100,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Score columns in fixed-size batches inside each partition.

    ``inputs`` maps a column to a model input, ``outputs`` a model output to a
    double column; both are used in sorted order.  An output whose length
    differs from its input raises.  A worker keeps loaded models by a digest of
    ``load``, so two models never stand for each other.
    """
    in_cols = sorted(inputs)
    out_names = sorted(outputs)
    keep = list(keep)
    schema = T.StructType(
        [df.schema[c] for c in keep] + [T.StructField(outputs[o], T.DoubleType(), True) for o in out_names]
    )

    key = loader_key(load)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = cached(key, load)
        for frame in frames:
            for at in range(0, len(frame), batch_size):
                part = frame.iloc[at : at + batch_size]
                feed = {inputs[c]: np.stack(part[c]) if part[c].dtype == object else part[c].to_numpy() for c in in_cols}
                result = model(feed)
                out = part[keep].reset_index(drop=True)
                for name in out_names:
                    values = np.asarray(result[name], dtype=np.float64)
                    if len(values) != len(part):
                        raise ValueError(f"output {name} has {len(values)} rows for {len(part)} inputs")
                    out[outputs[name]] = values
                yield out

    return df.select(*dict.fromkeys([*keep, *in_cols])).mapInPandas(run, schema)


def score_lines(df: DataFrame, line: str, make_predict: Callable, parse: Callable, out: str = "prediction") -> DataFrame:
    """Text rows to ``array<string>`` of ids and scores kept together.

    ``parse(lines) -> (list of id columns, feature matrix)`` and
    ``make_predict() -> predict(matrix)`` run on whole Arrow batches.
    """

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = make_predict()
        for lines in batches:
            ids, matrix = parse(lines)
            scores = predict(matrix)
            yield pd.Series([[*map(str, row)] for row in zip(*ids, [f"{s:.6f}" for s in scores])], dtype=object)

    return df.withColumn(out, score(F.col(line)))
